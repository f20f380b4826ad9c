"""Comments grouped by score and summarised."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import nulls, text
from tidemark.operators import aggregates, joins, windows
from tidemark.session import working_folder

# Answers of the summary step when there is nothing to summarise or the step fails.
NO_COMMENTS = "No hay comentarios relevantes."
FAILED = "Error al resumir: "
SENTENCE_END = "[.!?\\n]+"
WORD_GAP = "[ \\t,;:]+"
ANY_GAP = "[.!?\\n \\t,;:]+"
# More positions than one comment can hold.
POSITIONS = 1 << 31


def scored_comments(df: DataFrame) -> DataFrame:
    """Comments with a numeric score; other rows drop out. Noise counts as an empty comment."""
    relevant = F.when(~text.is_noise(F.col("comment")), F.col("comment"))
    return df.withColumns({"score": nulls.as_number(F.col("score").cast("string")), "comment": relevant}).where(
        F.col("score").isNotNull()
    )


def comments_by_score(df: DataFrame, order: str, width: int = 256) -> DataFrame:
    """All relevant comments of each score, whole, as numbered parts (see ``joined_text``).

    A score with noise only has one part without text.
    """
    scored = scored_comments(df)
    parts = aggregates.joined_text(scored, ["score"], "comment", order, width=width)
    silent = scored.groupBy("score").agg(F.count("comment").alias("texts")).where(F.col("texts") == 0)
    empty = silent.select("score", F.lit(0).cast("long").alias("part"), F.lit("").alias("comment"), "texts")
    return parts.unionByName(empty)


def summarise(parts: DataFrame, summariser: Callable[[str, float], str]) -> DataFrame:
    """Adds ``resumen``: the answer of a pluggable ``summariser(text, score)`` for every part.

    Empty text gets a fixed answer, a failing call the error text. Parts are bounded by the ``width`` they were joined
    with, so nothing is cut here.
    """

    def answer(comment: str, score: float) -> str:
        if not comment.strip():
            return NO_COMMENTS
        try:
            return summariser(comment, score)
        except Exception as error:  # noqa: BLE001 - the error text is the result
            return f"{FAILED}{error}"

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for comments, scores in batches:
            yield pd.Series([answer(c, s) for c, s in zip(comments, scores)], dtype="object")

    return parts.withColumn("resumen", run(F.col("comment"), F.col("score")))


def summary_by_score(parts: DataFrame, summariser: Callable[[str, float], str], fan_in: int = 64) -> DataFrame:
    """One ``resumen`` per score: answers of up to ``fan_in`` neighbouring parts are joined and summarised again, until
    one is left. Every round is written to the shared folder; no call gets more than ``fan_in`` answers.
    """
    spark = parts.sparkSession
    answers = summarise(parts, summariser).select("score", "part", "resumen")
    while True:
        path = working_folder(spark, "summaries")
        answers.write.parquet(path)
        answers = spark.read.parquet(path)
        if not answers.agg(F.max("part")).first()[0]:
            return answers.select("score", "resumen")
        answered = F.array_sort(F.collect_list(F.struct("part", "resumen")))
        merged = answers.groupBy("score", F.floor(F.col("part") / fan_in).alias("part")).agg(answered.alias("_answers"))
        # an answer that stands alone is final for this round
        alone = merged.where(F.size("_answers") == 1)
        several = merged.where(F.size("_answers") > 1).select(
            "score", "part", F.array_join(F.transform("_answers", lambda a: a["resumen"]), " ").alias("comment")
        )
        answers = alone.select("score", "part", F.col("_answers")[0]["resumen"].alias("resumen")).unionByName(
            summarise(several, summariser).select("score", "part", "resumen")
        )


def _relevant(df: DataFrame) -> DataFrame:
    return scored_comments(df).where(F.col("comment").isNotNull())


def sentences(df: DataFrame, order: str) -> DataFrame:
    """Sentences of the relevant comments with their position."""
    return (
        _relevant(df)
        .select("score", order, F.posexplode(F.split("comment", SENTENCE_END)).alias("pos", "sentence"))
        .withColumn("sentence", F.trim("sentence"))
        .where(F.col("sentence") != "")
    )


def word_counts(df: DataFrame) -> DataFrame:
    """How often each word occurs in the comments of a score. Counted in the scan stage, then merged."""
    pieces = _relevant(df).select("score", F.explode(F.split("comment", ANY_GAP)).alias("piece")).where("piece <> ''")
    words = pieces.select("score", F.lower("piece").alias("word")).where(F.col("word").isNotNull())
    return words.groupBy("score", "word").agg(F.count("*").alias("_count"))


def key_sentences(df: DataFrame, order: str, n: int = 3) -> DataFrame:
    """The ``n`` sentences of each score whose words are the most frequent ones within that score.

    The built-in summary: words are counted over the whole group, a sentence weighs the mean count of its words (in
    thousandths, rounded down), ties go to the earlier sentence. Equal sentences are merged before their words are
    looked up, so copies cost nothing further on; very frequent words are spread before they meet their counts. Counts,
    one for each word of a score, are hashed by partition, so that the many words of the sentences need no sort. The
    text of the chosen sentences is fetched at the end, by comment: Spark sends the places to the comments if they are few,
    as it measures, and drops other comments before a shuffle if they are not.
    """
    # comment and position in one number, so that the first place is a cheap minimum
    positions = F.lit(POSITIONS).cast("decimal(10,0)")
    place = F.col(order).cast("decimal(20,0)") * positions + F.col("pos")
    first = F.col("_first")
    distinct = (
        sentences(df, order)
        .groupBy("score", "sentence")
        .agg(F.min(place).alias("_first"), F.count("*").alias("copies"))
        .select(
            "score",
            F.floor(first / positions).cast("long").alias(order),
            F.pmod(first, positions).cast("int").alias("pos"),
            "copies",
            "sentence",
        )
    )
    words = distinct.select("score", order, "pos", "copies", F.explode(F.split("sentence", WORD_GAP)).alias("word"))
    words = words.where("word <> ''").withColumn("word", F.lower("word"))
    counts = word_counts(df)
    hot = joins.frequent(counts, "_count")
    weighed = (
        joins.hot_key_lookup(words, counts.hint("shuffle_hash"), hot, ["score", "word"], [order, "pos"])
        .groupBy("score", order, "pos", "copies")
        .agg(F.sum("_count").alias("_sum"), F.count("*").alias("_words"))
        .withColumn("weight", F.expr("(_sum * 1000) div _words"))
    )
    best = windows.keep_top(weighed, ["score"], [F.col("weight").desc(), F.col(order), F.col("pos")], n)
    sentence = F.trim(F.get(F.split("comment", SENTENCE_END), F.col("pos")))
    return (
        _relevant(df)
        .join(best, ["score", order])
        .select("score", order, "pos", "copies", "weight", sentence.alias("sentence"))
    )
