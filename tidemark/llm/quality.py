"""Quality rules: surface counts, perplexity bands of a character n-gram model, and a limit by a word n-gram model.

The character model is modified Kneser-Ney over three characters, one for each language. Spark counts the n-grams of all
different texts; probabilities are kept in sorted arrays of packed n-grams that tasks search. Characters fall in 128
classes, so a language has at most 128**3 n-grams. What characters do not show, such as the order of words or texts in
other scripts, is left to the word model of ``wordmodel``, which grows with the documents and is looked up by shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import wordmodel
from tidemark.llm.common import bound_batches, map_columns, map_rows, release, stored, unused_name

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
BLOCK = 1 << 20
ORDER, BITS = 3, 7


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words covered by windows of ``size`` words that are found twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    names = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    base = len(known)
    # name longer and longer runs, first of the words and then of pairs of runs
    length, runs = 1, names
    while length < size:
        step = min(length, size - length)
        ahead = runs if step == length else names
        if step not in (length, 1):
            step, ahead = 1, names
        m = len(runs) - step
        width = int(ahead.max()) + 1 if step == length else base
        pairs = runs[:m] * width + ahead[length : length + m]
        _, runs = np.unique(pairs, return_inverse=True)
        length += step
        if int(runs.max()) + 1 == len(runs):
            return 0  # all runs differ already
    found = np.flatnonzero(np.bincount(runs)[runs] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def surface_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = text.encode().split()
    spaces = sum(map(text.count, SPACES))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - spaces,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def symbols(text: str) -> np.ndarray:
    """Character classes: ASCII as it is, digits alike, other characters over the unused classes, white space once."""
    text = re.sub(r"[ \t\n\v\f\r]+", " ", text)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    free = np.array([*range(1, 32), *range(ord("1"), ord("9") + 1), 127])
    out = np.where(points < 128, points, free[(points * 2654435761 >> 7) % len(free)])
    out[(points >= ord("0")) & (points <= ord("9"))] = ord("0")
    out[points < 32] = 0
    return out


def packed_ngrams(text: str | None) -> Iterator[np.ndarray]:
    """Packed n-grams of a text that begins after ``ORDER - 1`` spaces, about a million at a time."""
    text = text or ""
    if not text.strip(SPACES):
        return
    before = np.full(ORDER - 1, ord(" "))
    for start in range(0, len(text), BLOCK):
        got = np.concatenate([before, symbols(text[start : start + BLOCK])])
        if len(got) >= ORDER:
            packed = got[: len(got) - ORDER + 1]
            for i in range(1, ORDER):
                packed = packed << BITS | got[i : len(got) - ORDER + 1 + i]
            yield packed
        before = got[-(ORDER - 1) :]


def ngram_counts(texts: list, langs: list) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Different n-grams of the texts of a language with their counts, a few million places at a time."""
    found: dict[str, list[np.ndarray]] = {}
    size = 0

    def counted() -> Iterator[tuple]:
        for name, parts in found.items():
            yield name, *np.unique(np.concatenate(parts), return_counts=True)
        found.clear()

    for t, name in zip(texts, langs):
        for part in packed_ngrams(t):
            found.setdefault(name or "", []).append(part.astype(np.int32))
            size += len(part)
            if size > 4 * BLOCK:
                yield from counted()
                size = 0
    yield from counted()


def count_ngrams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, gram, n`` over all documents; counts are combined in each task before the shuffle."""

    def run(texts: list, langs: list) -> Iterator[tuple]:
        for name, grams, counts in ngram_counts(texts, langs):
            yield [name] * len(grams), grams, counts

    rows = map_columns(docs, [text, lang], run, "lang string, gram int, n long", batch=2000)
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def count_distinct_ngrams(texts: DataFrame) -> DataFrame:
    """``lang, gram, n`` over the different texts of ``texts_by_block``, each counted once, in one pass over the blocks."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = wordmodel.different(table)
        parts = [
            pa.table([pa.array([name] * len(grams)), pa.array(grams), pa.array(counts)], schema=counted)
            for name, grams, counts in ngram_counts([r[3] for r in rows], [r[2] for r in rows])
        ]
        return pa.concat_tables(parts) if parts else counted.empty_table()

    counted = pa.schema([("lang", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])
    rows = texts.groupBy("block").applyInArrow(run, "lang string, gram int, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Sorted packed n-grams of one order each, their log2 probabilities, and back-off weights of their contexts."""

    keys: list[np.ndarray]
    times: list[np.ndarray]  # how often each n-gram stands in the documents
    logp: list[np.ndarray]
    backoff: list[np.ndarray]
    unseen: float  # log2 probability of a character class the model has not met


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more."""
    n = [float((counts == i).sum()) for i in range(1, 5)]
    if min(n) == 0:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n[0] / (n[0] + 2 * n[1])
    d = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
    return np.array([0.0, *(min(max(x, 0.05), i - 0.05) for i, x in zip((1, 2, 3), d))])


def kneser_ney(grams: np.ndarray, counts: np.ndarray) -> Model:
    """The model of one language from its counted n-grams."""
    order = np.argsort(grams)
    levels = [(grams[order].astype(np.int64), counts[order].astype(np.int64), counts[order].astype(np.int64))]
    for _ in range(ORDER - 1):
        # lower orders count the different characters that stand before
        keys, _, times = levels[-1]
        shorter, inverse, n = np.unique(
            keys & ((1 << BITS * (ORDER - len(levels))) - 1), return_inverse=True, return_counts=True
        )
        levels.append((shorter, n, np.bincount(inverse, weights=times).astype(np.int64)))
    levels.reverse()
    model = Model([], [], [], [], 0.0)
    for size, (keys, n, times) in enumerate(levels, 1):
        context, inverse = np.unique(keys >> BITS, return_inverse=True)
        total = np.bincount(inverse, weights=n)
        discount = _discounts(n)[np.minimum(n, 3)]
        left = np.bincount(inverse, weights=discount) / total
        if size == 1:
            lower = np.full(len(keys), 1 / (1 << BITS))
            model.unseen = float(np.log2(left[0] / (1 << BITS)))
        else:
            suffix = keys & ((1 << BITS * (size - 1)) - 1)
            lower = 2.0 ** model.logp[-1][np.searchsorted(model.keys[-1], suffix)]
        p = (n - discount) / total[inverse] + left[inverse] * lower
        if size > 1:
            weights = np.zeros(len(model.keys[-1]))
            at = np.minimum(np.searchsorted(model.keys[-1], context), len(weights) - 1)
            known = model.keys[-1][at] == context
            weights[at[known]] = np.log2(left[known])
            model.backoff.append(weights)
        model.keys.append(keys)
        model.times.append(times)
        model.logp.append(np.log2(p))
    return model


def _totals(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    different, inverse = np.unique(keys, return_inverse=True)
    return different, np.bincount(inverse, weights=n).astype(np.int64)


def log_probability(model: Model, grams: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
    """log2 probabilities of different n-grams; those the model has not seen back off to shorter ones.

    ``own`` says how often each stands in the document that is scored. What only that document has counts as unseen:
    else a document of noise would vouch for itself.
    """
    own = np.zeros(len(grams), np.int64) if own is None else own
    out = np.empty(len(grams))
    penalty = np.zeros(len(grams))
    todo = np.arange(len(grams))

    def look_up(size: int, keys: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = model.keys[size - 1]
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return at, (known[at] == keys) & (model.times[size - 1][at] > used)

    def own_times(size: int, keys: np.ndarray) -> np.ndarray:
        if size == ORDER:
            return own[todo]
        different, n = _totals(grams & ((1 << BITS * size) - 1), own)
        at = np.minimum(np.searchsorted(different, keys), len(different) - 1)
        return np.where(different[at] == keys, n[at], 0)

    for size in range(ORDER, 0, -1):
        keys = grams[todo] & ((1 << BITS * size) - 1)
        at, seen = look_up(size, keys, own_times(size, keys))
        out[todo[seen]] = penalty[todo[seen]] + model.logp[size - 1][at[seen]]
        todo, keys = todo[~seen], keys[~seen]
        if not len(todo):
            break
        if size > 1:
            context = keys >> BITS
            at, seen = look_up(size - 1, context, own_times(size - 1, context))
            penalty[todo[seen]] += model.backoff[size - 2][at[seen]]
        else:
            out[todo] = penalty[todo] + model.unseen
    return out


def bits_per_character(model: Model, text: str | None) -> float | None:
    """-log2 probability per character, each document scored by what the others have; null without words."""
    parts = [np.unique(p, return_counts=True) for p in packed_ngrams(text)]
    if not parts:
        return None
    grams, n = parts[0] if len(parts) == 1 else _totals(*map(np.concatenate, zip(*parts)))
    return -float((log_probability(model, grams, n) * n).sum()) / int(n.sum())


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, Model]:
    """One model for each language (a null language counts as the empty name), from the n-grams of all documents."""
    return models_of(count_ngrams(docs, text, lang))


def models_of(ngrams: DataFrame) -> dict[str, Model]:
    """One model for each language of the counted ``lang, gram, n``."""
    # stored, so that the shuffled texts can go before the models are used
    counted = stored(ngrams, "quality-ngrams").toArrow()
    names = np.array(counted.column("lang").to_pylist(), dtype=object)
    grams, n = (counted.column(c).to_numpy() for c in ("gram", "n"))
    return {name: kneser_ney(grams[names == name], n[names == name]) for name in sorted(set(names))}


def score(docs: DataFrame, models: dict[str, Model], text: str, lang: str, keep: list[str]) -> DataFrame:
    """The columns of ``keep``, the surface counts, and ``bits``: -log2 probability per character, null without words.

    A document of a language without a model has null bits.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(texts: list, langs: list) -> Iterator[tuple]:
        for t, name in zip(texts, langs):
            model = shared.value.get(name or "")
            yield (*surface_counts(t), None if model is None else bits_per_character(model, t))

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = ", ".join(f"{unused_name(docs, c)} long" for c in names) + f", {unused_name(docs, 'bits')} double"
    return map_rows(docs, [text, lang], run, schema, keep=keep)


def bands(scored: DataFrame, lang: str, bits: str, reach: float, least: float, bins: int = 1000) -> DataFrame:
    """``band_lang, low, high``: quartiles of bits (to 1 / ``bins``) widened by ``reach`` quartile distances.

    The band is at least ``least`` bits wide on either side of the quartiles. A histogram is aggregated, so no language
    is collected in one place.
    """
    bin_of = F.floor(F.col(bits) * bins)
    histogram = (
        scored.where(F.col(bits).isNotNull()).groupBy(F.coalesce(F.col(lang), F.lit("")).alias("band_lang"), bin_of.alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    share = F.expr(
        "sum(n) OVER (PARTITION BY band_lang ORDER BY bin) / sum(n) OVER (PARTITION BY band_lang)"
    )
    quartiles = histogram.withColumn("share", share).groupBy("band_lang").agg(
        F.min(F.when(F.col("share") >= 0.25, F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("share") >= 0.75, F.col("bin"))).alias("q3"),
    )
    room = F.greatest((F.col("q3") - F.col("q1")) / bins * reach, F.lit(least))
    return quartiles.select(
        "band_lang", (F.col("q1") / bins - room).alias("low"), (F.col("q3") / bins + room).alias("high")
    )


def surprising_texts(texts: DataFrame, ranges: int, reach: float, bins: int = 1000) -> DataFrame:
    """``a, b``: keys of the texts whose words the other texts do not lead to expect.

    The limit lies ``reach`` times the measured spread above the upper quartile of the language: the quartile distance, or
    for texts of few words the standard error of their mean. There is no lower limit: what others have too is no noise.
    """
    words = stored(wordmodel.score_words(texts, ranges), "quality-words")
    limits = bands(words, "lang", "word_bits", 0.0, 0.0, bins).join(
        words.groupBy(F.col("lang").alias("of_lang")).agg(F.avg("word_spread").alias("spread")),
        F.col("band_lang") == F.col("of_lang"),
    )
    room = F.greatest(F.col("high") - F.col("low"), F.sqrt(F.col("spread") / F.col("n"))) * reach
    known = words.join(limits, F.col("lang") == F.col("band_lang"))
    return known.where(F.col("word_bits") > F.col("high") + room + 1 / bins).select("a", "b")


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    keep: list[str] | None = None,
    reach: float = 6.0,
    least: float = 1.0,
    min_words: int = 10,
    max_repeat_percent: int = 20,
) -> DataFrame:
    """The columns of ``keep`` (``doc_id`` alone by default), surface counts, ``bits``, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or over ``max_repeat_percent`` percent of the words in 5-word
    windows that come twice or more. Otherwise a document is kept if its bits per character (log2 of its perplexity)
    lie within the band of its language and its words are not beyond the limit of ``surprising_texts``. Both models count
    a text once, however many copies there are: copied noise does not vouch for itself. Null texts count as empty, null languages as one language of their own, null ids
    and repeated rows stay as they are. New columns whose names are taken get underscores in front.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    kept = keep or [doc_id]
    source = docs.select(*[f"`{c}`" for c in dict.fromkeys([*kept, doc_id, text, lang])])
    texts, ranges = wordmodel.texts_by_block(source, text, lang)
    models = models_of(count_distinct_ngrams(texts))
    release(spark)
    surprising = stored(surprising_texts(texts, ranges, reach), "quality-surprising")
    release(spark)
    of_a, of_b = (unused_name(source, c) for c in ("of_a", "of_b"))
    a, b = wordmodel.text_key(F.coalesce(F.col(f"`{lang}`"), F.lit("")), F.col(f"`{text}`"))
    keyed = source.withColumn(of_a, a).withColumn(of_b, b)
    scored = stored(score(keyed, models, text, lang, list(dict.fromkeys([*kept, lang, of_a, of_b]))), "quality-scored")
    name = {c: unused_name(source, c) for c in ("n_words", "n_repeat_words", "bits", "base_failed", "kept")}
    limits = bands(scored, lang, name["bits"], reach, least)
    of_lang, low, high = (unused_name(scored, c) for c in limits.columns)
    limits = limits.toDF(of_lang, low, high)
    failed = (F.col(name["n_words"]) < min_words) | (
        100 * F.col(name["n_repeat_words"]) > max_repeat_percent * F.col(name["n_words"])
    )
    # one row for each language that has a model, and the models were broadcast before
    known = scored.join(F.broadcast(limits), F.coalesce(F.col(lang), F.lit("")) == F.col(of_lang), "left")
    key_a, key_b, odd = (unused_name(known, c) for c in ("key_a", "key_b", "odd"))
    surprising = surprising.toDF(key_a, key_b).withColumn(odd, F.lit(True))
    known = known.join(surprising, (F.col(of_a) == F.col(key_a)) & (F.col(of_b) == F.col(key_b)), "left")
    fits = F.coalesce(F.col(name["bits"]).between(F.col(low), F.col(high)), F.lit(True)) & F.col(odd).isNull()
    out = known.withColumn(name["base_failed"], failed).withColumn(name["kept"], ~failed & fits)
    dropped = [of_lang, low, high, of_a, of_b, key_a, key_b, odd] + ([lang] if lang not in kept else [])
    return out.select(*[f"`{c}`" for c in out.columns if c not in dropped])


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns."""
    judged = judge(docs, doc_id, text, lang, keep=docs.columns, **options)
    return judged.where(F.col(unused_name(docs, "kept"))).select(*[f"`{c}`" for c in docs.columns])
