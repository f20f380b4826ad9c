"""Mixing sources to target weights.

Token counts of the cells (source, language, topic) are raked to three target marginals by iterative proportional fitting,
and documents are drawn with the probability their cell ends up with.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidemark.llm.common import unused_name

OTHER = None


def token_count(text: Column) -> Column:
    """Runs without ASCII white space; null texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def rake(
    tokens: np.ndarray, members: Sequence[np.ndarray], targets: Sequence[np.ndarray], total: float,
    rounds: int = 500, tolerance: float = 1e-9,
) -> np.ndarray:
    """Tokens to draw from each cell: at most what it has, and as close to the marginals as that allows.

    ``members[d][c]`` is the category of cell c in dimension d and ``targets[d]`` the share of each category. Shares of
    categories without tokens go to the others in proportion.
    """
    drawn = tokens.astype(float) * (total / tokens.sum())
    for _ in range(rounds):
        before = drawn
        for member, target in zip(members, targets):
            there = np.bincount(member, weights=tokens, minlength=len(target)) > 0
            wanted = np.where(there, target, 0.0)
            wanted = wanted / wanted.sum() * total if wanted.sum() else wanted
            now = np.bincount(member, weights=drawn, minlength=len(target))
            factor = np.divide(wanted, now, out=np.zeros(len(target)), where=now > 0)
            drawn = np.minimum(drawn * factor[member], tokens)
        if np.abs(drawn - before).max() <= tolerance * total:
            break
    return drawn


def mix(
    docs: DataFrame,
    topic: Column,
    sources: Mapping[str | None, float],
    languages: Mapping[str | None, float],
    topics: Mapping[str | None, float],
    share: float = 0.5,
    seed: int = 7,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns of ``keep`` (``doc_id, source, lang``) and ``topic, n_tokens, probability, sampled``.

    Targets give the share of tokens of each value; ``None`` stands for every value that is not named and for null, and
    where it is missing such documents are never drawn. ``share`` of all tokens is drawn; a cell gives at most all it has.
    A document is drawn if a hash of its id, text and ``seed`` falls below its probability, so repeated rows are drawn
    together, each row with a null id by its text. Documents without tokens take the probability of their cell, 0 if
    that has no tokens at all. An empty table gives no rows. New columns whose names are taken get underscores in front.

    The driver holds one number per cell, at most the product of the numbers of named values plus one each.
    """
    spark = docs.sparkSession
    kept = [doc_id, source, lang] if keep is None else keep
    name = {c: unused_name(docs, c) for c in ("topic", "n_tokens", "probability", "sampled")}
    dims = [(source, sources), (lang, languages), (name["topic"], topics)]
    with_topic = docs.withColumn(name["topic"], topic.cast("string")).withColumn(name["n_tokens"], token_count(F.col(text)))
    cells = [unused_name(with_topic, f"cell_{i}") for i in range(3)]
    for cell, (column, target) in zip(cells, dims):
        named = [v for v in target if v is not OTHER]
        # the position of the value among the named ones; all others share the last position
        number = F.coalesce(F.array_position(F.array(*[F.lit(v) for v in named]), F.col(column)), F.lit(0))
        with_topic = with_topic.withColumn(cell, F.when(number == 0, len(named)).otherwise(number - 1).cast("int"))
    counted = with_topic.groupBy(*cells).agg(F.sum(name["n_tokens"]).alias("tokens")).orderBy(*cells).collect()
    tokens = np.array([r["tokens"] for r in counted], dtype=np.int64)
    members = [np.array([r[c] for r in counted], dtype=np.int64) for c in cells]
    shares = [
        np.array([*[float(w) for v, w in target.items() if v is not OTHER], float(target.get(OTHER, 0.0))])
        for _, target in dims
    ]
    drawn = rake(tokens, members, shares, share * float(tokens.sum())) if tokens.sum() else np.zeros(len(tokens))
    chance = np.divide(drawn, tokens, out=np.zeros(len(tokens)), where=tokens > 0)
    keys = [unused_name(with_topic, f"of_{c}") for c in cells]
    table = spark.createDataFrame(
        [(*[int(m[i]) for m in members], float(p)) for i, p in enumerate(chance)],
        StructType([StructField(k, LongType()) for k in keys] + [StructField(name["probability"], DoubleType())]),
    )
    matches = [F.col(c) == F.col(k) for c, k in zip(cells, keys)]
    joined = with_topic.join(F.broadcast(table), matches, "left")  # one row per cell, bounded by the targets
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), 11) / float(1 << 53)
    return joined.withColumn(name["sampled"], draw < F.col(name["probability"])).select(
        *[f"`{c}`" for c in kept], *[f"`{c}`" for c in name.values()]
    )


def sample(docs: DataFrame, topic: Column, sources, languages, topics, **options) -> DataFrame:
    """The documents that ``mix`` draws, with their columns."""
    mixed = mix(docs, topic, sources, languages, topics, keep=docs.columns, **options)
    return mixed.where(F.col(unused_name(docs, "sampled"))).select(*[f"`{c}`" for c in docs.columns])
