"""Line deduplication over levelled sorted runs of line hashes.

A run is a bucketed, sorted table: for each line hash how many documents hold it and the largest of them. Each batch of
documents is merge-anti-joined with the runs, so that lines already known to be frequent add nothing, and what is left
becomes a run of its own. As soon as a level holds ``fan_in`` runs, they are compacted into one run of the next level.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import map_columns, map_rows, release, stored, unused_name
from tidemark.session import working_folder

# fixed values: what is stripped from both ends of a line; letters A to Z are lower-cased as bytes
BLANKS = b" \t\n\x0b\x0c\r"
HASH = ["high", "low"]
RUN = "high long, low long, n long, holder struct<doc_id:long, nameless:long>"


def line_hashes(text: str | None, min_chars: int) -> tuple[list[int], bytes]:
    """Numbers of the lines whose key is long enough, and the 16-byte hashes of their keys."""
    numbers, hashes = [], []
    for number, line in enumerate((text or "").encode().split(b"\n")):
        key = line.strip(BLANKS).lower()
        if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
            numbers.append(number)
            hashes.append(xxhash.xxh3_128_digest(key))
    return numbers, b"".join(hashes)


def _lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """``high, low, doc_id, text_hash, batch, number``: a row for each line with a long key."""

    def run(ids: list, text_hashes: list, batches: list, texts: list) -> Iterator[tuple]:
        found = [line_hashes(t, min_chars) for t in texts]
        sizes = [len(numbers) for numbers, _ in found]
        if any(sizes):
            hashes = np.frombuffer(b"".join(h for _, h in found), ">i8").astype(np.int64)
            repeated = ([x for x, n in zip(column, sizes) for _ in range(n)] for column in (ids, text_hashes, batches))
            yield hashes[::2], hashes[1::2], *repeated, [n for numbers, _ in found for n in numbers]

    schema = "high long, low long, doc_id long, text_hash long, batch int, number int"
    return map_columns(rows, ["doc_id", "text_hash", "batch", "text"], run, schema)


class Run(NamedTuple):
    table: str
    path: str


class LineRuns:
    """The sorted runs of a corpus, by level, in the shared folder.

    A document stands in one batch; batches may come in any order. Hashes have 128 bits.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fan_in: int = 3) -> None:
        self.spark, self.min_docs, self.fan_in = spark, min_docs, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[Run]] = []

    def runs(self) -> list[Run]:
        return [run for level in self.levels for run in level]

    def _written(self, rows: DataFrame) -> Run:
        """A bucketed and sorted table of ``rows``, which are grouped by hash: joining runs by hash shuffles none of them."""
        run = Run(f"line_run_{uuid.uuid4().hex}", working_folder(self.spark, "line-run"))
        writer = rows.write.format("parquet").option("path", run.path)
        writer.bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(run.table)
        return run

    def _merged(self, runs: list[Run]) -> DataFrame:
        # read as files: Spark 4.1 takes a union of bucketed tables for bucketed, and then reads it without the buckets
        together = self.spark.read.schema(RUN).parquet(*[run.path for run in runs])
        return together.groupBy(*HASH).agg(F.sum("n").alias("n"), F.max("holder").alias("holder"))

    def _forget(self, runs: list[Run]) -> None:
        """Take tables out of the catalog; their files stay in the shared folder, as all written tables do."""
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run.table}")

    def add(self, lines: DataFrame) -> None:
        """Adds the lines of a batch: ``high, low, doc_id, text_hash``. Documents without an id are told apart by text."""
        nameless = F.when(F.col("doc_id").isNull(), F.col("text_hash")).otherwise(F.lit(0))
        once = lines.select(*HASH, "doc_id", nameless.alias("nameless")).distinct()
        own = once.groupBy(*HASH).agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "nameless")).alias("holder"))
        for run in self.runs():
            # what has enough documents in a run, and a later one than all of the batch, needs nothing from it
            known = self.spark.table(run.table).where(F.col("n") >= self.min_docs).select(*HASH, F.col("holder").alias("known_holder"))
            same = [own[h] == known[h] for h in HASH]
            own = own.join(known, [*same, known["known_holder"] >= own["holder"]], "left_anti")
        self._put(self._written(own), 0)

    def _put(self, run: Run, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        full = self.levels[level]
        full.append(run)
        if len(full) == self.fan_in:
            merged = self._written(self._merged(full))
            self.levels[level] = []
            self._forget(full)
            self._put(merged, level + 1)

    def frequent(self) -> DataFrame:
        """``high, low, holder``: hashes that at least ``min_docs`` documents hold, and the last of these documents."""
        found = self._merged(self.runs()).where(F.col("n") >= self.min_docs).select(*HASH, "holder")
        table = stored(found, "frequent-lines")
        self._forget(self.runs())
        self.levels = []
        return table


def _batch_of(rows: DataFrame, batches: int) -> Column:
    """Documents with the largest ids first, in batches of about equal size; those without an id are in the last."""
    shares = [i / batches for i in range(1, batches)]
    bounds = rows.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] if shares else None
    number = sum((F.when(F.col("doc_id") < F.lit(b), 1).otherwise(0) for b in bounds or []), F.lit(0))
    return F.when(F.col("doc_id").isNull(), F.lit(batches - 1)).otherwise(number).cast("int")


def remove_repeated(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 6,
    fan_in: int = 3,
    keep: list[str] | None = None,
) -> DataFrame:
    """Texts without the lines that ``min_docs`` or more documents hold, except in the one with the largest id.

    Lines are compared by their key: blanks (space, tab to carriage return) stripped from both ends, A to Z in lower
    case. Only keys of at least ``min_chars`` code points count. A key that several lines of a document share is found
    in one document, and all of them stay or go. Returns the columns of ``keep`` (all, if not given) and ``n_lines,
    n_dropped, kept``; columns with these names give way.

    Null and empty texts are one empty line. Rows that share an id are one document; rows without an id are documents
    told apart by their text, before all others. Repeated rows stay, an empty table gives an empty one, texts are read
    whole. Ties cannot occur, since the holder is a single document. ``batches`` and ``fan_in`` only decide how the work
    is done: the table is added to the runs in batches by descending id, as if they had arrived one after the other.
    """
    spark = docs.sparkSession
    names = ("own_id", "text_hash", "dropped_numbers", "of_id", "of_text")
    own, hashed, numbers, of_id, of_text = (unused_name(docs, c) for c in names)
    keyed = docs.withColumns({own: F.col(f"`{doc_id}`").cast("long"), hashed: F.xxhash64(F.col(f"`{text}`"))})
    rows = keyed.select(F.col(own).alias("doc_id"), F.col(hashed).alias("text_hash"), F.col(f"`{text}`").alias("text"))
    lines = stored(_lines(rows.withColumn("batch", _batch_of(rows, batches)), min_chars), "lines")
    runs = LineRuns(spark, min_docs, fan_in)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch))
    frequent = runs.frequent()
    release(spark)

    nameless = F.when(F.col("doc_id").isNull(), F.col("text_hash")).otherwise(F.lit(0))
    dropped = (
        lines.join(frequent, HASH)
        .where(F.struct("doc_id", nameless.alias("nameless")) < F.col("holder"))
        .groupBy(F.col("doc_id").alias(of_id), F.col("text_hash").alias(of_text))
        .agg(F.collect_set("number").alias(numbers))
    )
    joined = keyed.join(dropped, F.col(own).eqNullSafe(F.col(of_id)) & (F.col(hashed) == F.col(of_text)), "left")

    def run(texts: list, dropped_numbers: list) -> Iterator[tuple]:
        for t, own_numbers in zip(texts, dropped_numbers):
            every = (t or "").split("\n")
            gone = set(own_numbers or ())
            kept = "\n".join(line for n, line in enumerate(every) if n not in gone) if gone else t or ""
            yield len(every), len(gone), kept

    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("n_lines", "n_dropped", "kept")]
    return map_rows(joined, [text, numbers], run, "n_lines long, n_dropped long, kept string", keep=kept, batch=500)
