"""Single JSON documents for a report client, written as fragments that many tasks make.

A fragment is some text of the document; fragments in the order of ``place`` are the document, with white space between
them at most. No task and no row ever holds more than one fragment.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks import ordered

#: Entries of a fragment.
ENTRIES = 5000
KEEP_NULLS = {"ignoreNullFields": "false"}


def _framed(entries: DataFrame, total: int, frames: Sequence[tuple[str, str]], size: int) -> DataFrame:
    """``place, fragment`` from ``_list, _row, _entry``: lists of ``total`` entries each, between their frames."""
    spark = entries.sparkSession
    if not total:
        text = "".join(before + after for before, after in frames)
        return spark.createDataFrame([([0, 0], text)], "place array<long>, fragment string")
    chunk = F.floor(F.col("_row") / size).alias("_chunk")
    texts = entries.groupBy("_list", chunk).agg(F.sort_array(F.collect_list(F.struct("_row", "_entry"))).alias("_entries"))
    joined = F.array_join(F.transform("_entries", lambda e: e["_entry"]), ",")
    of_list = spark.createDataFrame([(i, *frame) for i, frame in enumerate(frames)], "_list int, _before string, _after string")
    before = F.when(F.col("_chunk") == 0, F.col("_before")).otherwise(",")
    after = F.when(F.col("_chunk") == (total - 1) // size, F.col("_after")).otherwise("")
    return texts.join(F.broadcast(of_list), "_list").select(
        F.array(F.col("_list").cast("long"), "_chunk").alias("place"), F.concat(before, joined, after).alias("fragment")
    )


def slicer_document(catalogue: DataFrame, envelope: str = "parameters", size: int = ENTRIES) -> DataFrame:
    """Fragments of ``{"<envelope>": [...]}`` with the rows of the catalogue, by its columns."""
    rows, total = ordered.numbered(catalogue, catalogue.columns)
    entry = F.to_json(F.struct(*[F.col(f"`{c}`") for c in catalogue.columns]))
    entries = rows.select(F.lit(0).alias("_list"), "_row", entry.alias("_entry"))
    return _framed(entries, total, [("{" + json.dumps(envelope, ensure_ascii=False) + ":[", "]}")], size)


def column_document(df: DataFrame, order: Sequence[Column | str], size: int = ENTRIES) -> DataFrame:
    """Fragments of ``{"data": [{column: {row number: value}}]}``, rows numbered from 0 in ``order``."""
    rows, total = ordered.numbered(df, order)

    def value(column: str) -> Column:
        # the value as it stands in an object of its own, without the object
        shown = F.to_json(F.struct(F.col(f"`{column}`").alias("v")), KEEP_NULLS)
        bare = F.substr(shown, F.lit(6), F.char_length(shown) - 6)
        return F.concat(F.lit('"'), F.col("_row").cast("string"), F.lit('":'), bare)

    each = F.array(*[F.struct(F.lit(i).alias("_list"), value(c).alias("_entry")) for i, c in enumerate(df.columns)])
    entries = rows.select("_row", F.explode(each).alias("_cell")).select("_cell._list", "_row", "_cell._entry")
    last = len(df.columns) - 1
    frames = [
        (('{"data":[{' if i == 0 else ",") + json.dumps(c, ensure_ascii=False) + ":{", "}}]}" if i == last else "}")
        for i, c in enumerate(df.columns)
    ]
    return _framed(entries, total, frames, size)


def write_document(fragments: DataFrame, path: str, tasks: int = ordered.TASKS) -> None:
    """The document as one file; a line feed stands behind each fragment."""

    def write_parts(folder: str) -> None:
        ordered.in_ranges(fragments, ["place"], tasks).select("fragment").write.text(folder)

    ordered.write_single(fragments.sparkSession, write_parts, path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """``document``: a written document as a client gets it, without the line feeds between fragments."""
    return spark.read.text(path, wholetext=True).select(F.translate("value", "\n", "").alias("document"))
