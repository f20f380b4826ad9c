"""Results in order, written by many tasks: sorted ranges, row numbers over them, and single files joined from parts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tidemark.session import stored, working_folder

#: Ranges a result is sorted in.
TASKS = 32


def in_ranges(df: DataFrame, order: Sequence[Column | str], tasks: int = TASKS) -> DataFrame:
    """``df`` sorted by ranges: each task sorts one, and a range is all before the next.

    Rows that ``order`` does not tell apart are ordered by a hash of all columns, so that a value many rows share is
    still dealt to several tasks.
    """
    hashable = [c for c in df.columns if not isinstance(df.schema[c].dataType, MapType)]
    full = [*order, F.xxhash64(*[F.col(f"`{c}`") for c in hashable])]
    return df.repartitionByRange(tasks, *full).sortWithinPartitions(*full)


class Numbered(NamedTuple):
    """``rows`` with their number in ``_row``, from 0 in order; and how many there are."""

    rows: DataFrame
    total: int


def numbered(df: DataFrame, order: Sequence[Column | str], tasks: int = TASKS) -> Numbered:
    """Row numbers without a task that sees all rows: places within a range, and a sum of the ranges before.

    The sorted ranges are written first, so that counting and numbering see the same ones. Only their sizes, at most
    ``tasks``, come to the driver.
    """
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranges = stored(in_ranges(df, order, tasks).withColumns({"_range": F.spark_partition_id(), "_at": at}), "ranges")
    sizes = sorted((r["_range"], r["count"]) for r in ranges.groupBy("_range").count().collect())
    firsts, total = [], 0
    for number, size in sizes:
        firsts.append((number, total))
        total += size
    of_range = df.sparkSession.createDataFrame(firsts, "_range int, _first long")
    rows = ranges.join(F.broadcast(of_range), "_range").withColumn("_row", F.col("_first") + F.col("_at"))
    return Numbered(rows.drop("_range", "_at", "_first"), total)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def write_single(
    spark: SparkSession, write_parts: Callable[[str], None], target: str, head: str = "", tail: str = ""
) -> None:
    """One file from the part files that ``write_parts`` puts into a folder, in order of their names, behind ``head``.

    The file system joins the parts where it can (as HDFS does, without moving data); elsewhere they are streamed into
    one file. ``target`` is replaced in one step, when the new file is whole.
    """
    folder = working_folder(spark, "parts")
    write_parts(folder)
    place, files = _files(spark, folder)
    parts = [s.getPath() for s in files.listStatus(place) if s.getLen() and s.getPath().getName().startswith("part-")]
    parts.sort(key=lambda path: path.getName())
    target_place, target_files = _files(spark, target)
    target_files.mkdirs(target_place.getParent())
    path = spark._jvm.org.apache.hadoop.fs.Path
    draft = path(target_place.getParent(), f".{uuid.uuid4().hex}")
    out = target_files.create(draft, False)
    out.write(bytearray(head.encode()))
    if not _joined(spark, files, target_files, parts, draft, out):
        for part in parts:
            stream = files.open(part)
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
            stream.close()
        out.write(bytearray(tail.encode()))
        out.close()
    elif tail:
        out = target_files.append(draft)
        out.write(bytearray(tail.encode()))
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target_files.getUri(), spark._jsc.hadoopConfiguration())
    kind = spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    options = spark._jvm.java.lang.reflect.Array.newInstance(kind, 1)
    spark._jvm.java.lang.reflect.Array.set(options, 0, spark._jvm.java.lang.Enum.valueOf(kind, "OVERWRITE"))
    context.rename(draft, target_place, options)
    files.delete(place, True)


def _joined(spark: SparkSession, files, target_files, parts: list, draft, out) -> bool:
    """Whether the file system could put the parts behind what was written so far; ``out`` is closed then."""
    if not parts or target_files.getScheme() != "hdfs" or files.getUri() != target_files.getUri():
        return False
    out.close()
    array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts))
    for i, part in enumerate(parts):
        array[i] = part
    target_files.concat(draft, array)
    return True
