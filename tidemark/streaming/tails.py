"""Files that are still being written: a run takes the complete lines behind those that were taken before.

The ledger holds, for each file, how many bytes were taken and a hash of the last line among them. A file whose last
taken line is no longer where it was has shrunk or was replaced: it is taken anew, as the next generation of the file.
Files that are gone, or empty, keep the lines that were taken.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stored

LEDGER = "log_file string, generation int, size long, modified timestamp, taken long, last_start long, last_hash long"


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """``log_file, size, modified`` of all files of a folder tree; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    of_file = ("file_path", "log_file"), ("file_size", "size"), ("file_modification_time", "modified")
    return files.select(*[F.col(f"_metadata.{source}").alias(name) for source, name in of_file])


def _changed(spark: SparkSession, folder: str, ledger: DataFrame | None) -> DataFrame:
    """Files that are not in the ledger as they are now, with what was taken of them."""
    known = spark.createDataFrame([], LEDGER) if ledger is None else ledger
    before = known.withColumnsRenamed({"size": "_size", "modified": "_modified"})
    joined = listed(spark, folder).join(before, "log_file", "left")
    same = (F.col("size") == F.col("_size")) & (F.col("modified") == F.col("_modified"))
    return joined.where(~F.coalesce(same, F.lit(False))).drop("_size", "_modified")


def _lines(spark: SparkSession, folder: str, files: list[str]) -> DataFrame:
    """The lines of some files, with the block of the file each was read with. Other files are not opened."""
    raw = spark.read.options(lineSep="\n", recursiveFileLookup="true").text(folder)
    return raw.where(F.col("_metadata.file_path").isin(files)).select(
        F.col("_metadata.file_path").alias("log_file"),
        F.col("_metadata.file_block_start").alias("block"),
        (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")).alias("block_end"),
        F.col("_metadata.file_size").alias("size_read"),
        "value",
        (F.octet_length("value") + F.lit(1).cast("long")).alias("length"),
        F.monotonically_increasing_id().alias("seq"),
    )


def _with_place(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """``start`` and ``end`` of each line in its file. A block is sorted on its own; earlier ones only count."""
    within = Window.partitionBy("log_file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("first") + F.sum("length").over(within)
    return lines.join(blocks, ["log_file", "block"]).withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))


class Taken(NamedTuple):
    """New ``lines`` (``log_file, generation, value``), the ``ledger`` as it will be, the generations of files that no
    longer count (``log_file, generation``), and the ``files`` that had changed."""

    lines: DataFrame
    ledger: DataFrame
    given_up: DataFrame
    files: list[str]


def take_lines(spark: SparkSession, folder: str, ledger: DataFrame | None) -> Taken | None:
    """What has come since the ledger was written; None if no file has changed.

    A last line without its line feed is left for a later run. Nothing is recorded here:
    lines and ledger have to be committed together. The names of changed files come to the driver, which lists them
    anyway; lines do not.
    """
    changed = stored(_changed(spark, folder, ledger), "changed-files")
    files = [row.log_file for row in changed.select("log_file").collect()]
    if not files:
        return None
    lines = _lines(spark, folder, files)
    in_order = Window.partitionBy("log_file").orderBy("block")
    sizes = lines.groupBy("log_file", "block").agg(F.sum("length").alias("bytes"))
    first = F.sum("bytes").over(in_order) - F.col("bytes")
    blocks = stored(sizes.select("log_file", "block", first.alias("first")), "line-blocks")

    # the last line taken must stand where it stood; only the block that holds it is read
    known = changed.where("taken > 0")
    holding = lines.join(known.select("log_file", "taken", "last_start", "last_hash"), "log_file").where(
        "block <= last_start AND last_start <= block_end"
    )
    unchanged = (
        _with_place(holding, blocks)
        .where((F.col("start") == F.col("last_start")) & (F.col("end") == F.col("taken")))
        .where(F.xxhash64("value") == F.col("last_hash"))
        .select("log_file", F.lit(True).alias("unchanged"))
    )
    state = stored(
        changed.join(unchanged, "log_file", "left").select(
            "log_file", "size", "modified",
            F.when(F.col("unchanged"), F.col("taken")).otherwise(F.lit(0)).alias("from"),
            F.when(F.col("unchanged"), F.col("last_start")).alias("last_start"),
            F.when(F.col("unchanged"), F.col("last_hash")).alias("last_hash"),
            F.col("generation").alias("before"),
            # a file of which nothing was taken yet has no generation to give up
            F.when(F.col("generation").isNull(), 0).when(F.col("unchanged") | (F.col("taken") == 0), F.col("generation"))
            .otherwise(F.col("generation") + 1).alias("generation"),
        ),
        "file-states",
    )

    later = lines.join(state.select("log_file", "from", "generation"), "log_file").where(F.col("block_end") >= F.col("from"))
    placed = _with_place(later, blocks).where((F.col("start") >= F.col("from")) & (F.col("end") <= F.col("size_read")))
    new = stored(placed.select("log_file", "generation", "start", "end", "value"), "new-lines")

    last = new.groupBy("log_file").agg(
        F.max("end").alias("_end"), F.max("start").alias("_start"), F.max_by(F.xxhash64("value"), "start").alias("_hash")
    )
    updated = state.join(last, "log_file", "left").select(
        "log_file", "generation", "size", "modified", F.coalesce("_end", "from").alias("taken"),
        F.coalesce("_start", "last_start").alias("last_start"), F.coalesce("_hash", "last_hash").alias("last_hash"),
    )
    if ledger is not None:
        updated = updated.unionByName(ledger.join(state.select("log_file"), "log_file", "left_anti"))
    given_up = state.where("before < generation").select("log_file", F.col("before").alias("generation"))
    return Taken(new.select("log_file", "generation", "value"), updated, given_up, sorted(files))
