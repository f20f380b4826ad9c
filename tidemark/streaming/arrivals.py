"""What has arrived in a drop folder.

A ledger table holds path and modification time of every file that was taken. A file that is delivered again under its
old name is a new arrival. Files are recorded and put away only after their output is committed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import open_if_there


def listed(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``path, modificationTime`` of the files there; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "modificationTime")


def waiting(spark: SparkSession, folder: str, ledger: str, pattern: str = "*.csv") -> DataFrame:
    """The files that are not in the ledger as they are now."""
    there = listed(spark, folder, pattern)
    taken = open_if_there(spark, ledger, "parquet")
    return there if taken is None else there.join(taken, ["path", "modificationTime"], "left_anti")


def move(spark: SparkSession, path: str, target: str | None) -> None:
    """Put a file or folder at ``target``, replacing what is there; without a target it is deleted."""
    jvm = spark._jvm
    source = jvm.org.apache.hadoop.fs.Path(path)
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if target is None:
        system.delete(source, True)
        return
    place = jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(place.getParent())
    system.delete(place, True)
    if not system.rename(source, place):
        raise OSError(f"{path} could not be moved to {target}")


def take(
    spark: SparkSession,
    folder: str,
    ledger: str,
    process: Callable[[list[str]], list[str]],
    archive: str | None = None,
    delete: bool = False,
) -> list[str]:
    """Hand all waiting files to ``process``, which returns the paths it is done with; record them and put them away.

    A file that changes meanwhile stays where it is and is a new arrival. If ``process`` fails nothing is recorded.
    """
    times = {row["path"]: row["modificationTime"] for row in waiting(spark, folder, ledger).collect()}
    if not times:
        return []
    done = process(sorted(times))
    if done:
        rows = [(path, times[path]) for path in done]
        spark.createDataFrame(rows, "path string, modificationTime timestamp").coalesce(1).write.mode("append").parquet(ledger)
    if done and (archive or delete):
        now = {row["path"]: row["modificationTime"] for row in listed(spark, folder).collect()}
        for path in done:
            if now.get(path) == times[path]:
                name = path.rsplit("/", 1)[-1]
                move(spark, path, f"{archive.rstrip('/')}/{name}" if archive else None)
    return done
