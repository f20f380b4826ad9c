"""Small helpers that several operators share."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.session import working_folder

BATCH_ROWS = 2000


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = working_folder(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are stored; it does so when its objects are collected.

    The first collection only frees what still refers to the last query; the cleaner is a thread that runs after each.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow pass at most ``BATCH_ROWS`` rows at once between Spark and Python; a smaller setting stays.

    Both sides hold whole batches, each more than once: 10,000 texts of some kilobytes make up several hundred megabytes
    in an executor with two tasks.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as ``df`` has such a column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def map_columns(
    df: DataFrame, inputs: list[str], function: Callable[..., Iterable[tuple]], schema: str, batch: int = 200
) -> DataFrame:
    """Call ``function`` with the ``inputs`` columns (lists) of at most ``batch`` rows; it yields tuples of whole columns.

    For output of many small rows: columns may be arrays, so no row is ever an object.
    """
    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, batch):
                part = whole.slice(start, batch)
                for columns in function(*[column.to_pylist() for column in part.columns]):
                    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.select(*[df[f"`{c}`"].alias(f"__in{i}") for i, c in enumerate(inputs)]).mapInArrow(run, out)


def map_rows(
    df: DataFrame,
    inputs: list[str],
    function: Callable[..., Iterable[tuple]],
    schema: str,
    keep: list[str] | None = None,
    batch: int = 1000,
) -> DataFrame:
    """Call ``function`` with the ``inputs`` columns (lists) of at most ``batch`` rows; its tuples become rows.

    With ``keep``, ``function`` has to yield one tuple per input row, and the columns of ``keep`` stand before its own.
    Output goes out in record batches, so a task holds the texts of one batch at a time.
    """
    added = StructType.fromDDL(schema)
    kept = keep or []
    out = StructType([df.schema[c] for c in kept] + added.fields)
    arrow_added, arrow_out = to_arrow_schema(added), to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, batch):
                part = whole.slice(start, batch)
                rows = list(function(*[part.column(i).to_pylist() for i in range(len(kept), part.num_columns)]))
                if not rows:
                    continue
                arrays = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow_added)]
                old = [part.column(i).cast(f.type) for i, f in zip(range(len(kept)), arrow_out)]
                yield pa.RecordBatch.from_arrays(old + arrays, schema=arrow_out)

    quoted = [f"`{c}`" for c in kept]
    picked = df.select(*quoted, *[df[f"`{c}`"].alias(f"__in{i}") for i, c in enumerate(inputs)])
    return picked.mapInArrow(run, out)
