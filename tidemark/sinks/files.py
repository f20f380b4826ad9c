"""File outputs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks import ordered
from tidemark.sinks.versions import Change, Versions


def write_csv(df: DataFrame, path: str, sep: str = ";", files: int | None = None) -> None:
    """CSV with header, replacing what is there. A number of files suits a small report that is handed on."""
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").options(header="true", sep=sep).csv(path)


def write_report(df: DataFrame, path: str, order: Sequence[Column | str], sep: str = ";", tasks: int = ordered.TASKS) -> None:
    """A report as one sorted CSV file with a header, ``part-00000.csv`` in the folder ``path``.

    ``tasks`` tasks sort and write a range each; their files are joined in order.
    """

    def quoted(name: str) -> str:
        special = any(mark in name for mark in (sep, '"', "\n", "\r"))
        return '"' + name.replace('"', '\\"') + '"' if special else name

    def write_parts(folder: str) -> None:
        ordered.in_ranges(df, order, tasks).write.options(header="false", sep=sep).csv(folder)

    head = sep.join(map(quoted, df.columns)) + "\n"
    ordered.write_single(df.sparkSession, write_parts, f"{path.rstrip('/')}/part-00000.csv", head)


def report_name(input_name: str, run_date: dt.date) -> str:
    """Output name of a request file: its name without ``.csv`` and the day of the run."""
    return f"{input_name.removesuffix('.csv')}_{run_date:%Y-%m-%d}"


def write_parquet(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet; with ``by`` only the partitions that occur in ``df`` are replaced."""
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", kind: str = "versions", batch: str | None = None) -> bool:
    """First load with ``overwrite``, scheduled runs with ``append``; False if ``batch`` was written before.

    The table changes at once, and a failing write leaves it as it was (see :class:`Versions`). ``kind`` may also be any
    installed format that does so itself, which then has no batches.
    """
    if kind != "versions":
        df.write.format(kind).mode(mode).save(path)
        return True
    return Versions(df.sparkSession, path).publish({"rows": Change(df, mode)}, batch)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path`` as :func:`write_table` left it; None if there is none."""
    return Versions(spark, path).read()


def write_sheets(sheets: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Several named datasets below one folder; returns their paths."""
    paths = {name: f"{path.rstrip('/')}/{name.replace(' ', '_')}" for name in sheets}
    for name, df in sheets.items():
        df.write.mode("overwrite").options(header="true").csv(paths[name])
    return paths


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per row; works for any size."""
    df.write.mode("overwrite").json(path)


def as_json_lines(df: DataFrame, column: str = "json") -> DataFrame:
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(column))
