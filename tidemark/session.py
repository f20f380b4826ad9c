"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan here is written for. Skewed shuffle joins are split by AQE even when the
# split costs one more exchange: a hot key must never decide the run time of a whole stage.
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings that only take effect when the session is created.
STARTUP_DEFAULTS = {
    "spark.ui.enabled": "false",
    # no _SUCCESS marker beside the written files
    "spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword values (dots written as ``__``) win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME_DEFAULTS, **STARTUP_DEFAULTS}
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def apply_runtime_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime defaults on a session somebody else created."""
    for name, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    A machine-local folder is used only when nothing is configured and the session runs in local mode.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.gettempdir() + "/tidemark"


def working_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and nothing is lost with an executor."""
    path = working_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
