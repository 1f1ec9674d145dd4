"""Session settings and the places that all executors share."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import broadcast

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "quillspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library expects; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a folder of our own only where none is set (tests, local mode)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    own = os.environ.get("QUILLSPARK_SHARED_DIR") or tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def cut(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and go on from the files: survives lost executors, computed once."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What may be broadcast: rows of at most so many bytes as JSON, with `ROW_BYTES` more for each row of a hash table.
LIGHT_BYTES, ROW_BYTES = 8 << 20, 64


def light(df: DataFrame, most: int = LIGHT_BYTES) -> DataFrame:
    """`df` (cut before, so that measuring is cheap) marked for broadcast if its rows take at most `most` bytes; beyond,
    for a sort-merge join, whatever the planner takes its size for. Both ways give the same rows."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))) + ROW_BYTES), F.lit(0))).first()[0]
    return broadcast(df) if size <= most else df.hint("merge")
