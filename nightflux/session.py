"""Session settings, the shared scratch folder and missing-value ingest."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(app: str = "nightflux", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Adaptive execution splits skewed joins and sizes shuffles, so no partition
    count is fixed here; pass ``spark.sql.shuffle.partitions`` for local runs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as ``spark.checkpoint.dir`` names it.

    Where neither the setting nor a checkpoint folder exists, a local session (tests) gets a folder of
    its own; on a cluster that is an error, as each executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        own = tempfile.mkdtemp(prefix="nightflux-")
        spark.sparkContext.setCheckpointDir(own)
        spark.conf.set("spark.checkpoint.dir", own)
        return own
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write a Parquet table in the shared folder and read it back.

    Unlike a checkpoint the table keeps column pruning, filter pushdown and a known
    size, so later joins can choose to broadcast it.  It survives lost executors.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are NULL everywhere in this library; ingest maps NaN to NULL."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def as_col(value: Column | str | float | int) -> Column:
    """A column from a column, a column name or a number."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(float(value))
