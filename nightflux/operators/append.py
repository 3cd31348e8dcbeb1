"""Idempotent appends and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_rows(stored: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet; equality is exact."""
    return incoming.join(stored.select(*key).distinct(), list(key), "left_anti")


def merged(stored: DataFrame, incoming: DataFrame, key: Sequence[str], replace: bool = False) -> DataFrame:
    """Stored rows plus new ones; with ``replace`` the incoming version wins."""
    if replace:
        return stored.join(incoming.select(*key).distinct(), list(key), "left_anti").unionByName(incoming, allowMissingColumns=True)
    return stored.unionByName(new_rows(stored, incoming, key), allowMissingColumns=True)


def append_action(stored: DataFrame, incoming: DataFrame, key: Sequence[str], groups: Sequence[str] = (), replace: bool = False) -> DataFrame:
    """none, add, append or replace, from how many incoming rows are stored."""
    mark = stored.select(*key).distinct().withColumn("__s", F.lit(1))
    counts = incoming.join(mark, list(key), "left").groupBy(*groups).agg(
        F.count("*").alias("n_new"), F.count("__s").alias("n_stored")
    )
    overlap_all = "replace" if replace else "none"
    overlap_some = "replace" if replace else "append"
    action = (
        F.when(F.col("n_stored") == F.col("n_new"), overlap_all)
        .when(F.col("n_stored") == 0, "add").otherwise(overlap_some)
    )
    return counts.withColumn("action", action)


def common_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids in both."""
    return a.select(key).intersect(b.select(key))


def without(df: DataFrame, removed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not removed."""
    return df.join(removed.select(*key).distinct(), list(key), "left_anti")
