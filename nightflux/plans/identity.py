"""Canonical names and ids of targets (C14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import position_name, repaired_name
from ..operators import registry as R
from ..operators.catalogue import resolve_identity
from ..session import cut


def identify(targets: DataFrame, stacks: DataFrame, id_sources: list[DataFrame], registry: DataFrame) -> DataFrame:
    """Header name, position and id sources to canonical name, id and whether it has run.

    ``targets``(name, ra, dec) with distinct names; ``stacks``(name); each id source (name, id);
    ``registry``(reg_name, reg_id, pos).
    """
    named = targets.withColumn("header_name", F.col("name")).withColumn("name", repaired_name("header_name", position_name("ra", "dec")))
    stacked = cut(R.existing_stack(named.select("name").distinct(), stacks).select("name", "stack_name"))
    ids = resolve_identity(id_sources, "name", "id", named.select("name").distinct())
    known = ids.withColumn("id", F.when(F.col("source") > 0, F.col("id")))
    run = R.registered(known.select("name", "id"), registry)
    return named.join(stacked, "name").join(known.select("name", "id"), "name").join(run.select("name", "already_run", "run_name"), "name")
