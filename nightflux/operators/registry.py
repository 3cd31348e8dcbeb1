"""Target names and the registry of targets already run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import NAME_PREFIX
from ..session import cut
from .ordered import running

NEIGHBOUR_STEPS = [-2, -1, 0, 1, 2]


def neighbour_names(targets: DataFrame, name: str = "name") -> DataFrame:
    """The 24 names one or two digits away in ra or dec, zero padding kept.

    ``order`` is the order in which they are tried: ra alone, dec alone, then both.
    """
    parts = targets.withColumn("__p", F.regexp_extract(name, r"^..(\d{1,6})([+-])(\d{1,6})$", 1)).where("__p <> ''")
    ra = F.col("__p").cast("int")
    dec = F.regexp_extract(name, r"[+-](\d{1,6})$", 1)
    sign = F.regexp_extract(name, r"([+-])\d{1,6}$", 1)
    steps = F.array(*[F.lit(s) for s in NEIGHBOUR_STEPS])
    grid = parts.withColumn("__a", F.explode(steps)).withColumn("__d", F.explode(steps)).where("__a <> 0 OR __d <> 0")
    group = F.when(F.col("__d") == 0, 0).when(F.col("__a") == 0, 1).otherwise(2)
    ra_new, dec_new = ra + F.col("__a"), dec.cast("int") + F.col("__d")

    def digits(value, like):
        return F.lpad(value.cast("string"), F.length(like), "0")

    return grid.where((ra_new >= 0) & (dec_new >= 0)).select(
        *targets.columns,
        F.concat(F.lit(NAME_PREFIX), digits(ra_new, F.col("__p")), sign, digits(dec_new, dec)).alias("candidate"),
        (group * 100 + (F.col("__a") + 2) * 5 + F.col("__d") + 2).alias("order"),
    )


def existing_stack(targets: DataFrame, stacks: DataFrame, name: str = "name") -> DataFrame:
    """A target's stack under a neighbouring name; the last hit in order wins, else its own."""
    hits = neighbour_names(targets, name).join(stacks.select(F.col("name").alias("candidate")).distinct(), "candidate")
    best = hits.groupBy(name).agg(F.max_by("candidate", "order").alias("stack_name"), F.count("*").alias("n_hits"))
    return targets.join(best, name, "left").withColumn("stack_name", F.coalesce("stack_name", F.col(name)))


def substring_grams(text: str, length: str):
    """All substrings of a given length of a name: where a registered name could sit."""
    start = F.sequence(F.lit(1), F.length(text) - F.col(length) + 1)
    return F.transform(start, lambda i: F.substring(F.col(text), i, F.col(length)))


def registered(targets: DataFrame, registry: DataFrame) -> DataFrame:
    """Whether a target has run: name or id equal, else a registered name inside its
    name, first by list order (J19).

    ``targets``(name, id); ``registry``(reg_name, reg_id, pos).  Containment is an
    equality join on the substrings of the lengths that registered names have.  A registered name takes part
    once, at its first place, and substrings are only taken where the start of some registered name stands.
    """
    by_name = targets.join(registry.select(F.col("reg_name").alias("name")).distinct().withColumn("__n", F.lit(True)), "name", "left")
    by_both = by_name.join(registry.where("reg_id IS NOT NULL").select(F.col("reg_id").alias("id")).distinct().withColumn("__i", F.lit(True)), "id", "left")
    same = F.coalesce("__n", "__i", F.lit(False))
    listed = cut(registry.where("reg_name IS NOT NULL").groupBy("reg_name").agg(F.min("pos").alias("pos")))
    lengths = listed.select(F.length("reg_name").alias("__len")).distinct()  # a few dozen name lengths
    shortest = lengths.agg(F.min("__len").alias("__min"))
    stems = listed.crossJoin(F.broadcast(shortest)).select(F.substring("reg_name", F.lit(1), F.col("__min")).alias("__stem")).distinct()
    starts = targets.select("name").distinct().crossJoin(F.broadcast(shortest)).where(F.col("__min") <= F.length("name"))
    starts = starts.select("name", F.posexplode(substring_grams("name", "__min")).alias("__at", "__stem"))
    likely = starts.join(stems, "__stem", "left_semi").join(F.broadcast(lengths), F.col("__at") + F.col("__len") <= F.length("name"))
    grams = likely.select("name", F.substring("name", F.col("__at") + 1, F.col("__len")).alias("reg_name"))
    inside = grams.join(listed, "reg_name").groupBy("name").agg(F.min_by("reg_name", "pos").alias("__inside"))
    out = by_both.join(inside, "name", "left")
    return out.select(
        *targets.columns, (same | F.col("__inside").isNotNull()).alias("already_run"),
        F.when(same, F.col("name")).otherwise(F.coalesce("__inside", F.col("name"))).alias("run_name"),
    )


def build_registry(outputs: DataFrame, target_list: DataFrame, stacks: DataFrame, filters: list[str]) -> DataFrame:
    """Distinct targets of the outputs in allowed filters with their listed name, else the
    stack's, else 'unknown' (J22, S23, U03, O11)."""
    ids = outputs.where(F.col("filter").isin(filters)).select("id").distinct()
    listed = target_list.groupBy("id").agg(F.min(F.upper("name")).alias("__listed"))
    stacked = stacks.groupBy("id").agg(F.min(F.upper("name")).alias("__stack"))
    named = ids.join(listed, "id", "left").join(stacked, "id", "left")
    return named.select("id", F.coalesce("__listed", "__stack", F.lit("unknown")).alias("name"))


def numbered_registry(registry: DataFrame) -> DataFrame:
    """The registry in name order with positions."""
    return running(registry, [], ["name", "id"], {}, number="pos")
