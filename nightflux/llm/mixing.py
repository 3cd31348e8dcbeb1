"""Temperature mixing of sources: exponent by bisection, weights as budgeted block permutations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from nightflux.llm.common import WORD
from nightflux.session import cut

#: Halvings of the exponent's range [0, 1]; LEVELS of them are taken from one aggregation.
HALVINGS, LEVELS = 30, 5


def word_count(text: Column) -> Column:
    """Words of a text: runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def exponent(totals: DataFrame, max_repeats: float | None = None, entropy: float | None = None) -> float:
    """The smallest exponent a in [0, 1] for which shares to the power a meet the target.

    ``totals`` has ``tokens``, one row a source.  ``max_repeats``: no source is read more often than
    this, if the least repeated one is read once.  ``entropy``: the weights' entropy in nats is at most this.
    Both fall or hold as a grows (a = 1: the sources' own shares), so halving finds the border from above; if
    even 1 does not meet the target, 1 it is.  No sources: 1.
    """
    if (max_repeats is None) == (entropy is None):
        raise ValueError("name one target: max_repeats or entropy")
    known = totals.where("tokens > 0").select(F.col("tokens").cast("double").alias("t"))
    known = cut(known.groupBy("t").agg(F.count("*").cast("double").alias("n")))  # equal totals weigh alike
    whole = known.agg(F.sum(F.col("t") * F.col("n"))).first()[0]
    if whole is None:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(HALVINGS // LEVELS):
        steps = 2**LEVELS
        grid = [low + (high - low) * k / steps for k in range(steps)]
        p, a = F.col("t") / F.lit(whole), F.col("a")
        rows = known.select("*", F.explode(F.array(*map(F.lit, grid))).alias("a"))
        sums = rows.groupBy("a").agg(
            F.sum(F.col("n") * F.pow(p, a)).alias("z"), F.sum(F.col("n") * F.pow(p, a) * F.log(p)).alias("s"),
            (F.pow(F.max(p) / F.min(p), 1 - F.max(a))).alias("repeats"))
        met = F.col("repeats") <= max_repeats if max_repeats is not None else F.log("z") - a * F.col("s") / F.col("z") <= entropy
        border = sums.agg(F.min(F.when(met, a))).first()[0]
        at = grid.index(border) if border is not None else steps
        if at == 0:
            return grid[0]
        low, high = grid[at - 1], grid[at] if at < steps else high
    return high


def quotas(totals: DataFrame, a: float, budget: int | None = None) -> DataFrame:
    """Token budget of each source: ``source``, ``tokens``, ``weight``, ``budget``, ``whole`` blocks and ``rest`` of one more block.

    Without ``budget`` the smallest total is taken that reads every source once at least.  A source
    without tokens has weight 0 and is read once (with a given budget too: it costs nothing).
    """
    t = F.col("tokens").cast("double")
    power = totals.withColumn("power", F.when(F.col("tokens") > 0, F.pow(t, F.lit(a))).otherwise(0.0))
    z, unit = power.agg(F.sum("power"), F.max(F.when(F.col("power") > 0, t / F.col("power")))).first()
    z, unit = z or 1.0, unit or 0.0
    share = F.floor(unit * F.col("power") + 1e-6) if budget is None else F.floor(budget * F.col("power") / z)
    own = F.greatest(F.col("tokens"), share) if budget is None else share
    rows = power.select("source", "tokens", (F.col("power") / z).alias("weight"), own.cast("long").alias("budget"))
    none = F.col("tokens") <= 0
    return rows.select(
        "*", F.when(none, 1).otherwise(F.floor(F.col("budget") / F.col("tokens"))).cast("long").alias("whole"),
        F.when(none, 0).otherwise(F.col("budget") % F.col("tokens")).cast("long").alias("rest"))


def order_key(doc_id: Column, block: Column, seed: int) -> Column:
    """Place of a document in the permutation of a block: rows are read by block and then by this key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), block.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def cuts(narrow: DataFrame, quota: DataFrame, seed: int) -> DataFrame:
    """Last key, per source, that its partly read block still takes.

    Two levels keep every group small: sums over the key's first four digits find the digit group in
    which the budget ends, running sums inside that group find the key.
    """
    part = narrow.join(quota.where("rest > 0").select(F.col("source").alias("s"), "whole", "rest"), F.col("source").eqNullSafe(F.col("s")))
    part = part.select("source", "tokens", "rest", order_key(F.col("doc_id"), F.col("whole"), seed).alias("key"))
    part = part.groupBy("source", "rest", "key").agg(F.sum("tokens").alias("tokens"))
    groups = part.groupBy("source", "rest", F.substring("key", 1, 4).alias("digits")).agg(F.sum("tokens").alias("tokens"))
    upto = F.sum("tokens").over(W.partitionBy("source").orderBy("digits"))
    groups = groups.withColumn("upto", upto).where("upto > rest").groupBy("source", "rest").agg(F.min_by(F.struct("digits", (F.col("upto") - F.col("tokens")).alias("before")), "digits").alias("g"))
    groups = cut(groups.select(F.col("source").alias("s"), F.col("g.digits").alias("digits"), F.col("g.before").alias("before")))
    inside = part.join(groups, F.col("source").eqNullSafe(F.col("s")) & (F.substring("key", 1, 4) == F.col("digits")))
    upto = F.col("before") + F.sum("tokens").over(W.partitionBy("source").orderBy("key"))
    last = inside.withColumn("upto", upto).groupBy("source").agg(F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("key"))), F.max("digits")).alias("last"))
    return last


def mix(docs: DataFrame, max_repeats: float | None = None, entropy: float | None = None, budget: int | None = None, seed: int = 1) -> DataFrame:
    """Rows of ``docs`` as the mixture reads them: each row once for each block that takes it.

    Needs ``doc_id``, ``source``, ``text``; adds ``block`` and ``order_key``: reading a source by these two is
    one permutation of it after another, until its budget of tokens (words) is used.  Whole blocks take every
    document; of the last block the keys are taken in order while the running total stays within the budget, so a
    source ends below its budget by less than one document.  Rows with equal id share a key and go together.
    A null source is a source; a null text has no words; an empty table gives an empty result.
    """
    blocked, _ = blocks(docs, max_repeats, entropy, budget, seed)
    return blocked


def blocks(docs: DataFrame, max_repeats: float | None, entropy: float | None, budget: int | None, seed: int) -> tuple[DataFrame, DataFrame]:
    """``mix``'s rows, and the quotas that they follow."""
    narrow = cut(docs.select("doc_id", "source", word_count(F.col("text").cast("string")).alias("tokens")))
    totals = cut(narrow.groupBy("source").agg(F.sum("tokens").alias("tokens")))
    quota = cut(quotas(totals, exponent(totals, max_repeats, entropy), budget))
    last = cuts(narrow, quota, seed)
    rule = cut(quota.join(last.select(F.col("source").alias("s"), "last"), F.col("source").eqNullSafe(F.col("s")), "left").select(F.col("source").alias("_source"), F.col("whole").alias("_whole"), F.col("last").alias("_last")))
    rows = docs.join(rule, F.col("source").eqNullSafe(F.col("_source")))
    upto = F.when(F.col("_last").isNotNull(), F.col("_whole")).otherwise(F.col("_whole") - 1)
    rows = rows.withColumn("_block", F.explode(F.when(upto >= 0, F.sequence(F.lit(0).cast("long"), upto)).otherwise(F.array().cast("array<long>"))))
    rows = rows.withColumn("_key", order_key(F.col("doc_id"), F.col("_block"), seed)).where("_block < _whole or _key <= _last")
    return rows.select(*(docs[c] for c in docs.columns), F.col("_block").alias("block"), F.col("_key").alias("order_key")), quota
