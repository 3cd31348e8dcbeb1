"""Writers of lists, condensed nights, products and ledgers."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JD_OFFSET = 2450000.0
TABLES_AT_ONCE = 4
FLAT_COLUMNS = ["jd", "diff", "error", "x", "y", "airmass", "fwhm", "sky", "exposure", "ra_move", "dec_move", "flux", "ensemble", "mask"]


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite", dynamic: bool = True, sort: Sequence[str] = ()
) -> None:
    """Write by partition columns, rows optionally sorted inside the files.

    A rebalance before the write packs small partitions and splits a partition that
    holds a large share of the rows over several tasks.
    """
    out = df.hint("rebalance", *[F.col(c) for c in by])
    if sort:
        out = out.sortWithinPartitions(*by, *sort)
    writer = out.write.mode(mode).partitionBy(*by)
    if dynamic and mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_frame_lists(classed: DataFrame, path: str) -> None:
    """Frame lists per class, filter and field.

    Class and filter are partitions; fields, of which a survey has very many, are
    sorted inside the files so that one field's list is found by the column statistics.
    """
    write_partitioned(classed.select("path", "class", "field", "filter"), path, ["class", "filter"], sort=["field", "path"])


def write_night(lc: DataFrame, path: str) -> None:
    """Nightly output; rewriting a night replaces that night only."""
    write_partitioned(lc, path, ["target", "filter", "date"])


def append_new(new: DataFrame, path: str, key: Sequence[str], by: Sequence[str]) -> None:
    """Append rows whose key is not stored yet."""
    from ..operators.append import new_rows

    stored = new.sparkSession.read.parquet(path)
    write_partitioned(new_rows(stored, new, key), path, by, mode="append")


def write_products(tables: dict[str, DataFrame], path: str, run: Sequence[str], folders: Sequence[str] | None = None) -> None:
    """One table per product (light curves, errors, catalogue, weights, ...), by run.

    ``folders`` names the run columns that become partitions, all of them if it is not given.  A job over very many
    runs names those with few values: the runs are sorted inside the files, where column statistics find one,
    so files grow with the rows and not with the runs.  The tables do not depend on each other and are written side by side.
    """
    by = list(run if folders is None else folders)
    inside = [c for c in run if c not in by]

    def write(name: str) -> None:
        write_partitioned(tables[name], f"{path}/{name}", by, sort=inside)

    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        list(pool.map(write, tables))


def write_flat_text(curves: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """Flat light-curve text of fourteen columns, times minus 2450000.

    With ``keys`` many curves share the files, their keys in front.
    """
    out = curves.withColumn("jd", F.col("jd") - JD_OFFSET).select(*keys, *FLAT_COLUMNS)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_curves(curves: DataFrame, path: str, keys: Sequence[str], t: str = "jd") -> None:
    """All series of light curves, each in time order inside its file."""
    ranged = curves.repartitionByRange(*keys, t).sortWithinPartitions(*keys, t)
    ranged.write.mode("overwrite").parquet(path)


def write_pwv(series: dict[str, DataFrame], path: str, keys: Sequence[str] = ()) -> None:
    """Original, processed and interpolated water series as partitions ``kind``, rows named by ``keys`` (target, night; K06)."""
    whole = None
    for kind, df in series.items():
        part = df.select(*keys, "jd", "pwv").withColumn("kind", F.lit(kind))
        whole = part if whole is None else whole.unionByName(part)
    write_partitioned(whole, path, ["kind"])


def write_masters(masters: dict[str, DataFrame], path: str) -> None:
    """Masters as (kind, filter, y, x, value)."""
    whole = None
    for kind, df in masters.items():
        part = df.select(F.lit(kind).alias("kind"), "filter", "y", "x", F.col(kind).alias("value"))
        whole = part if whole is None else whole.unionByName(part)
    write_partitioned(whole, path, ["kind", "filter"])


def write_sorted(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Registry in order (K13, O11): a range-partitioned sort."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)
