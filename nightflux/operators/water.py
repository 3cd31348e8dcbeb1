"""Precipitable water vapour: series cleaning, grid look-up and correction
(A23, A33, A34, A43, F22, J14, J18, W07, C06, C13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.photometry import MEDIAN_FLOOR
from ..session import as_col, cut
from .asof import interpolate, interpolate_index
from .grouped import attach, medians
from .ordered import first_per_time, linked, neighbours

# Fixed values
MIN_PWV_MM = 0.05
MARGIN_DAYS = 2.0 / 24.0
PWV_AXIS = [0.05, 0.1, 0.25, 0.5, 1.0, 1.5, 2.5, 3.5, 5.0, 7.5, 10.0, 20.0, 30.0]
AIRMASS_AXIS = [1.0, 1.1, 1.2, 1.3, 1.4, 1.5, 1.6, 1.7, 1.8, 1.9, 2.0, 2.1, 2.2, 2.3, 2.4, 2.5, 2.6, 2.7, 2.8, 2.9, 3.0]
WAVELENGTH_RANGE_MICRON, WAVELENGTH_STEP = (0.5, 2.0), 0.0001


def remove_peaks(df: DataFrame, keys: Sequence[str], t: str, y: str, prominence: float, reach: int = 1, width: float = 1.0) -> DataFrame:
    """Drop local maxima that stand out from both neighbours, and ``reach`` samples
    either side (W07).

    A sample is dropped when it or one of the samples up to ``reach`` away is a peak;
    neighbours are found across bucket borders, so no series is sorted whole.
    """
    keys = list(keys)
    base = cut(linked(df, keys, t, [y], width))
    higher = F.greatest(F.col("before")[y], F.col("after")[y])
    peak = F.coalesce(
        (F.col(y) > F.col("before")[y]) & (F.col(y) > F.col("after")[y]) & (F.col(y) - higher > prominence), F.lit(False)
    )
    marked = base.withColumn("hit", peak.cast("int")).drop("before", "after")
    for _ in range(reach):
        step = linked(marked, keys, t, ["hit"], width)
        grown = F.greatest("hit", F.coalesce(F.col("before")["hit"], F.lit(0)), F.coalesce(F.col("after")["hit"], F.lit(0)))
        marked = step.withColumn("hit", grown).drop("before", "after")
    return marked.where("hit = 0").drop("hit")


def clean_series(pwv: DataFrame, keys: Sequence[str], t: str, order: Sequence[Column | str]) -> DataFrame:
    """Repeated times dropped, first kept."""
    return first_per_time(pwv, keys, t, order)


def axis_values(grid: DataFrame, name: str) -> list[float]:
    """The sorted values of one grid axis.  The axes of the filter grid are
    fixed lists; callers with another lattice name theirs in ``axes``."""
    return [row[0] for row in grid.select(name).distinct().orderBy(name).collect()]


def _array(values: list[float]) -> str:
    return "array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")"


def with_position(df: DataFrame, axes: dict[str, tuple[str, list[float]]]) -> DataFrame:
    """Index of the last axis value at or below each column, NULL outside the axis.

    ``axes`` maps an index name to a column and its axis.  A binary search written as a
    few projections keeps the generated code short enough to be compiled.
    """
    out = df.withColumns({
        i: F.expr(f"CASE WHEN {c} BETWEEN {float(ax[0])!r}D AND {float(ax[-1])!r}D THEN 0 END") for i, (c, ax) in axes.items()
    })
    step = 1
    while 2 * step < max(len(ax) for _, ax in axes.values()):
        step *= 2
    while step:
        out = out.withColumns({
            i: F.expr(f"{i} + CASE WHEN {c} >= get({_array(ax)}, {i} + {step}) THEN {step} ELSE 0 END")
            for i, (c, ax) in axes.items() if step < len(ax)
        })
        step //= 2
    return out


def lattice_cells(grid: DataFrame, axes: dict[str, list[float]], value: str) -> DataFrame:
    """One row per lattice cell: its index, its limits and its corner values.

    Corners past the last node are only met with weight 0 and hold 0."""
    dims = list(axes)
    nodes = with_position(grid, {f"__i_{d}": (d, axes[d]) for d in dims})
    nodes = nodes.select(*[f"__i_{d}" for d in dims], F.col(value).alias("__v"))
    offsets = F.array(*[F.lit(o) for o in range(2 ** len(dims))])
    spread = nodes.withColumn("__o", F.explode(offsets))
    for b, d in enumerate(dims):
        spread = spread.withColumn(f"__i_{d}", F.col(f"__i_{d}") - F.shiftright("__o", b).bitwiseAND(F.lit(1)))
    inside = " AND ".join(f"__i_{d} >= 0" for d in dims)
    cells = spread.where(inside).groupBy(*[f"__i_{d}" for d in dims]).agg(
        *[F.expr(f"coalesce(max(CASE WHEN __o = {o} THEN __v END), 0.0D)").alias(f"__v{o}") for o in range(2 ** len(dims))]
    )
    for d in dims:
        ax = _array(axes[d])
        cells = cells.withColumn(f"__lo_{d}", F.expr(f"get({ax}, __i_{d})")).withColumn(f"__hi_{d}", F.expr(f"get({ax}, __i_{d} + 1)"))
    return cells


def grid_lookup(
    df: DataFrame, grid: DataFrame, dims: dict[str, Column | str], out: str, value: str = "response",
    axes: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Multilinear interpolation on a regular grid.

    ``dims`` maps grid axes to row expressions.  Each row finds its lattice cell by
    comparing against the axis values and meets the cell's corners in one equality
    join; rows are neither multiplied nor moved.
    Outside the grid the result is NULL.  ``surface.surface_lookup`` is the cubic one.
    """
    axes = axes or {d: axis_values(grid, d) for d in dims}
    cells = lattice_cells(grid, axes, value)
    rows = df
    for d, expr in dims.items():
        rows = rows.withColumn(f"__x_{d}", as_col(expr))
    rows = with_position(rows, {f"__i_{d}": (f"__x_{d}", ax) for d, ax in axes.items()})
    index = [f"__i_{d}" for d in dims]
    joined = rows.join(cells, index, "left")
    joined = joined.withColumns({
        f"__w_{d}": F.expr(f"CASE WHEN __hi_{d} IS NULL THEN 0.0D ELSE (__x_{d} - __lo_{d}) / (__hi_{d} - __lo_{d}) END") for d in dims
    })
    values = [f"__v{o}" for o in range(2 ** len(dims))]
    for d in dims:  # halve the corners axis by axis; the lowest bit belongs to the first axis
        pairs = zip(values[::2], values[1::2])
        columns = {f"__m_{d}_{n}": F.expr(f"{a} + __w_{d} * ({b} - {a})") for n, (a, b) in enumerate(pairs)}
        joined, values = joined.withColumns(columns), list(columns)
    return joined.withColumnRenamed(values[0], out).select(*df.columns, out)


def ensemble_teff(weights: DataFrame, run: Sequence[str]) -> DataFrame:
    """Weighted temperature of the comparison stars that have one.

    Rounding must not carry it past the stars it stands for: at the end of a grid it would have no response.
    """
    ok = weights.where(F.col("teff").isNotNull() & F.col("weight").isNotNull())
    mean = F.sum(F.col("weight") * F.col("teff")) / F.sum("weight")
    counted = F.when(F.col("weight") > 0, F.col("teff"))
    between = F.when(F.min("weight") >= 0, F.greatest(F.min(counted), F.least(F.max(counted), mean))).otherwise(mean)
    return ok.groupBy(*run).agg(F.when(F.sum("weight") != 0, between).alias("ensemble_teff"))


def water_at(target: DataFrame, pwv: DataFrame, keys: Sequence[str], t: str, width: float = 1.0) -> DataFrame:
    """Target rows with ``pwv`` at their time, NULL outside the water series or below 0.05 mm.

    ``pwv`` has t, pwv and those of the ``keys`` that it differs by, perhaps none.  A series (``keys``) takes the samples from
    its first time to its last and a margin of two hours.  No sample is copied to the series that it serves: the value
    at a time is the same for all, so it is found once per distinct time, and the ends of what a series may take are
    two look-ups for each.
    """
    keys = list(keys)
    shared = [c for c in keys if c in pwv.columns]
    pwv = cut(pwv.select(*shared, t, "pwv"))
    times = target.select(*shared, t).distinct()
    found = cut(interpolate(pwv, times, shared, t, "pwv", "pwv", width))
    span = target.groupBy(*keys).agg(F.min(t).alias("__a"), F.max(t).alias("__z"))
    ends = F.array(F.struct(F.lit(0).alias("end"), (F.col("__a") - MARGIN_DAYS).alias("at")), F.struct(F.lit(1).alias("end"), (F.col("__z") + MARGIN_DAYS).alias("at")))
    probes = cut(span.select(*keys, F.explode(ends).alias("__e")).select(*keys, F.col("__e.end").alias("__end"), F.col("__e.at").alias(t)))
    near = neighbours(pwv, probes, shared, t, [], width)
    first = F.when(F.col("prev.t") == F.col(t), F.col("prev.t")).otherwise(F.col("next.t"))
    reach = near.groupBy(*keys).agg(F.max(F.when(F.col("__end") == 0, first)).alias("__w0"), F.max(F.when(F.col("__end") == 1, F.col("prev.t"))).alias("__w1"))
    rows = attach(target.join(found, [*shared, t], "left"), keys, reach)
    usable = F.col(t).between(F.col("__w0"), F.col("__w1")) & (F.col("pwv") >= MIN_PWV_MM)
    return rows.withColumn("pwv", F.when(usable, F.col("pwv"))).drop("__w0", "__w1")


def water_correction(
    target: DataFrame, pwv: DataFrame, grid: DataFrame, keys: Sequence[str], t: str, y: str,
    airmass: str, teff: str, ensemble_temperature: str, width: float = 1.0,
) -> DataFrame:
    """Correct target series for water vapour.

    The water series is interpolated onto the target times (``water_at``), the response of target
    and ensemble is looked up, both are normalised, and the normalised series is
    divided by their ratio.  Times outside the water series (with its margin) or
    below 0.05 mm have no correction and come out NULL.
    """
    keys = list(keys)
    rows = cut(water_at(target, pwv, keys, t, width))
    axes = {d: axis_values(grid, d) for d in ("pwv_mm", "airmass_x", "teff_k")}
    for temperature, out in ((teff, "target_water"), (ensemble_temperature, "ensemble_water")):
        rows = grid_lookup(rows, grid, {"pwv_mm": "pwv", "airmass_x": airmass, "teff_k": temperature}, out, axes=axes)
    rows = cut(rows)
    series = {"__my": y, "__mt": "target_water", "__me": "ensemble_water"}
    scales = medians(rows, keys, {k: F.when(F.col(c) > MEDIAN_FLOOR, F.col(c)) for k, c in series.items()}, stored=True)
    rows = attach(rows, keys, scales)
    ratio = (F.col("target_water") / F.col("__mt")) / (F.col("ensemble_water") / F.col("__me"))
    rows = rows.withColumn("water_ratio", ratio)
    fixed = F.col(y) / F.col("__my") / F.col("water_ratio")
    return rows.withColumn("corrected", F.when(F.col("water_ratio") != 0, fixed)).drop(*series)


def wavelengths(spark, lo: float = WAVELENGTH_RANGE_MICRON[0], hi: float = WAVELENGTH_RANGE_MICRON[1], step: float = WAVELENGTH_STEP) -> DataFrame:
    """The integration grid, one row per wavelength."""
    n = int(round((hi - lo) / step))
    return spark.range(n).select(F.col("id").alias("li"), (lo + F.col("id") * step).alias("wavelength"))


def spectral_response(efficiency: DataFrame, filter_curve: DataFrame, grid: DataFrame, width: float) -> DataFrame:
    """Efficiency times filter on the common grid, positive values only."""
    one = F.lit(1).alias("k")
    e = interpolate_index(efficiency.select(one, "wavelength", "value"), grid.select(one, "*"), ["k"], "wavelength", "value", "eff", width)
    f = interpolate_index(filter_curve.select(one, "wavelength", "value"), grid.select(one, "*"), ["k"], "wavelength", "value", "filt", width)
    both = e.select("li", "wavelength", "eff").join(f.select("li", "filt"), "li")
    return both.withColumn("response", F.col("eff") * F.col("filt")).where(F.col("response") > 0).select("li", "wavelength", "response")


def spectral_integral(samples: DataFrame, keys: Sequence[str], index: str, step: float, value: str, out: str) -> DataFrame:
    """Composite Simpson sum over consecutive samples 0..n-1 per key; where their count
    is even the last interval is a trapezoid (A33)."""
    sizes = samples.groupBy(*keys).agg(F.max(index).alias("__last"))
    rows = attach(samples, keys, sizes, few=True)  # otherwise all samples are shuffled beside it
    i, last = F.col(index), F.col("__last")
    simpson_end = F.when(last % 2 == 0, last).otherwise(last - 1)
    inner = F.when((i == 0) | (i == simpson_end), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0) / 3.0
    coef = F.when(i <= simpson_end, F.when(simpson_end > 0, inner).otherwise(0.0)).otherwise(0.0)
    tail = F.when((last % 2 == 1) & (i >= last - 1), 0.5).otherwise(0.0)
    return rows.groupBy(*keys).agg(F.sum((coef + tail) * F.col(value) * step).alias(out))


def build_grid(response: DataFrame, atmosphere: DataFrame, stars: DataFrame, step: float) -> DataFrame:
    """Response of every (pwv, airmass, teff) node.

    ``response``(li, response), ``atmosphere``(li, pwv_mm, airmass_x, transmission),
    ``stars``(li, teff_k, flux).  Stars are scaled by their maximum over the kept
    wavelengths.  One join on wavelength, one aggregation by node.
    """
    lit = stars.join(response, "li")
    peak = lit.groupBy("teff_k").agg(F.max("flux").alias("__top"))
    star = lit.join(peak, "teff_k").select("li", "teff_k", (F.col("response") * F.col("flux") / F.col("__top")).alias("sr"))
    order = response.select("li").agg(F.min("li").alias("__li0"))
    rows = star.join(atmosphere, "li").crossJoin(F.broadcast(order)).select(
        "pwv_mm", "airmass_x", "teff_k", (F.col("li") - F.col("__li0")).alias("i"),
        (F.col("sr") * F.col("transmission")).alias("v"),
    )
    return spectral_integral(rows, ["pwv_mm", "airmass_x", "teff_k"], "i", step, "v", "response")


def flux_change(grid: DataFrame) -> DataFrame:
    """Change of the response in percent against the driest column, per airmass and teff."""
    dry = grid.groupBy("airmass_x", "teff_k").agg(F.min_by("response", "pwv_mm").alias("__dry"))
    return grid.join(dry, ["airmass_x", "teff_k"]).withColumn(
        "delta_percent", 100.0 * (F.col("response") / F.col("__dry") - 1)
    ).drop("__dry")
