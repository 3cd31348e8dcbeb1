"""A smooth cubic surface over a regular lattice, linear across its planes.

Every lattice cell is cut into two triangles by the diagonal between its lower and its upper
corner, and every triangle by its centroid into three cubic pieces that meet with equal
gradients.  The pieces are fitted once per plane and stored as a table of polynomials; a row
then meets its cell in one equality join and evaluates one polynomial of ten terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import as_col
from .water import axis_values, with_position

#: Powers of the cell coordinates (u, v) of each coefficient.
POWERS = [(a, b) for a in range(4) for b in range(4 - a)]
#: Corners (u, v) of the two triangles of a cell.
HALVES = np.array([[(0, 0), (1, 0), (1, 1)], [(0, 0), (1, 1), (0, 1)]], dtype=float)
#: Numbers of the control points of a cubic on a triangle: how often each corner counts.
CONTROLS = [(a, b, 3 - a - b) for a in range(4) for b in range(4 - a)]


def _edges(m: int, n: int) -> np.ndarray:
    """Pairs of node numbers along both axes and the diagonals."""
    at = np.arange(m * n).reshape(m, n)
    sides = [(at[:-1], at[1:]), (at[:, :-1], at[:, 1:]), (at[:-1, :-1], at[1:, 1:])]
    return np.concatenate([np.stack([a.ravel(), b.ravel()], axis=1) for a, b in sides])


def gradients(values: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The gradients at the nodes that make the summed squared second derivative along all edges least.

    Along an edge the surface is the cubic with the given ends and slopes; the sum is a quadratic form of
    all slopes, so its least value is one linear system.
    """
    m, n = values.shape
    edges = _edges(m, n)
    place = np.stack(np.meshgrid(x, y, indexing="ij"), axis=-1).reshape(-1, 2)
    rise = values.ravel()[edges[:, 1]] - values.ravel()[edges[:, 0]]
    along = place[edges[:, 1]] - place[edges[:, 0]]
    weight = np.hypot(*along.T) ** -3.0
    system, right = np.zeros((m * n, 2, m * n, 2)), np.zeros((m * n, 2))
    outer = along[:, :, None] * along[:, None, :] * weight[:, None, None]
    for near, far in (edges.T, edges[:, ::-1].T):
        # entries that meet in one cell are summed
        np.add.at(system, (near, slice(None), near, slice(None)), 4 * outer)
        np.add.at(system, (near, slice(None), far, slice(None)), 2 * outer)
        np.add.at(right, near, 6 * (rise * weight)[:, None] * along)
    return np.linalg.solve(system.reshape(2 * m * n, -1), right.ravel()).reshape(m, n, 2)


def _monomials(points: np.ndarray) -> np.ndarray:
    return np.stack([points[..., 0] ** a * points[..., 1] ** b for a, b in POWERS], axis=-1)


def _to_powers() -> np.ndarray:
    """For every half and third of a cell the matrix from control values to coefficients."""
    share = np.array(CONTROLS) / 3.0
    many = np.array([6.0 / np.prod([(1, 1, 2, 6)[k] for k in c]) for c in CONTROLS])
    basis = many * np.prod(share[:, None, :] ** np.array(CONTROLS)[None], axis=2)
    found = []
    for corners in HALVES:
        centre = corners.mean(axis=0)
        for k in range(3):
            points = share @ np.stack([corners[(k + 1) % 3], corners[(k + 2) % 3], centre])
            found.append(np.linalg.solve(_monomials(points), basis))
    return np.stack(found)


def pieces(values: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients [cell along x, cell along y, piece, power] of the surface in cell coordinates.

    Piece 3 * half + k lies opposite corner k of its triangle.  The derivative across an edge is linear along it, which
    sets the control value next to the edge's middle; those around the centroid are the means that gradients without a jump ask for.
    """
    m, n = values.shape
    slope = gradients(values, x, y)
    place = np.stack(np.meshgrid(x, y, indexing="ij"), axis=-1)
    turn = _to_powers()
    out = np.empty((m - 1, n - 1, 6, len(POWERS)))
    for half, corners in enumerate(HALVES.astype(int)):
        at = [(slice(i, m - 1 + i), slice(j, n - 1 + j)) for i, j in corners]
        v, f, g = ([a[s] for s in at] for a in (place, values, slope))
        centre = sum(v) / 3
        side = {(i, j): f[i] + ((v[j] - v[i]) * g[i]).sum(-1) / 3 for i in range(3) for j in range(3) if i != j}
        inner = [f[i] + ((centre - v[i]) * g[i]).sum(-1) / 3 for i in range(3)]
        middle = []
        for k in range(3):
            i, j = (k + 1) % 3, (k + 2) % 3
            e = v[j] - v[i]
            b = -((centre - v[i]) * e).sum(-1) / (e * e).sum(-1)
            a = -1 - b
            ends = a * (f[i] + side[j, i]) + b * (side[i, j] + f[j]) + inner[i] + inner[j]
            middle.append(ends / 2 - a * side[i, j] - b * side[j, i])
        deep = [(inner[i] + sum(middle[k] for k in range(3) if k != i)) / 3 for i in range(3)]
        heart = sum(deep) / 3
        for k in range(3):
            i, j = (k + 1) % 3, (k + 2) % 3
            control = {(3, 0, 0): f[i], (0, 3, 0): f[j], (0, 0, 3): heart, (2, 1, 0): side[i, j], (1, 2, 0): side[j, i], (2, 0, 1): inner[i],
                       (0, 2, 1): inner[j], (1, 1, 1): middle[k], (1, 0, 2): deep[i], (0, 1, 2): deep[j]}
            out[:, :, 3 * half + k] = np.stack([control[c] for c in CONTROLS], axis=-1) @ turn[3 * half + k].T
    return out


def surface_cells(grid: DataFrame, axes: dict[str, list[float]], plane: str, value: str) -> DataFrame:
    """One row per lattice cell and step between planes: the coefficients on the lower and on the upper plane.

    ``axes`` names the two axes of the surface and then ``plane``.  A plane is fitted in one task; it has as many rows
    as its axes have nodes and its system grows with their square, so axes are lists of tens of values.  A plane that
    lacks a node or holds a NULL there has no surface.  Of repeated nodes the smallest value counts.
    """
    first, second = (d for d in axes if d != plane)
    x, y = np.array(axes[first], dtype=float), np.array(axes[second], dtype=float)
    nodes = with_position(grid, {f"__i_{d}": (d, ax) for d, ax in axes.items()})
    on = F.lit(True)
    for d, ax in axes.items():
        on = on & (F.col(d) == F.element_at(F.array(*map(F.lit, map(float, ax))), F.col(f"__i_{d}") + 1))
    nodes = nodes.where(on).groupBy(*[f"__i_{d}" for d in axes]).agg(F.min(F.col(value).cast("double")).alias("__v"))

    def fit(nodes: pd.DataFrame) -> pd.DataFrame:
        values = np.full((len(x), len(y)), np.nan)
        values[nodes[f"__i_{first}"], nodes[f"__i_{second}"]] = nodes["__v"]
        names = [f"__i_{plane}", f"__i_{first}", f"__i_{second}", "__c"]
        if not np.isfinite(values).all():
            return pd.DataFrame({n: pd.Series([], dtype=object) for n in names})
        found = pieces(values, x, y)
        cells = np.indices(found.shape[:2]).reshape(2, -1)
        return pd.DataFrame(dict(zip(names, (nodes[f"__i_{plane}"].iloc[0], *cells, list(found.reshape(cells.shape[1], -1))), strict=True)))

    fitted = nodes.groupBy(f"__i_{plane}").applyInPandas(fit, f"__i_{plane} int, __i_{first} int, __i_{second} int, __c array<double>")
    index = [f"__i_{plane}", f"__i_{first}", f"__i_{second}"]
    above = fitted.select((F.col(index[0]) - 1).alias(index[0]), *index[1:], F.col("__c").alias("__d"))
    return fitted.join(above, index, "left")


def _polynomial(coefficients: str) -> str:
    """The value at (__u, __v) of the piece whose first coefficient is number __p."""
    terms = [" * ".join([f"get({coefficients}, __p + {n})", *["__u"] * a, *["__v"] * b]) for n, (a, b) in enumerate(POWERS)]
    return " + ".join(terms)


def surface_lookup(
    df: DataFrame, grid: DataFrame, dims: dict[str, Column | str], out: str, plane: str = "teff_k", value: str = "response",
    axes: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Cubic interpolation in two axes and linear between the planes of a third.

    ``dims`` maps the three grid axes to row expressions, ``plane`` names the linear one.  The surface goes through all
    nodes, its gradient has no jump, and a plane of values is met exactly.  Rows outside the lattice, with a NULL, or next to
    a plane without a surface get NULL; on a plane only that plane counts.  Rows are neither multiplied nor moved but for
    the join with the cells.
    """
    axes = axes or {d: axis_values(grid, d) for d in dims}
    first, second = (d for d in axes if d != plane)
    cells = surface_cells(grid, axes, plane, value)
    rows = df.withColumns({f"__x_{d}": as_col(e).cast("double") for d, e in dims.items()})
    rows = with_position(rows, {f"__i_{d}": (f"__x_{d}", ax) for d, ax in axes.items()})
    # the last node of an axis belongs to the cell below it
    rows = rows.withColumns({f"__i_{d}": F.expr(f"CASE WHEN __i_{d} = {len(axes[d]) - 1} THEN __i_{d} - 1 ELSE __i_{d} END") for d in (first, second)})
    limit = {d: F.array(*map(F.lit, map(float, ax))) for d, ax in axes.items()}

    def part(d: str) -> Column:
        low, high = (F.get(limit[d], F.col(f"__i_{d}") + k) for k in (0, 1))
        return F.coalesce((F.col(f"__x_{d}") - low) / (high - low), F.lit(0.0))

    joined = rows.join(cells, [f"__i_{d}" for d in (plane, first, second)], "left")
    joined = joined.withColumns({"__u": part(first), "__v": part(second), "__w": part(plane)})
    # the piece opposite the corner that counts least
    joined = joined.withColumn("__p", F.expr("""10 * CASE
        WHEN __v > __u THEN 3 + CASE WHEN 1 - __v <= least(__u, __v - __u) THEN 0 WHEN __u <= __v - __u THEN 1 ELSE 2 END
        WHEN 1 - __u <= least(__u - __v, __v) THEN 0 WHEN __u - __v <= __v THEN 1 ELSE 2 END"""))
    joined = joined.withColumns({"__low": F.expr(_polynomial("__c")), "__high": F.expr(_polynomial("__d"))})
    mixed = F.expr("CASE WHEN __w = 0 THEN __low ELSE __low + __w * (__high - __low) END")
    return joined.withColumn("__found", mixed).select(*df.columns, F.col("__found").alias(out))
