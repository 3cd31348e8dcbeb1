"""The cubic water surface."""

import math

import numpy as np
from pyspark.sql import functions as F

from nightflux.operators import surface as S

X, Y = np.array([0.0, 1.0, 2.5, 3.0, 5.0, 6.0]), np.array([0.0, 0.5, 1.5, 2.0, 3.0])
VALUES = np.exp(-0.2 * X[:, None] * (1 + Y[None])) + 0.1 * np.sin(X[:, None])


def evaluate(cells, i, j, piece, u, v):
    return sum(cells[i, j, piece, n] * u**a * v**b for n, (a, b) in enumerate(S.POWERS))


def energy(slopes, values):
    """The summed squared second derivative along the edges, by integration."""
    t = (np.arange(200) + 0.5) / 200
    total = 0.0
    for a, b in S._edges(*values.shape):
        pa, pb = (np.array([X[k // len(Y)], Y[k % len(Y)]]) for k in (a, b))
        length, along = np.hypot(*(pb - pa)), pb - pa
        rise, sa, sb = values.ravel()[b] - values.ravel()[a], slopes.reshape(-1, 2)[a] @ along, slopes.reshape(-1, 2)[b] @ along
        bend = (6 - 12 * t) * rise + (6 * t - 4) * sa + (6 * t - 2) * sb
        total += (bend**2).mean() / length**3
    return total


def test_gradients_have_the_least_bending():
    best = S.gradients(VALUES, X, Y)
    least, rng = energy(best, VALUES), np.random.default_rng(5)
    assert all(energy(best + rng.normal(0, 0.01, best.shape), VALUES) > least for _ in range(10))


def test_a_plane_is_met_exactly():
    plane = 2.0 - 0.3 * X[:, None] + 0.7 * Y[None]
    assert np.allclose(S.gradients(plane, X, Y), [-0.3, 0.7], atol=1e-9)
    cells = S.pieces(plane, X, Y)
    for p, (u, v) in ((0, (0.9, 0.5)), (2, (0.5, 0.1)), (3, (0.4, 0.9)), (4, (0.1, 0.5))):
        want = 2.0 - 0.3 * (X[2] + u * 0.5) + 0.7 * (Y[1] + v * 1.0)
        assert abs(evaluate(cells, 2, 1, p, u, v) - want) < 1e-9


def test_pieces_meet_in_value_and_gradient():
    cells = S.pieces(VALUES, X, Y)
    h = 1e-5

    def slope(i, j, p, u, v):
        wide, high = X[i + 1] - X[i], Y[j + 1] - Y[j]
        return np.array([(evaluate(cells, i, j, p, u + h, v) - evaluate(cells, i, j, p, u - h, v)) / (2 * h * wide),
                         (evaluate(cells, i, j, p, u, v + h) - evaluate(cells, i, j, p, u, v - h)) / (2 * h * high)])

    def same(a, b):
        assert abs(evaluate(cells, *a) - evaluate(cells, *b)) < 1e-10
        assert np.allclose(slope(*a), slope(*b), atol=1e-6)

    for i in range(len(X) - 1):
        for j in range(len(Y) - 1):
            for s in (0.0, 0.2, 0.5, 0.9):
                same((i, j, 1, s, s), (i, j, 5, s, s))  # across the diagonal
                if i + 2 < len(X):
                    same((i, j, 0, 1.0, s), (i + 1, j, 4, 0.0, s))
                if j + 2 < len(Y):
                    same((i, j, 3, s, 1.0), (i, j + 1, 2, s, 0.0))
            for half, corners in enumerate(S.HALVES):  # inside a triangle, from the centroid to the corners
                centre = corners.mean(axis=0)
                for k in range(3):
                    for s in (0.0, 0.3, 0.8):
                        at = centre + s * (corners[k] - centre)
                        same((i, j, 3 * half + (k + 1) % 3, *at), (i, j, 3 * half + (k + 2) % 3, *at))
            for k, p in enumerate((1, 0, 3, 4)):
                u, v = ((0, 0), (1, 0), (1, 1), (0, 1))[k]
                assert abs(evaluate(cells, i, j, p, u, v) - VALUES[i + u, j + v]) < 1e-10


def test_lookup_follows_a_smooth_surface(spark):
    """Nodes are met, edges of the lattice too, outside and missing values are NULL, the planes mix linearly, repeated rows stay."""
    x, y, t = [0.5 * k for k in range(13)], [1 + 0.2 * k for k in range(11)], [2000.0, 2500.0, 3500.0]

    def truth(p, a, k):
        return math.exp(-0.1 * p * a) * k / 2000

    grid = [(p, a, k, truth(p, a, k)) for p in x for a in y for k in t]
    grid = spark.createDataFrame(grid + grid[:3], "pwv_mm double, airmass_x double, teff_k double, response double")
    rows = [(0.0, 1.0, 2000.0), (6.0, 3.0, 3500.0), (3.0, 1.4, 2500.0), (2.21, 1.57, 2300.0), (2.21, 1.57, 2300.0), (3.9, 2.71, 3100.0),
            (6.1, 2.0, 2500.0), (1.0, 0.9, 2500.0), (1.0, 2.0, 3501.0), (None, 2.0, 2500.0), (1.3, None, 2500.0), (1.3, 2.0, None)]
    df = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], "n int, p double, a double, k double")
    dims = {"pwv_mm": "p", "airmass_x": "a", "teff_k": "k"}
    axes = {"pwv_mm": x, "airmass_x": y, "teff_k": t}
    got = {row.n: row.v for row in S.surface_lookup(df, grid, dims, "v", axes=axes).collect()}
    assert len(got) == len(rows) and all(got[n] is None for n in range(6, 12))
    for n in range(6):
        p, a, k = rows[n]
        low = max(z for z in t if z <= k)
        high = min(z for z in t if z >= k)
        want = truth(p, a, low) if low == high else truth(p, a, low) + (k - low) / (high - low) * (truth(p, a, high) - truth(p, a, low))
        assert abs(got[n] - want) < (1e-9 if n < 3 else 2e-4)
    holed = grid.where("not (pwv_mm = 3.0 and airmass_x = 2.0 and teff_k = 2500.0)")
    got = {row.n: row.v for row in S.surface_lookup(df, holed, dims, "v", axes=axes).collect()}
    assert [n for n in range(6) if got[n] is None] == [2, 3, 4, 5]
    assert S.surface_lookup(df, grid.where(F.lit(False)), dims, "v", axes=axes).where("v is not null").count() == 0
