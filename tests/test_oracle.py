"""Registered queries against DuckDB on the given tables.

A sample runs by default; NIGHTFLUX_FULL=1 runs every query that has a SQL twin.
"""

import os

import pytest

from nightflux.queries import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("NIGHTFLUX_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = [
    "a02_star_statistics", "a14_ensemble_curve", "a16_time_bin", "w02_rolling_mask", "j11_nearest_time", "j13_interpolate_index", "a35_first_per_time",
    "p01_classify_frames", "a01_class_counts", "j15_bias_look_back", "a05_readout_noise", "a11_stack", "a12_cloud_metric", "j06_crossmatch", "j17_blended",
    "w01_frame_shift", "j01_target_match", "f01_f28_position_names", "j10_append", "a43_flux_change", "a31_line_fit", "a24_night_summary", "p18_log_flags",
    "c12_ledger_table", "s04_path_lists", "s09_pwv_archive", "s15_guiding", "s21_wcs_json", "k06_k12_series_and_masters",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL) if os.environ.get("NIGHTFLUX_FULL") else SAMPLE)
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQL[name])
    want = table([d[0] for d in cur.description], cur.fetchall())
    assert got == want


def test_every_sql_twin_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
