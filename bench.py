"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from nightflux.session import build_session
from nightflux.queries import QUERIES

HEADLINE = [
    "diff_lightcurve_binned",
    "a02_star_statistics",
    "a16_time_bin",
    "a20_best_aperture",
    "a03_sigma_clip",
    "w02_rolling_mask",
    "j12_interpolate_keyed",
    "j14_grid_lookup",
    "j15_w05_flat_look_back",
    "a01_class_counts",
    "a04_master_bias",
    "a11_stack",
    "j06_crossmatch",
    "j10_append",
    "a24_night_summary",
    "c12_qc_ledger",
    "p18_log_flags",
    "a41_aperture_photometry",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "nightflux-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        cold[name], times[name] = round(runs[0], 3), round(min(runs), 3)
    print(json.dumps({
        "metric": "headline queries, warm seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "cold": cold, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
