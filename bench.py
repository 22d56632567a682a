"""Benchmark: wall-clock seconds per headline query.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints ONE JSON line.

Timed in order:
1. the warehouse build, layer by layer (bronze feeds, silver
   ``fct_telemetry_laps`` and ``fct_telemetry_enriched``, every gold
   table) - each written to parquet under the checkpoint folder;
2. headline queries from the registry, each executed in full (``noop``
   sink: every row computed, nothing collected).  They read the written
   layers below their own step, as serving queries read warehouse tables;
3. parameterised dashboard calls (one race, three drivers / one lap),
   collected - the shape of the reference's serving queries.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trackline.plans import repository  # noqa: E402
from trackline.plans.materialize import lakehouse_for  # noqa: E402
from trackline.plans.models import GOLD, SILVER  # noqa: E402
from trackline.queries.registry import QUERIES  # noqa: E402
from trackline.session import build_session, checkpoint_root  # noqa: E402

HEADLINE = [
    "interval_join", "asof_location", "asof_weather", "enriched_telemetry", "lap_leaderboard",
    "dashboard_laps", "tire_degradation", "v_min_points", "race_results", "season_races",
    "season_drivers", "season_winners", "fastest_lap_telemetry", "overview_metrics",
    "price_rank_by_status", "qualify_row_number", "dq_summary",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus * 2))
    spark = build_session(f"local[{cpus}]", app="trackline-bench", shuffle_partitions=partitions)
    checkpoint_root(spark, tempfile.mkdtemp(prefix="trackline-bench-"))
    # JVM / planner warm-up outside the timings
    spark.range(1000).selectExpr("sum(id)").collect()
    spark.read.parquet(f"{sf_dir}/region.parquet").collect()

    times: dict[str, float] = {}
    lh = lakehouse_for(spark, sf_dir)

    t = time.time()
    lh.build_bronze(threads=8)
    times["build_bronze"] = time.time() - t
    for name, attr in SILVER.items():
        t = time.time()
        getattr(lh.models, attr)
        times[f"build_{name}"] = time.time() - t
    for level in lh.GOLD_LEVELS:
        t = time.time()
        lh._parallel([lambda n=n: getattr(lh.models, GOLD[n]) for n in level], 2)
        times["build_" + "+".join(level)] = time.time() - t

    for name in HEADLINE:
        t = time.time()
        run(QUERIES[name](spark, sf_dir))
        times[name] = time.time() - t

    # parameterised dashboard calls (filters pushed into the gold / silver scans)
    m = lh.models
    first = m.dashboard_laps.orderBy("session_key", "driver_number", "lap_number").first()
    drivers = [r[0] for r in m.dim_drivers.where(f"session_key = {first['session_key']}")
               .select("driver_number").orderBy("driver_number").take(3)]
    calls = {
        "serve_laps_3_drivers": lambda: repository.laps(m, first["session_key"], drivers, ordered=True),
        "serve_tires_3_drivers": lambda: repository.tire_degradation(m, first["session_key"], drivers,
                                                                     ordered=True),
        "serve_lap_telemetry": lambda: repository.telemetry(m, first["session_key"], first["driver_number"],
                                                            first["lap_number"], ordered=True),
        "serve_fastest_lap_telemetry": lambda: repository.fastest_lap_telemetry(m, first["session_key"], drivers,
                                                                                ordered=True),
    }
    for name, call in calls.items():
        t = time.time()
        call().collect()
        times[name] = time.time() - t

    total = sum(times.values())
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_wall_clock", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()}, "sf": sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
