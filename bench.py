"""Time the headline metrics at one scale factor; print one JSON line.

Each query is run to completion with the ``noop`` sink (every row is computed,
nothing is collected to the driver). The first query also pays for JVM
warm-up, so every query runs once untimed first; the timed number is the best
of ``BENCH_REPEAT`` runs.

The five input tables are first written once, untimed, as the lake holds them: parquet
folders of several files, which a scan can share among its tasks. ``value`` and ``queries`` time
the metrics over those files. ``value_one_file`` and ``queries_one_file`` time them
over the driver's ``lineitem.parquet`` directly, as earlier rounds did: that is one row group, so
each scan and the derivation of the tables run in one task.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 2), BENCH_QUERIES (comma list, default the headline set),
BENCH_SHUFFLE_PARTITIONS (default 2 x cpus), BENCH_ONE_FILE (default 1; 0 leaves the second set out).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from dataclasses import fields

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from holdcast.plans import catalog  # noqa: E402
from holdcast.schemas import Tables  # noqa: E402
from holdcast.session import local_session  # noqa: E402

HEADLINE = [
    "holding_report", "daily_holding", "dedup_daily", "weekly_share", "daily_share",
    "weekly_inventory_iso", "latest_plan", "bias_28d", "bias_28d_aligned", "bias_90d",
    "bias_90d_aligned", "lag_previous_day", "on_hand_metrics", "doh_ratio", "wide_report_aligned",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus * 2)))
    root = tempfile.mkdtemp(prefix="holdcast-bench-")       # one machine: local[n]
    spark = local_session(cpus, shuffle_partitions=parts, app_name="holdcast-bench", checkpoint_root=root)
    derived = catalog.tables_for(spark, sf_dir)

    def written(name: str):
        path = f"{root}/lake/{name}"
        getattr(derived, name).repartition(cpus).write.parquet(path)
        return spark.read.parquet(path)

    lake = Tables(**{f.name: written(f.name) for f in fields(Tables)})

    def run_once(name: str, tables: Tables) -> float:
        t = time.perf_counter()
        catalog.run_on(name, tables).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    times = {}
    for name in names:
        run_once(name, lake)
        times[name] = round(min(run_once(name, lake) for _ in range(repeat)), 3)
    again = os.environ.get("BENCH_ONE_FILE", "1") != "0"      # once each: the JVM is warm by now
    one_file = {name: round(run_once(name, derived), 3) for name in names} if again else {}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum of best-of-n seconds over headline metrics",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "value_one_file": round(sum(one_file.values()), 3) if one_file else None,
        "queries_one_file": one_file,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
