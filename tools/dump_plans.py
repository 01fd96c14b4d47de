"""Write the final adaptive plan (``explain("formatted")``) of headline queries.

    python tools/dump_plans.py [sf_dir] [out_dir] [query ...]

Each query runs once (``noop`` sink) so that the written plan is the final
adaptive plan, with the join strategies and reused exchanges AQE chose.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from holdcast.plans import catalog  # noqa: E402
from holdcast.session import local_session  # noqa: E402

HEADLINE = ["holding_report", "weekly_share", "latest_plan", "bias_28d", "wide_report_aligned"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "docs/plans"
    names = sys.argv[3:] or HEADLINE
    os.makedirs(out, exist_ok=True)
    spark = local_session(8, 16, app_name="holdcast-plans")
    for name in names:
        df = catalog.run(name, spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(f"# {name} at {sf_dir}: final adaptive plan (local[8], 16 shuffle partitions)\n\n")
            f.write(text)
        print(name, len(text))
    spark.stop()


if __name__ == "__main__":
    main()
