"""Write the physical plan of every registered query to PLANS.md.

    python tools/dump_plans.py [sf_dir]

Plans are taken after one execution, so they are AQE's final plans
(shuffle reads coalesced, joins possibly turned into broadcasts). Each
operator line is cut to 150 characters; ``*(n)`` marks whole-stage
code generation.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from punctuality.plans.catalog import QUERIES  # noqa: E402
from punctuality.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", app_name="punctuality-plans", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    out = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `tools/dump_plans.py` on `{sf_dir}` (`local[8]`, AQE on). "
        "Final adaptive plans after one run; `FileScan` lines show the columns read "
        "(`ReadSchema`) and pushed filters.",
        "",
    ]
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        df.collect()  # runs this DataFrame's own query execution, so its plan is final
        plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
        lines = [line[:150] for line in plan.splitlines()]
        scans = plan.count("FileScan")
        exchanges = sum("Exchange" in line and "BroadcastExchange" not in line for line in lines)
        out += [f"## {name}", "", f"scans: {scans}, shuffles: {exchanges}", "", "```", *lines, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
