"""Print the final (adaptive) physical plan of registered queries, key operators only.

Usage: python scripts/show_plans.py [sf_dir] [name ...]
Runs each query once (collect) so AQE's final plan is shown, then prints the
lines naming scans (with pushed filters), exchanges, joins and aggregates.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ingestflow.plans.catalog import QUERIES  # noqa: E402
from ingestflow.session import local_session_for_tests  # noqa: E402

KEEP = re.compile(r"(Join|Exchange|Aggregate|Scan parquet|FileScan|Reused|Generate|Window|"
                  r"isFinalPlan|BroadcastQueryStage|ShuffleQueryStage|Union|Expand)")


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or ["await_routes", "load_history", "stage_plan", "submit_routes"]
    spark = local_session_for_tests(tempfile.mkdtemp(prefix="run-", dir="/tmp"), 8)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"### {name}")
        for line in plan.splitlines():
            if KEEP.search(line):
                line = re.sub(r"#\d+L?", "", line)
                line = re.sub(r"Location: [^,]+, ", "", line)
                print(line[:230])
        print()


if __name__ == "__main__":
    main(sys.argv)
