"""Print the executed (final AQE) plan of registered queries as an operator
tree: joins and their strategy, exchanges, aggregates, windows, scans with
pushed filters and read schemas.

    python tools/explain_plans.py [--sf-dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lucrum.config import build_session  # noqa: E402
from lucrum.queries import REGISTRY  # noqa: E402

KEEP = ("Join", "Exchange", "Aggregate", "Window", "Union", "Scan", "Generate", "Subquery",
        "TakeOrdered", "Limit", "Expand", "Reused")
HEADLINE = ["gold_net_margin", "latest_order_item", "freight_allocation", "flatten_order_items",
            "backfill_counts", "page_of_orders"]


def tree(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        body = re.sub(r"^\*\(\d+\) ", "", line.lstrip(" :+-"))
        op = body.split(" ", 1)[0]
        if not any(k in op for k in KEEP) and "Scan " not in body[:40]:
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: [^,]+, ", "", line)
        out.append(line[:200].rstrip())
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = build_session()
    for name in a.names or HEADLINE:
        df = REGISTRY[name](spark, a.sf_dir)
        df.write.format("noop").mode("overwrite").save()
        print(f"\n### {name}\n```")
        print("\n".join(tree(df._jdf.queryExecution().executedPlan().toString())))
        print("```")
    spark.stop()


if __name__ == "__main__":
    main()
