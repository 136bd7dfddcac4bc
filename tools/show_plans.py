"""Print physical plans of headline queries as a large cluster would plan them.

Usage: python tools/show_plans.py [sf_dir] [query ...]

Auto-broadcast is disabled (at 100 TB no fact or header table fits), so joins
show their large-scale strategy; the product dimension is broadcast only when
the registry proves a row bound.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.registry import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = ("publish_orders", "top_color_by_year", "avg_lead_by_category", "dedupe_keep_populated", "dq_checks")


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(HEADLINE)
    spark = local_session("show-plans")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in names:
        print(f"==================== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
