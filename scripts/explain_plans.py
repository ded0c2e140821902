"""Write the physical operator trees of the headline queries to docs/PLANS.md.

Usage: python scripts/explain_plans.py [sf_dir]

Only the tree part of ``explain("formatted")`` is kept (the per-node details
follow it in Spark's output); plans are taken before execution, so AQE's
runtime choices (e.g. a sort-merge join turned into a broadcast) show as the
initial plan.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tremor.plans import queries as Q  # noqa: E402
from tremor.session import build_session  # noqa: E402

HEADLINE = ["source_filter", "staging_events", "county_join", "load_fact", "olap_top_states",
            "olap_regions", "rollup_geo", "profile", "category_counts", "monthly_change"]


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n(1)")[0].strip()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `scripts/explain_plans.py` on `{os.path.basename(sf)}`. "
           "Warehouse queries read the published tables (the loads ran first).", ""]
    for name in HEADLINE:
        df = Q.QUERIES[name](spark, sf)
        out += [f"## {name}", "", "```", tree(df), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
