"""Print the physical plans of registered queries (``DataFrame.explain``).

    python tools/show_plans.py [--sf DIR] [--mode simple|formatted] [query ...]

With ``--markdown`` the output is a Markdown document (used for PLANS.md).
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

HEADLINE = ["stock_report", "stock_counters", "movie_cells", "upsert_cells", "genre_stats",
            "movie_left_join", "latest_rating_per_user", "mean_turnaround"]


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("queries", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--mode", default="simple", choices=["simple", "formatted", "extended", "cost"])
    ap.add_argument("--markdown", action="store_true")
    args = ap.parse_args()
    from keystat.queries import QUERIES
    from keystat.session import get_session
    spark = get_session("local[8]", "keystat-plans", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    for name in args.queries or HEADLINE:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, args.sf).explain(mode=args.mode)
        text = buf.getvalue().rstrip()
        if args.markdown:
            print(f"## `{name}`\n\n```\n{text}\n```\n")
        else:
            print(f"===== {name}\n{text}\n")
    spark.stop()


if __name__ == "__main__":
    main()
