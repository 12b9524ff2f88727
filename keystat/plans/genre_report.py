"""Genre report: cell table -> ``(genre,avgRating numTags)`` text lines, sorted.

    python -m keystat.plans.genre_report TABLE OUTPUT_DIR [--updates DIR]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from keystat.operators.genres import genre_stats
from keystat.operators.report import genre_report_lines
from keystat.sources.cell_store import read_cells_with_updates


def run(spark: SparkSession, table: str, output_dir: str, *, updates: str | None = None) -> None:
    cells = read_cells_with_updates(spark, table, updates)
    genre_report_lines(genre_stats(cells, ordered=False)).write.text(output_dir)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("table")
    ap.add_argument("output")
    ap.add_argument("--updates")
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    from keystat.session import get_session
    spark = get_session(args.master, "keystat-genre-report")
    run(spark, args.table, args.output, updates=args.updates)
    return 0


if __name__ == "__main__":
    sys.exit(main())
