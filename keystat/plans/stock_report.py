"""Stock job: prices + fundamentals CSV -> sorted text report + counters.

    python -m keystat.plans.stock_report PRICES FUNDAMENTALS OUTPUT_DIR [--counters PATH]

The two per-ticker aggregates and their full outer join are computed once
and kept (memory, spilling to disk; lost blocks are recomputed from the
scans); the report and all counters are read off that one small table, so
each input is scanned once.
"""

from __future__ import annotations

import argparse
import sys

from pyspark import StorageLevel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from keystat.operators import coverage as cov
from keystat.operators import report as rep
from keystat.operators.stocks import valuation_columns
from keystat.sources.csv_inputs import read_fundamentals, read_prices


def run(spark: SparkSession, prices_path: str, fundamentals_path: str, output_dir: str,
        *, counters_path: str | None = None, header: bool = False,
        on_bad: str = "fail") -> dict[str, int]:
    prices = read_prices(spark, prices_path, header=header, on_bad=on_bad)
    fundamentals = read_fundamentals(spark, fundamentals_path, header=header, on_bad=on_bad)
    coverage = cov.ticker_coverage(prices, fundamentals).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        report = (coverage.where(F.col("has_prices") & F.col("fundamentals_valid"))
                  .select("ticker", "p_mean", "p_min", "p_max", "p_var", "shares_mean",
                          *valuation_columns()))
        rep.stock_report_lines(report).write.text(output_dir)
        counters_df = cov.counters_from_coverage(coverage)
        if counters_path:
            counters_df.coalesce(1).write.json(counters_path)
        counters = counters_df.first().asDict()
    finally:
        coverage.unpersist()
    return counters


def legacy_lines(c: dict[str, int]) -> list[str]:
    """The four printed lines of the original job (legacy labels)."""
    return [
        f">> Missing price tickers: {c['legacy_missing_price_tickers']}",
        f">> Missing fundamentals tickers: {c['legacy_missing_fundamentals_tickers']}",
        f">> Stock price records read: {c['price_records_read']}",
        f">> Fundamentals records read: {c['fundamentals_records_read']}",
    ]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("prices")
    ap.add_argument("fundamentals")
    ap.add_argument("output")
    ap.add_argument("--counters", help="also write the counters as JSON here")
    ap.add_argument("--header", action="store_true", help="inputs start with a header line")
    ap.add_argument("--on-bad", choices=["fail", "null"], default="fail")
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    from keystat.session import get_session
    spark = get_session(args.master, "keystat-stock-report")
    counters = run(spark, args.prices, args.fundamentals, args.output,
                   counters_path=args.counters, header=args.header, on_bad=args.on_bad)
    print("\n".join(legacy_lines(counters)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
