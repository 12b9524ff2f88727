"""Which tickers are missing on either side, and the job's counters.

Counters are plain aggregates over DataFrames, not accumulators: an
accumulator inside a transformation counts again whenever a stage is re-run
(a lost executor, a range-sort sample), an aggregate cannot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from keystat.functions.positive import is_defined
from keystat.operators.stocks import (PRICE_STATS, VALUATION_STATS, mean_shares, price_aggregate, shares_aggregate,
                                      valuation_columns)
from keystat.sources.staged import staged


def price_tickers_without_fundamentals(prices: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """Tickers with prices but no valid fundamentals mean (anti join)."""
    return (price_aggregate(prices).select("ticker")
            .join(mean_shares(fundamentals).select("ticker"), "ticker", "left_anti"))


def fundamental_tickers_without_prices(prices: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """Tickers with a valid fundamentals mean but no price line (anti join)."""
    return (mean_shares(fundamentals).select("ticker")
            .join(price_aggregate(prices).select("ticker"), "ticker", "left_anti"))


def ticker_coverage(prices: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """One row per ticker of either input (full outer join of the two
    per-ticker aggregates) with presence flags, line counts and statistics.

    The report (both present, valid mean) and every counter derive from this
    one join; it is one row per ticker, small next to the inputs.
    """
    p = price_aggregate(prices).withColumn("_has_prices", F.lit(True))
    f = shares_aggregate(fundamentals).withColumn("_has_fund", F.lit(True))
    j = p.join(f, "ticker", "full_outer")
    return j.select(
        "ticker",
        F.coalesce("_has_prices", F.lit(False)).alias("has_prices"),
        F.coalesce("_has_fund", F.lit(False)).alias("has_fundamentals"),
        F.coalesce(is_defined("shares_mean"), F.lit(False)).alias("fundamentals_valid"),
        F.coalesce("n_price_rows", F.lit(0)).alias("n_price_rows"),
        F.coalesce("n_fund_rows", F.lit(0)).alias("n_fund_rows"),
        "p_mean", "p_min", "p_max", "p_var", "shares_mean")


def _counts() -> list[Column]:
    """Aggregates over the coverage table."""
    c = F.col
    return [
        F.sum("n_price_rows").cast("long").alias("price_records_read"),
        F.sum("n_fund_rows").cast("long").alias("fundamentals_records_read"),
        F.count(F.when(c("has_prices") & ~c("fundamentals_valid"), 1)).alias("price_tickers_without_fundamentals"),
        F.count(F.when(c("fundamentals_valid") & ~c("has_prices"), 1)).alias("fundamental_tickers_without_prices"),
        F.count(F.when(c("has_fundamentals") & ~c("fundamentals_valid"), 1)).alias("fundamental_tickers_invalid"),
    ]


def counters_from_coverage(coverage: DataFrame) -> DataFrame:
    """One row of counters. Accurate names first; the two ``legacy_*``
    columns reproduce the original printed lines, which mix categories:
    "missing price tickers" are price tickers without valid fundamentals (plus
    incomplete price vectors, which cannot occur: always 0), and "missing
    fundamentals tickers" are valid-fundamentals tickers without prices plus
    fundamentals tickers whose mean is undefined."""
    c = F.col
    agg = coverage.agg(*_counts())
    return agg.select(
        F.coalesce("price_records_read", F.lit(0).cast("long")).alias("price_records_read"),
        F.coalesce("fundamentals_records_read", F.lit(0).cast("long")).alias("fundamentals_records_read"),
        "price_tickers_without_fundamentals",
        "fundamental_tickers_without_prices",
        "fundamental_tickers_invalid",
        F.lit(0).cast("long").alias("incomplete_price_vectors"),
        (c("price_tickers_without_fundamentals") + F.lit(0)).alias("legacy_missing_price_tickers"),
        (c("fundamental_tickers_without_prices") + c("fundamental_tickers_invalid")).alias(
            "legacy_missing_fundamentals_tickers"),
    )


def stock_counters(prices: DataFrame, fundamentals: DataFrame) -> DataFrame:
    return counters_from_coverage(ticker_coverage(prices, fundamentals))


def stock_records_read(prices: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """Lines read from each input (one row): one pass over the union of both
    scans with a global count per side, no join."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    lines = (prices.select(one.alias("p"), zero.alias("f"))
             .unionByName(fundamentals.select(zero.alias("p"), one.alias("f"))))
    return lines.agg(F.coalesce(F.sum("p"), zero).alias("price_records_read"),
                     F.coalesce(F.sum("f"), zero).alias("fundamentals_records_read"))


def report_from_coverage(coverage: DataFrame) -> DataFrame:
    """The stock report out of the coverage table (same rows as
    :func:`keystat.operators.stocks.stock_report`)."""
    k = F.col("shares_mean")
    return (coverage.where(F.col("has_prices") & F.col("fundamentals_valid"))
            .select("ticker", "p_mean", "p_min", "p_max", "p_var",
                    (F.col("p_mean") * k).alias("v_mean"), (F.col("p_min") * k).alias("v_min"),
                    (F.col("p_max") * k).alias("v_max"), (F.col("p_var") * k * k).alias("v_var"))
            .orderBy("ticker"))


def stock_job(prices: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """The whole stock job in long form, each input scanned once by one job: (section, key, the eight
    statistics, n).

    Sections: ``report`` (tickers in both inputs, with statistics), ``price_without_fundamentals``,
    ``fundamental_without_prices`` and ``fundamental_invalid`` (tickers), and ``counter`` (name and ``n``).
    All come from one coverage table. Its rows are written once; the counters are
    observed on them as they pass, above the last shuffle: there a finished task counts once, also when a
    lost executor makes earlier stages run again."""
    seen = Observation("stock_job")
    coverage = ticker_coverage(prices, fundamentals).observe(seen, *_counts())
    stats = [*PRICE_STATS, *VALUATION_STATS]
    wide = coverage.select("*", *valuation_columns())
    has_prices, valid = F.col("has_prices"), F.col("fundamentals_valid")
    sections = [("report", has_prices & valid), ("price_without_fundamentals", has_prices & ~valid),
                ("fundamental_without_prices", valid & ~has_prices), ("fundamental_invalid", F.col("has_fundamentals") & ~valid)]
    names = F.filter(F.array(*[F.when(holds, F.lit(name)) for name, holds in sections]), lambda x: x.isNotNull())
    rows = wide.select(F.explode(names).alias("section"), F.col("ticker").alias("key"), *stats)
    rows = rows.select("section", "key", *[F.when(F.col("section") == "report", F.col(c)).alias(c) for c in stats],
                       F.lit(None).cast("long").alias("n"))
    rows = staged(rows, "stock-job")
    counted = [("counter", name, *[None] * len(stats), n or 0) for name, n in seen.get.items()]
    return rows.unionByName(prices.sparkSession.createDataFrame(counted, rows.schema))
