"""Per-ticker price and valuation statistics.

Inputs are two keyed tables, ``prices(ticker, close)`` and
``fundamentals(ticker, shares)``, as the CSV readers or the driver-table
adapters produce them. Both are aggregated *before* they are joined: each side
shuffles one partial-aggregate row per (task, ticker), and the join sees one
row per ticker per side. The aggregate outputs are already hash-partitioned
by ``ticker``, so the join, the anti joins and the coverage join reuse that
partitioning (or AQE broadcasts the smaller side when its measured size is
under the broadcast threshold).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keystat.functions.positive import (is_defined, positive_max, positive_mean,
                                        positive_min, positive_var_pop)

PRICE_STATS = ["p_mean", "p_min", "p_max", "p_var"]
VALUATION_STATS = ["v_mean", "v_min", "v_max", "v_var"]


# -- projections ------------------------------------------------------------

def price_pairs(prices: DataFrame) -> DataFrame:
    """(ticker, close) per price line."""
    return prices.select("ticker", F.col("close").cast("double").alias("close"))


def fundamental_pairs(fundamentals: DataFrame) -> DataFrame:
    """(ticker, shares) per fundamentals line; missing or nonpositive shares
    become 0.0 (NaN is kept: it is not ``<= 0``)."""
    s = F.col("shares").cast("double")
    return fundamentals.select("ticker", F.when(s > 0, s).otherwise(F.lit(0.0)).alias("shares"))


# -- aggregates -------------------------------------------------------------

def price_aggregate(prices: DataFrame) -> DataFrame:
    """One row per ticker: line count and the four price statistics."""
    close = F.col("close")
    return (price_pairs(prices).groupBy("ticker")
            .agg(F.count(F.lit(1)).alias("n_price_rows"),
                 positive_mean(close).alias("p_mean"),
                 positive_min(close).alias("p_min"),
                 positive_max(close).alias("p_max"),
                 positive_var_pop(close).alias("p_var")))


def price_stats(prices: DataFrame) -> DataFrame:
    """(ticker, p_mean, p_min, p_max, p_var); NULL where no close is positive."""
    return price_aggregate(prices).select("ticker", *PRICE_STATS)


def shares_aggregate(fundamentals: DataFrame) -> DataFrame:
    """One row per fundamentals ticker: line count and mean positive shares."""
    return (fundamental_pairs(fundamentals).groupBy("ticker")
            .agg(F.count(F.lit(1)).alias("n_fund_rows"),
                 positive_mean("shares").alias("shares_mean")))


def mean_shares(fundamentals: DataFrame) -> DataFrame:
    """(ticker, shares_mean) for tickers whose mean is defined."""
    return (shares_aggregate(fundamentals)
            .where(is_defined("shares_mean"))
            .select("ticker", "shares_mean"))


def invalid_fundamental_tickers(fundamentals: DataFrame) -> DataFrame:
    """Fundamentals tickers whose mean shares is undefined (no positive value, or NaN)."""
    return (shares_aggregate(fundamentals)
            .where(~is_defined("shares_mean"))
            .select("ticker"))


# -- valuation and the report ------------------------------------------------

def valuation_columns(k: Column | None = None):
    # A constant scale k per ticker: mean, min and max scale by k, the
    # population variance by k squared (var(kx) = k^2 var(x)); no second pass
    # over the price lines is needed.
    k = F.col("shares_mean") if k is None else k
    return [(F.col("p_mean") * k).alias("v_mean"),
            (F.col("p_min") * k).alias("v_min"),
            (F.col("p_max") * k).alias("v_max"),
            (F.col("p_var") * k * k).alias("v_var")]


def _joined(prices: DataFrame, fundamentals: DataFrame) -> DataFrame:
    return price_aggregate(prices).join(mean_shares(fundamentals), "ticker", "inner")


def valuation_stats(prices: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """(ticker, v_mean, v_min, v_max, v_var) for tickers in both inputs."""
    return _joined(prices, fundamentals).select("ticker", *valuation_columns())


def stock_report(prices: DataFrame, fundamentals: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Price and valuation statistics per ticker present in both inputs,
    sorted by ticker (string order)."""
    out = _joined(prices, fundamentals).select("ticker", *PRICE_STATS, *valuation_columns())
    return out.orderBy("ticker") if ordered else out


def scaled_stats(prices: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """Mean and population variance of ``close * k`` over positive closes,
    ``k`` being the ticker's mean shares (the scaled helpers of the original)."""
    k = F.col("shares_mean")
    return _joined(prices, fundamentals).select(
        "ticker", (F.col("p_mean") * k).alias("s_mean"), (F.col("p_var") * k * k).alias("s_var"))


def stat_union(prices: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """Long form: one row per (ticker, kind) with kind ``price`` or ``valuation``;
    the prices are read and aggregated once."""
    joined = price_aggregate(prices).join(mean_shares(fundamentals), "ticker", "left").select(
        "ticker", *PRICE_STATS, "shares_mean", *valuation_columns())

    def row(kind: str, names: list[str]) -> Column:
        return F.struct(F.lit(kind).alias("kind"),
                        *[F.col(n).alias(a) for n, a in zip(names, ("mean", "min", "max", "var"), strict=True)])

    both = F.array(row("price", PRICE_STATS), row("valuation", VALUATION_STATS))
    return joined.select("ticker", F.inline(F.when(F.col("shares_mean").isNotNull(), both)
                                            .otherwise(F.slice(both, 1, 1))))


def value_positions(prices: DataFrame, width: float = 1000.0) -> DataFrame:
    """(ticker, close, n, first_position): each distinct close of a ticker, how
    often it occurs, and the place (from 1) of its first occurrence in the ticker's ascending order.

    Equal closes are counted before anything else, and places are summed in two
    steps, within ranges of ``width`` and over a ticker's ranges, so that a ticker with a
    large share of all lines is not one task's."""
    counts = price_pairs(prices).groupBy("ticker", "close").agg(F.count("*").alias("n"))
    counts = counts.withColumn("_range", F.when(F.isnan("close"), F.lit(float("inf")))
                               .otherwise(F.floor(F.col("close") / width).cast("double")))
    ranges = counts.groupBy("ticker", "_range").agg(F.sum("n").alias("_n"))
    over = Window.partitionBy("ticker").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("ticker", "_range", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_before"))
    within = Window.partitionBy("ticker", "_range").orderBy("close").rowsBetween(Window.unboundedPreceding, -1)
    return counts.join(ranges, ["ticker", "_range"]).select(
        "ticker", "close", "n",
        (F.col("_before") + F.coalesce(F.sum("n").over(within), F.lit(0)) + 1).alias("first_position"))


def sorted_values(prices: DataFrame) -> DataFrame:
    """Every close of every ticker in ascending order, as rows.

    The values are not gathered into one list per ticker: a ticker can hold a
    large share of all lines. A global sort on ``(ticker, close)`` range-
    partitions on both columns, so one ticker's values spread over many tasks;
    the row's file position as a last sort key lets even a long run of equal
    ``(ticker, close)`` pairs be split between range partitions.
    """
    seq = F.monotonically_increasing_id().alias("_seq")
    return price_pairs(prices).select("ticker", "close", seq).orderBy("ticker", "close", "_seq") \
        .drop("_seq")
