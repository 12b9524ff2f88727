"""Legacy text renderings of the two reports.

Typed outputs keep NULL for an undefined statistic. Only these text lines
reproduce the original's rendering of degenerate values: a statistic over no
positive value prints as ``NaN`` (mean, variance), ``Infinity`` (min, started
at Double.MAX_VALUE) or ``0.0`` (max, started at Double.MIN_VALUE), and each
number is narrowed to a 32-bit float before printing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystat.functions.text import (DOUBLE_MAX_VALUE, DOUBLE_MIN_VALUE, decimal_text,
                                    float_text, pair_line)

def stock_report_lines(report: DataFrame) -> DataFrame:
    """``(ticker,pMean pMin pMax pVar vMean vMin vMax vVar)`` per row of a
    stock report (as :func:`keystat.operators.stocks.stock_report` returns),
    sorted by ticker; a single ``value`` column, ready for ``write.text``."""
    c = F.col
    nan = F.lit(float("nan"))
    k = F.when(c("p_mean").isNull() | F.isnan(c("p_mean")), F.lit(None)).otherwise(
        c("v_mean") / c("p_mean"))
    # Reconstruct the legacy valuation of an empty price list: the start
    # values of the min/max loops times the mean shares.
    p_min = F.coalesce(c("p_min"), F.lit(DOUBLE_MAX_VALUE))
    p_max = F.coalesce(c("p_max"), F.lit(DOUBLE_MIN_VALUE))
    shares = F.coalesce(c("shares_mean"), k) if "shares_mean" in report.columns else k
    v_min = F.when(c("p_min").isNull(), p_min * shares).otherwise(c("v_min"))
    v_max = F.when(c("p_max").isNull(), p_max * shares).otherwise(c("v_max"))
    fields = [
        F.coalesce(c("p_mean"), nan), p_min, p_max, F.coalesce(c("p_var"), nan),
        F.coalesce(c("v_mean"), nan), F.coalesce(v_min, F.lit(float("inf"))),
        F.coalesce(v_max, F.lit(0.0)), F.coalesce(c("v_var"), nan),
    ]
    text = F.concat_ws(" ", *[float_text(x) for x in fields])
    return report.select(c("ticker"), pair_line("ticker", text).alias("value")) \
        .orderBy("ticker").select("value")


def genre_report_lines(stats: DataFrame) -> DataFrame:
    """``(genre,avg numTags)`` per genre, sorted; the average is narrowed to
    float and printed with ``#.################``, an undefined one as NaN."""
    avg_text = decimal_text(F.col("avg_rating").cast("float"))
    text = F.concat(avg_text, F.lit(" "), decimal_text(F.col("num_tags")))
    return stats.select("genre", pair_line("genre", text).alias("value")) \
        .orderBy("genre").select("value")
