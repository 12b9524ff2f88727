"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
computed over the whole driver tables (through :mod:`keystat.sources.driver_tables`).

Statistics are rounded only here, for the cross-engine check (summation order
differs between engines): price mean to 6 places, price variance to 6 places
of 1e9 units, mean shares to 3 places, valuation mean/min/max to 1 place of
thousands (a 32-bit float's digits), valuation variance to 2 places of 1e9 units and
turnaround to 3 places. The library functions
themselves return unrounded doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystat.operators import cells as C
from keystat.operators import coverage as cov
from keystat.operators import genres as G
from keystat.operators import movies as M
from keystat.operators import report as R
from keystat.operators import stocks as S
from keystat.operators.turnaround import mean_turnaround
from keystat.sources import driver_tables as T
from keystat.table_queries import QUERIES as TABLE_QUERIES
from keystat.text_queries import QUERIES as TEXT_QUERIES

Query = Callable[[SparkSession, str], DataFrame]


def _r(c: str, places: int, scale: float | None = None):
    x = F.col(c) if scale is None else F.col(c) / F.lit(scale)
    return F.round(x, places).alias(c)


def _price_rounded(df: DataFrame) -> DataFrame:
    return df.select("ticker", _r("p_mean", 6), "p_min", "p_max", _r("p_var", 6, 1e9))


def _valuation_rounded(df: DataFrame, names=("v_mean", "v_min", "v_max", "v_var")) -> DataFrame:
    m, lo, hi, v = names
    return df.select("ticker", _r(m, 1, 1e3), _r(lo, 1, 1e3), _r(hi, 1, 1e3), _r(v, 2, 1e9))


def _stock_inputs(spark, sf):
    return T.prices(spark, sf), T.fundamentals(spark, sf)


def _cells(spark, sf):
    return C.build_cells(T.movies(spark, sf), T.tags(spark, sf), T.ratings(spark, sf))


# -- stock queries -------------------------------------------------------------

def q_price_pairs(spark, sf):
    return S.price_pairs(T.prices(spark, sf))


def q_fundamental_pairs(spark, sf):
    return S.fundamental_pairs(T.fundamentals(spark, sf))


def q_price_stats(spark, sf):
    return _price_rounded(S.price_stats(T.prices(spark, sf)))


def q_mean_shares(spark, sf):
    return S.mean_shares(T.fundamentals(spark, sf)).select("ticker", _r("shares_mean", 3))


def q_scaled_stats(spark, sf):
    df = S.scaled_stats(*_stock_inputs(spark, sf))
    return df.select("ticker", _r("s_mean", 1, 1e3), _r("s_var", 2, 1e9))


def q_valuation_stats(spark, sf):
    return _valuation_rounded(S.valuation_stats(*_stock_inputs(spark, sf)))


def q_stock_report(spark, sf):
    rep = S.stock_report(*_stock_inputs(spark, sf))
    return rep.select("ticker", _r("p_mean", 6), "p_min", "p_max", _r("p_var", 6, 1e9),
                      _r("v_mean", 1, 1e3), _r("v_min", 1, 1e3), _r("v_max", 1, 1e3), _r("v_var", 2, 1e9))


def q_stat_union(spark, sf):
    df = S.stat_union(*_stock_inputs(spark, sf))
    valuation = F.col("kind") == "valuation"
    rounded = [F.when(valuation, F.round(F.col(c) / 1e3, 1)).otherwise(F.round(c, 6)).alias(c) for c in ("mean", "min", "max")]
    return df.select("ticker", "kind", *rounded, _r("var", 2, 1e9))


def q_sorted_values(spark, sf):
    return S.value_positions(T.prices(spark, sf))


def q_price_tickers_without_fundamentals(spark, sf):
    return cov.price_tickers_without_fundamentals(*_stock_inputs(spark, sf))


def q_fundamental_tickers_without_prices(spark, sf):
    return cov.fundamental_tickers_without_prices(*_stock_inputs(spark, sf))


def q_fundamental_tickers_invalid(spark, sf):
    return S.invalid_fundamental_tickers(T.fundamentals(spark, sf))


def q_stock_records_read(spark, sf):
    return cov.stock_records_read(*_stock_inputs(spark, sf))


def q_stock_counters(spark, sf):
    return cov.stock_counters(*_stock_inputs(spark, sf))


def q_stock_report_lines(spark, sf):
    coverage = cov.ticker_coverage(*_stock_inputs(spark, sf))
    report = coverage.where(F.col("has_prices") & F.col("fundamentals_valid")).select(
        "ticker", "p_mean", "p_min", "p_max", "p_var", "shares_mean",
        *S.valuation_columns())
    # the lines read back: a text of 32-bit floats as Java prints it is compared
    # by its values (the exact text is held by the golden tests)
    ticker, fields = F.split_part("value", F.lit(","), F.lit(1)), F.split_part("value", F.lit(","), F.lit(2))
    parts = F.split(F.rtrim(F.translate(fields, ")", "")), " ")
    names = [*S.PRICE_STATS, *S.VALUATION_STATS]
    numbers = [F.nanvl(parts[i].cast("float"), F.lit(None).cast("float")).alias(n) for i, n in enumerate(names)]
    return R.stock_report_lines(report).select(F.substring(ticker, 2, 1 << 30).alias("ticker"), *numbers)


# -- movie queries ---------------------------------------------------------------

def q_movie_cells(spark, sf):
    return _cells(spark, sf)


def q_movie_cells_salted(spark, sf):
    return C.build_cells(T.movies(spark, sf), T.tags(spark, sf), T.ratings(spark, sf), strategy="shuffle")


def _upsert_inputs(spark, sf):
    # the batches differ by discount, which has nothing to do with the versions
    r = T.ratings(spark, sf, "l_discount")
    m, t = T.movies(spark, sf), T.tags(spark, sf)
    late = F.col("l_discount") >= 0.05
    return C.build_cells(m, t, r.where(~late)), C.build_cells(m, None, r.where(late))


def q_upsert_cells(spark, sf):
    """Two batches of ratings resolved in one pass, as if the later had been upserted."""
    r = T.ratings(spark, sf, "l_discount")
    return C.build_cells(T.movies(spark, sf), T.tags(spark, sf),
                         r.withColumn("late", (F.col("l_discount") >= 0.05).cast("long")), batch="late")


def q_upsert_cells_measured(spark, sf):
    """The same out of two cell tables."""
    return C.upsert_cells(*_upsert_inputs(spark, sf), strategy="auto")


def q_latest_rating_per_user(spark, sf):
    return M.latest_rating_per_user(T.ratings(spark, sf))


def q_movie_left_join(spark, sf):
    return M.movie_left_join(T.movies(spark, sf), T.tags(spark, sf), T.ratings(spark, sf))


def q_tags_per_movie(spark, sf):
    return M.tags_per_movie(T.tags(spark, sf))


def q_rating_totals_per_movie(spark, sf):
    return M.rating_totals_per_movie(T.ratings(spark, sf))


def q_rating_cells(spark, sf):
    return C.rating_cells(_cells(spark, sf))


def _movie_summary(spark, sf):
    return G.movie_summary_of_inputs(T.movies(spark, sf), T.tags(spark, sf), T.ratings(spark, sf))


def q_genre_explode(spark, sf):
    return G.explode_genres(_movie_summary(spark, sf))


def q_genre_stats(spark, sf):
    return G.stats_of_genres(q_genre_explode(spark, sf)).select("genre", _r("avg_rating", 6), "num_tags")


def q_genre_stats_of_cells(spark, sf):
    return G.genre_stats(_cells(spark, sf)).select("genre", _r("avg_rating", 6), "num_tags")


def q_genre_report_lines(spark, sf):
    return R.genre_report_lines(G.stats_of_genres(q_genre_explode(spark, sf), ordered=False))


def q_mean_turnaround(spark, sf):
    return mean_turnaround(T.jobs(spark, sf)).select("n_jobs", _r("mean_turnaround_seconds", 3))


QUERIES: dict[str, Query] = {
    "price_pairs": q_price_pairs,
    "fundamental_pairs": q_fundamental_pairs,
    "price_stats": q_price_stats,
    "mean_shares": q_mean_shares,
    "scaled_stats": q_scaled_stats,
    "valuation_stats": q_valuation_stats,
    "stock_report": q_stock_report,
    "stat_union": q_stat_union,
    "sorted_values": q_sorted_values,
    "price_tickers_without_fundamentals": q_price_tickers_without_fundamentals,
    "fundamental_tickers_without_prices": q_fundamental_tickers_without_prices,
    "fundamental_tickers_invalid": q_fundamental_tickers_invalid,
    "stock_records_read": q_stock_records_read,
    "stock_counters": q_stock_counters,
    "stock_report_lines": q_stock_report_lines,
    "movie_cells": q_movie_cells,
    "movie_cells_salted": q_movie_cells_salted,
    "upsert_cells": q_upsert_cells,
    "upsert_cells_measured": q_upsert_cells_measured,
    "latest_rating_per_user": q_latest_rating_per_user,
    "movie_left_join": q_movie_left_join,
    "tags_per_movie": q_tags_per_movie,
    "rating_totals_per_movie": q_rating_totals_per_movie,
    "rating_cells": q_rating_cells,
    "genre_explode": q_genre_explode,
    "genre_stats": q_genre_stats,
    "genre_stats_of_cells": q_genre_stats_of_cells,
    "genre_report_lines": q_genre_report_lines,
    "mean_turnaround": q_mean_turnaround,
    **TEXT_QUERIES,
    **TABLE_QUERIES,
}
