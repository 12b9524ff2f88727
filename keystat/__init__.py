"""keystat: keyed statistics, a newest-wins cell table and genre reports on Spark.

The public functions take and return DataFrames; see README.md for the jobs.
"""

from keystat.functions.positive import (positive_max, positive_mean, positive_min,
                                        positive_var_pop)
from keystat.operators.cells import build_cells, merge_aligned, newest_cells, upsert_cells
from keystat.operators.coverage import (fundamental_tickers_without_prices,
                                        price_tickers_without_fundamentals, stock_counters,
                                        ticker_coverage)
from keystat.operators.genres import genre_explode, genre_stats
from keystat.operators.movies import (latest_rating_per_user, movie_left_join,
                                      rating_totals_per_movie, tags_per_movie)
from keystat.operators.stocks import (mean_shares, price_stats, scaled_stats, stat_union,
                                      stock_report, valuation_stats)
from keystat.operators.turnaround import mean_turnaround

__version__ = "0.1.0"

__all__ = [
    "build_cells", "fundamental_tickers_without_prices", "genre_explode", "genre_stats",
    "latest_rating_per_user", "mean_shares", "mean_turnaround", "merge_aligned",
    "movie_left_join", "newest_cells", "positive_max", "positive_mean", "positive_min",
    "positive_var_pop", "price_stats", "price_tickers_without_fundamentals",
    "rating_totals_per_movie", "scaled_stats", "stat_union", "stock_counters", "stock_report",
    "tags_per_movie", "ticker_coverage", "upsert_cells", "valuation_stats",
]
