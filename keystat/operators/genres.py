"""Per-genre statistics of the movie cell table.

Plan: each movie's cells fold into a summary row (genres, rating sum and
count, tag count; see :func:`keystat.operators.cells.movie_summary`); the
genres text is split and exploded; a grouped pass sums per genre. Every pass
combines map-side, so a genre holding most movies is just a partial sum per
task. No per-genre list of ratings is ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystat.functions.text import NO_GENRES, split_pipes
from keystat.operators.cells import latest_movies, movie_summary
from keystat.operators.movies import user_totals


def genre_list(genres_col: str = "genres"):
    """Genres of a movie: the genres text split on ``|`` with Java's rule,
    or ``[(no genres listed)]`` when the movie has no genres cell."""
    return split_pipes(F.coalesce(F.col(genres_col), F.lit(NO_GENRES)))


def movie_summary_of_inputs(movies: DataFrame, tags: DataFrame, ratings: DataFrame) -> DataFrame:
    """The summary of :func:`keystat.operators.cells.movie_summary` straight from
    the inputs: ratings and tags meet per movie and user, where the newest rating wins, are summed per movie,
    and only then meet the movies, one row each; events of unknown movies fall
    away there."""
    sums = user_totals(tags, ratings)
    return latest_movies(movies).join(sums, "movie_id", "left").select(
        "movie_id", "genres", F.coalesce("num_tags", F.lit(0).cast("long")).alias("num_tags"), "rating_sum",
        F.coalesce("rating_cnt", F.lit(0).cast("long")).alias("rating_cnt"))


def explode_genres(summary: DataFrame) -> DataFrame:
    """One row per (movie, genre occurrence) with the movie's rating sum,
    rating count and tag count. A genre repeated in one movie counts twice."""
    return summary.select("movie_id", F.explode(genre_list()).alias("genre"),
                          "rating_sum", "rating_cnt", "num_tags")


def genre_explode(cells: DataFrame) -> DataFrame:
    """:func:`explode_genres` of a cell table's movies."""
    return explode_genres(movie_summary(cells))


def genre_stats(cells: DataFrame, *, ordered: bool = True) -> DataFrame:
    """:func:`stats_of_genres` of a cell table."""
    return stats_of_genres(genre_explode(cells), ordered=ordered)


def stats_of_genres(exploded: DataFrame, *, ordered: bool = True) -> DataFrame:
    """``(genre, avg_rating, num_tags)``: the average over all ratings of the
    genre's movies (NULL if it has none) and the total of their tag counts."""
    g = (exploded.groupBy("genre")
         .agg(F.sum("rating_sum").alias("_sum"), F.sum("rating_cnt").alias("_cnt"),
              F.sum("num_tags").alias("num_tags")))
    out = g.select("genre", F.try_divide(F.col("_sum"), F.col("_cnt")).alias("avg_rating"),
                   F.col("num_tags").cast("long").alias("num_tags"))
    return out.orderBy("genre") if ordered else out
