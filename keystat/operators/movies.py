"""Per-movie rollups of the raw movie inputs.

Counting distinct users per movie is done in two grouped steps, first by
``(movie, user)`` then by ``movie``: the first shuffle spreads a popular
movie's lines over tasks by user, the second sees one row per pair and
combines map-side. A single ``count(distinct)`` would shuffle all pairs of a
movie into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystat.operators.cells import RATING, latest_movies, newest_cells, user_cells, version_key


def latest_rating_per_user(ratings: DataFrame) -> DataFrame:
    """One rating per (movie, user): newest ts, ties to the greater rating text.
    Output ``(movie_id, user_id, rating, ts)``, all text as in the input."""
    cells = newest_cells(user_cells(ratings, RATING, "rating"))
    return cells.select(
        F.col("row_key").alias("movie_id"), F.col("qualifier").alias("user_id"),
        F.split_part("value", F.lit("|"), F.lit(1)).alias("rating"),
        F.col("version").alias("ts"))


def tags_per_movie(tags: DataFrame) -> DataFrame:
    """``(movie_id, num_tag_users)``: distinct users who tagged the movie."""
    pairs = tags.groupBy("movie_id", "user_id").agg(F.count(F.lit(1)).alias("_n"))
    return pairs.groupBy("movie_id").agg(F.count(F.lit(1)).alias("num_tag_users"))


def rating_totals_per_movie(ratings: DataFrame) -> DataFrame:
    """``(movie_id, rating_sum, rating_cnt)`` over the newest rating per user."""
    latest = latest_rating_per_user(ratings)
    r = F.col("rating").cast("float").cast("double")
    return latest.groupBy("movie_id").agg(F.sum(r).alias("rating_sum"),
                                          F.count(r).alias("rating_cnt"))


def user_totals(tags: DataFrame, ratings: DataFrame) -> DataFrame:
    """(movie_id, num_tags, rating_sum, rating_cnt): ratings and tags meet per movie and user,
    where the newest rating wins, and are summed per movie."""
    cells = user_cells(ratings, RATING, "rating")
    newest = F.struct(version_key(F.col("version")).alias("r"), F.col("version").alias("v"), F.col("value").alias("value"))
    events = (cells.select(F.col("row_key").alias("movie_id"), F.col("qualifier").alias("user_id"),
                           newest.alias("rated"), F.lit(None).cast("boolean").alias("tagged"))
              .unionByName(tags.select("movie_id", "user_id", F.lit(True).alias("tagged")), allowMissingColumns=True))
    users = events.groupBy("movie_id", "user_id").agg(F.max("rated").alias("rated"), F.max("tagged").alias("tagged"))
    rating = F.split_part(F.col("rated.value"), F.lit("|"), F.lit(1)).cast("float").cast("double")
    return users.groupBy("movie_id").agg(F.count("tagged").alias("num_tags"), F.sum(rating).alias("rating_sum"),
                                         F.count(rating).alias("rating_cnt"))


def movie_left_join(movies: DataFrame, tags: DataFrame, ratings: DataFrame) -> DataFrame:
    """Every movie with its tag and rating rollups (a left outer join from
    movies; tags and ratings of unknown movies drop out). The right side is
    one row per movie, so the join carries no hot key."""
    j = latest_movies(movies).join(user_totals(tags, ratings), "movie_id", "left")
    zero = F.lit(0).cast("long")
    return j.select("movie_id", "title", "genres", F.coalesce("num_tags", zero).alias("num_tag_users"),
                    F.coalesce("rating_cnt", zero).alias("num_ratings"),
                    F.coalesce("rating_sum", F.lit(0.0)).alias("rating_sum"))
