"""The wide view of the cell table: one movie's cells as maps of bounded size.

A map of all raters of a popular movie would be one record of unbounded size; here a movie's
family is cut into chunks of at most ``chunk_rows`` users in the order of the user id, each a map.
Users are numbered within their movie and family by
:func:`keystat.operators.positions.group_position_parts`, so a hot movie's chunks
are made by many tasks, and every list gathered has a known bound; the cells of other movies, dealt by
movie and family for the numbering, are gathered where they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystat.operators.positions import group_position_parts

CHUNK_ROWS = 1000


def wide_view(cells: DataFrame, *, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(movie_id, family, chunk, n_users, users) out of cells (one row each cell): ``chunk`` counts from 0 within
    (movie, family), ``users`` maps qualifier to value."""
    parts = group_position_parts(cells.select("row_key", "family", "qualifier", "value"),
                                 ["row_key", "family"], ["qualifier"])
    chunk = F.expr(f"(position - 1) div {int(chunk_rows)}")
    wide = [placed.groupBy("row_key", "family", chunk.alias("chunk"))
            .agg(F.count("*").alias("n_users"),
                 F.sort_array(F.collect_list(F.struct("qualifier", "value"))).alias("entries"))  # at most chunk_rows
            .select(F.col("row_key").alias("movie_id"), "family", "chunk", "n_users",
                    F.map_from_entries("entries").alias("users")) for placed in parts]
    return reduce(DataFrame.unionByName, wide)


def explode_wide(wide: DataFrame) -> DataFrame:
    """The cells (movie_id, family, chunk, n_users, user_id, value) of a wide view."""
    return wide.select("movie_id", "family", "chunk", "n_users", F.explode("users").alias("user_id", "value"))
