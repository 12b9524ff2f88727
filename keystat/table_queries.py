"""Registered queries over stored tables and over orders of rows.

Each writes its table under the shared folder and reads it back: bucketed upsert and family
scans, row numbers, range clustering, the wide view, binary cells, and the stock job in one pass.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from keystat.functions.binary_keys import key_texts, text_key
from keystat.operators import cells as C
from keystat.operators import coverage as cov
from keystat.operators import genres as G
from keystat.operators import stocks as S
from keystat.operators.positions import with_positions
from keystat.operators.wide import explode_wide, wide_view
from keystat.sources import driver_tables as T
from keystat.sources.cell_store import bucketed_cells, buckets_of, read_cells, write_cells
from keystat.sources.range_table import key_ranges, lookup, write_ranges
from keystat.sources.staged import staged, staging_path

RANGES = 16
CHUNK_ROWS = 10


def _inputs(spark, sf):
    return T.movies(spark, sf), T.tags(spark, sf), T.ratings(spark, sf)


def _stored(spark, movies, tags, ratings) -> tuple[str, int]:
    """(path, bucket count) of a bucketed table of the cells, the count by the bytes of their lines' cells."""
    path = staging_path(spark, "cells")
    n = buckets_of(C.raw_cells(movies, tags, ratings))
    write_cells(C.build_cells(movies, tags, ratings), path, buckets=n)
    return path, n


def stored_upsert(spark, sf):
    """(merged cells before they are written, bucket count): a stored base joined with a delta."""
    movies, tags, _ = _inputs(spark, sf)
    ratings = T.ratings(spark, sf, "l_discount")
    late = F.col("l_discount") >= 0.05
    base, n = _stored(spark, movies, tags, ratings.where(~late))
    delta = staged(C.build_cells(movies, None, ratings.where(late)), "delta")
    return C.merge_aligned(bucketed_cells(spark, base), delta, unique=True, buckets=n), n


def q_stored_upsert(spark, sf):
    """A base table is stored, a delta merged into its buckets in place, the result stored and scanned."""
    merged, n = stored_upsert(spark, sf)
    path = staging_path(spark, "upserted")
    write_cells(merged, path, buckets=n, aligned=True)
    return read_cells(spark, path)


def q_stored_rating_cells(spark, sf):
    """One family of a stored table, decoded."""
    path, _ = _stored(spark, *_inputs(spark, sf))
    return C.rating_cells(read_cells(spark, path, [C.RATING]))


def q_stock_report_positions(spark, sf):
    report = S.stock_report(T.prices(spark, sf), T.fundamentals(spark, sf), ordered=False)
    return with_positions(report, "ticker").select("position", "ticker", "p_min", "p_max")


def q_genre_report_positions(spark, sf):
    stats = G.stats_of_genres(G.explode_genres(G.movie_summary_of_inputs(*_inputs(spark, sf))), ordered=False)
    return with_positions(stats, "genre").select("position", "genre", "num_tags")


def _range_table(spark, sf) -> str:
    path = staging_path(spark, "ranges")
    write_ranges(C.build_cells(*_inputs(spark, sf)), path, C.CELL_KEY, ranges=RANGES)
    return path


def q_cell_key_ranges(spark, sf):
    """Each range's least and greatest key: disjoint and ascending."""
    text = lambda c: F.concat_ws("/", f"{c}.row_key", f"{c}.family", f"{c}.qualifier").alias(c)
    return key_ranges(spark, _range_table(spark, sf)).select("range", text("least"), text("greatest"), "rows")


def q_cells_of_movies(spark, sf):
    """All cells of four movies, looked up in a range-clustered table (one of them doesn't exist)."""
    return lookup(spark, _range_table(spark, sf), "row_key", ["1", "17", "s2", "none"]).select(*C.CELL_COLUMNS)


def q_movie_wide(spark, sf):
    """The wide view of the user cells, its maps opened again."""
    cells = C.build_cells(*_inputs(spark, sf)).where(F.col("family") != C.INFO)
    return explode_wide(wide_view(cells, chunk_rows=CHUNK_ROWS))


def q_binary_cells(spark, sf):
    """The cell table as (key bytes, version and value bytes), numbered in byte order and decoded."""
    cells = C.build_cells(*_inputs(spark, sf))
    stored = staged(cells.select(text_key(*[F.col(c) for c in C.CELL_KEY]).alias("key"),
                                 text_key(C.version_key(F.col("version")), F.col("version"), F.col("value")).alias("cell")),
                    "binary-cells")
    read = with_positions(stored, "key")
    row_key, family, qualifier = key_texts(F.col("key"), 3)
    _, version, value = key_texts(F.col("cell"), 3)
    return read.select("position", row_key.alias("row_key"), family.alias("family"), qualifier.alias("qualifier"),
                       value.alias("value"), version.alias("version"))


def q_stock_job(spark, sf):
    """Report, both anti joins, invalid tickers and counters out of one relation."""
    job = cov.stock_job(T.prices(spark, sf), T.fundamentals(spark, sf))
    return job.select("section", "key", F.round("p_mean", 6).alias("p_mean"), "p_min", "p_max",
                      F.round(F.col("v_mean") / 1e3, 1).alias("v_mean"), "n")


QUERIES = {
    "stored_upsert": q_stored_upsert,
    "stored_rating_cells": q_stored_rating_cells,
    "stock_report_positions": q_stock_report_positions,
    "genre_report_positions": q_genre_report_positions,
    "cell_key_ranges": q_cell_key_ranges,
    "cells_of_movies": q_cells_of_movies,
    "movie_wide": q_movie_wide,
    "binary_cells": q_binary_cells,
    "stock_job": q_stock_job,
}


def oracle(stock: str, cells: str, summary: str, upserted: str, rating_cells: str) -> dict[str, str]:
    """Statements of these queries; the first three arguments are WITH clauses that define the inputs."""
    key = "row_key, family, qualifier"
    return {
        "stored_upsert": upserted,
        "stored_rating_cells": rating_cells,
        "stock_report_positions": stock + """
SELECT row_number() OVER (ORDER BY p.ticker) AS position, p.ticker, p_min, p_max
FROM pstats p JOIN vstats v ON p.ticker = v.ticker""",
        "genre_report_positions": summary + """
SELECT row_number() OVER (ORDER BY genre) AS position, genre, CAST(sum(num_tags) AS BIGINT) AS num_tags
FROM exploded GROUP BY genre""",
        "cell_key_ranges": cells + f""", placed AS (
  SELECT {key}, CAST((row_number() OVER (ORDER BY {key}) - 1) * {RANGES} // count(*) OVER () AS INT) AS range FROM cells)
SELECT range, arg_min(row_key || '/' || family || '/' || qualifier, ({key})) AS least,
  arg_max(row_key || '/' || family || '/' || qualifier, ({key})) AS greatest, count(*) AS rows
FROM placed GROUP BY range""",
        "cells_of_movies": cells + "SELECT * FROM cells WHERE row_key IN ('1', '17', 's2', 'none')",
        "movie_wide": cells + f""", placed AS (
  SELECT row_key AS movie_id, family, qualifier AS user_id, value,
    (row_number() OVER (PARTITION BY row_key, family ORDER BY qualifier) - 1) // {CHUNK_ROWS} AS chunk
  FROM cells WHERE family <> 'info')
SELECT movie_id, family, chunk, count(*) OVER (PARTITION BY movie_id, family, chunk) AS n_users, user_id, value FROM placed""",
        "binary_cells": cells + f"SELECT row_number() OVER (ORDER BY {key}) AS position, {key}, value, version FROM cells",
        "stock_job": stock + """,
ptick AS (SELECT DISTINCT ticker FROM prices),
invalid AS (SELECT ticker FROM shares_agg WHERE shares_mean IS NULL OR isnan(shares_mean)),
alone AS (SELECT ticker FROM ptick WHERE ticker NOT IN (SELECT ticker FROM valid)),
unpriced AS (SELECT ticker FROM valid WHERE ticker NOT IN (SELECT ticker FROM ptick)),
counters AS (
  SELECT 'price_records_read' AS key, count(*) AS n FROM prices UNION ALL
  SELECT 'fundamentals_records_read', count(*) FROM fundamentals UNION ALL
  SELECT 'price_tickers_without_fundamentals', count(*) FROM alone UNION ALL
  SELECT 'fundamental_tickers_without_prices', count(*) FROM unpriced UNION ALL
  SELECT 'fundamental_tickers_invalid', count(*) FROM invalid)
SELECT 'report' AS section, p.ticker AS key, round(p_mean, 6) AS p_mean, p_min, p_max, round(v_mean / 1e3, 1) AS v_mean,
  CAST(NULL AS BIGINT) AS n FROM pstats p JOIN vstats v ON p.ticker = v.ticker
UNION ALL SELECT 'price_without_fundamentals', ticker, NULL, NULL, NULL, NULL, NULL FROM alone
UNION ALL SELECT 'fundamental_without_prices', ticker, NULL, NULL, NULL, NULL, NULL FROM unpriced
UNION ALL SELECT 'fundamental_invalid', ticker, NULL, NULL, NULL, NULL, NULL FROM invalid
UNION ALL SELECT 'counter', key, NULL, NULL, NULL, NULL, n FROM counters""",
    }
