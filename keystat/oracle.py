"""DuckDB statements equal to the registered queries (the correctness oracle).

Written independently of the Spark code, straight from the semantics: plain
SQL over the driver tables with the same input views, newest-wins by
``row_number()`` instead of an aggregate, genre splitting with string
functions. Column names equal the Spark queries'.
"""

from __future__ import annotations

from keystat import table_queries, text_queries

_PRICES = """prices AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN '' WHEN o_orderstatus = 'P' THEN 's' ELSE 'n' END
             || CAST(o_custkey AS VARCHAR) AS ticker,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 0.0::DOUBLE ELSE o_totalprice END AS close
  FROM orders)"""

_FUND = """fundamentals AS (
  SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_acctbal AS shares FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_acctbal + 100 AS shares FROM customer
  WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT 's' || CAST(s_suppkey AS VARCHAR), s_acctbal FROM supplier)"""

_FPAIRS = """fpairs AS (
  SELECT ticker, CASE WHEN shares > 0 THEN shares ELSE 0.0::DOUBLE END AS shares
  FROM fundamentals)"""

_PSTATS = """pstats AS (
  SELECT ticker,
         avg(close) FILTER (WHERE close > 0) AS p_mean,
         min(close) FILTER (WHERE close > 0 AND NOT isnan(close)) AS p_min,
         max(close) FILTER (WHERE close > 0 AND NOT isnan(close)) AS p_max,
         var_pop(close) FILTER (WHERE close > 0) AS p_var
  FROM prices GROUP BY ticker)"""

_SHARES = """shares_agg AS (
  SELECT ticker, avg(shares) FILTER (WHERE shares > 0) AS shares_mean
  FROM fpairs GROUP BY ticker),
valid AS (
  SELECT ticker, shares_mean FROM shares_agg
  WHERE shares_mean IS NOT NULL AND NOT isnan(shares_mean))"""

# Valuation straight from the definition: statistics of close * mean shares.
_VSTATS = """vstats AS (
  SELECT p.ticker,
         avg(p.close * v.shares_mean) FILTER (WHERE p.close > 0) AS v_mean,
         min(p.close) FILTER (WHERE p.close > 0) * any_value(v.shares_mean) AS v_min,
         max(p.close) FILTER (WHERE p.close > 0) * any_value(v.shares_mean) AS v_max,
         var_pop(p.close * v.shares_mean) FILTER (WHERE p.close > 0) AS v_var
  FROM prices p JOIN valid v ON p.ticker = v.ticker
  GROUP BY p.ticker)"""

_STOCK = ",\n".join([_PRICES, _FUND, _FPAIRS, _PSTATS, _SHARES, _VSTATS])


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_MOVIES = """movies AS (
  SELECT CAST(p_partkey AS VARCHAR) AS movie_id, p_name AS title,
         CASE WHEN p_size > 45 THEN NULL
              ELSE p_type || '|' || replace(p_name, ' ', '|')
                   || CASE WHEN p_size < 8 THEN '||' ELSE '' END END AS genres
  FROM part
  UNION ALL
  SELECT 's' || CAST(s_suppkey AS VARCHAR), s_name,
         CASE WHEN s_acctbal >= 0 THEN 'nation' || CAST(s_nationkey AS VARCHAR) END
  FROM supplier)"""

_RATINGS = """ratings AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS user_id,
         CASE WHEN l_tax = 0.08 THEN 'x' ELSE '' END || CAST(l_partkey AS VARCHAR) AS movie_id,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS rating,
         strftime(l_shipdate, '%Y-%m-%d') AS ts, CAST(l_discount >= 0.05 AS INT) AS late
  FROM lineitem)"""

_TAGS = """tags AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS user_id,
         CASE WHEN l_tax = 0.08 THEN 'x' ELSE '' END || CAST(l_partkey AS VARCHAR) AS movie_id,
         'tag' || CAST(l_linenumber AS VARCHAR) AS tag,
         strftime(l_shipdate, '%Y-%m-%d') AS ts
  FROM lineitem)"""


def _cells_ctes(batch: str = "0") -> str:
    """``batch``: the rank of a rating's batch; at equal versions the later one wins."""
    tag_part = """
    SELECT movie_id AS row_key, 'tag' AS family, user_id AS qualifier,
           tag || '|' || ts AS value, ts AS version, 0 AS batch FROM tags
    UNION ALL"""
    return f"""info AS (
  SELECT movie_id AS row_key, 'info' AS family, 'title' AS qualifier, title AS value, '' AS version
  FROM movies
  UNION ALL
  SELECT movie_id, 'info', 'genres', genres, '' FROM movies WHERE genres IS NOT NULL),
raw_user_cells AS ({tag_part}
    SELECT movie_id AS row_key, 'rating' AS family, user_id AS qualifier,
           rating || '|' || ts AS value, ts AS version, {batch} AS batch FROM ratings),
user_cells AS (
  SELECT row_key, family, qualifier, value, version FROM (
    SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier
                                 ORDER BY version DESC, batch DESC, value DESC) AS rn
    FROM raw_user_cells) WHERE rn = 1
  AND row_key IN (SELECT movie_id FROM movies)),
cells AS (SELECT * FROM info UNION ALL SELECT * FROM user_cells)"""


_CELLS = _with(_MOVIES, _RATINGS, _TAGS, _cells_ctes())

_LATEST_R = """latest_r AS (
  SELECT movie_id, user_id, rating, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY movie_id, user_id
                                 ORDER BY ts DESC, rating || '|' || ts DESC) AS rn
    FROM ratings) WHERE rn = 1)"""

_SUMMARY = """summary AS (
  SELECT row_key AS movie_id,
         max(CASE WHEN family = 'info' AND qualifier = 'genres' THEN value END) AS genres,
         count(*) FILTER (WHERE family = 'tag') AS num_tags,
         sum(CASE WHEN family = 'rating'
                  THEN CAST(CAST(split_part(value, '|', 1) AS FLOAT) AS DOUBLE) END) AS rating_sum,
         count(*) FILTER (WHERE family = 'rating') AS rating_cnt
  FROM cells GROUP BY row_key),
exploded AS (
  SELECT movie_id, unnest(CASE
           WHEN g = '' THEN ['']
           WHEN regexp_replace(g, '\\|+$', '') = '' THEN []::VARCHAR[]
           ELSE string_split(regexp_replace(g, '\\|+$', ''), '|') END) AS genre,
         rating_sum, rating_cnt, num_tags
  FROM (SELECT *, coalesce(genres, '(no genres listed)') AS g FROM summary))"""


ORACLE_SQL: dict[str, str] = {
    "price_pairs": _with(_PRICES) + "SELECT ticker, close FROM prices",
    "fundamental_pairs": _with(_FUND, _FPAIRS) + "SELECT ticker, shares FROM fpairs",
    "price_stats": _with(_PRICES, _PSTATS) + """SELECT ticker, round(p_mean, 6) AS p_mean,
  p_min, p_max, round(p_var / 1e9, 6) AS p_var FROM pstats""",
    "mean_shares": _with(_FUND, _FPAIRS, _SHARES)
    + "SELECT ticker, round(shares_mean, 3) AS shares_mean FROM valid",
    "scaled_stats": "WITH " + _STOCK + """
SELECT ticker, round(v_mean / 1e3, 1) AS s_mean, round(v_var / 1e9, 2) AS s_var FROM vstats""",
    "valuation_stats": "WITH " + _STOCK + """
SELECT ticker, round(v_mean / 1e3, 1) AS v_mean, round(v_min / 1e3, 1) AS v_min, round(v_max / 1e3, 1) AS v_max,
       round(v_var / 1e9, 2) AS v_var FROM vstats""",
    "stock_report": "WITH " + _STOCK + """
SELECT s.ticker, round(p_mean, 6) AS p_mean, p_min, p_max, round(p_var / 1e9, 6) AS p_var,
       round(v_mean / 1e3, 1) AS v_mean, round(v_min / 1e3, 1) AS v_min, round(v_max / 1e3, 1) AS v_max,
       round(v_var / 1e9, 2) AS v_var
FROM pstats s JOIN vstats v ON s.ticker = v.ticker ORDER BY s.ticker""",
    "stat_union": "WITH " + _STOCK + """
SELECT ticker, 'price' AS kind, round(p_mean, 6) AS mean, round(p_min, 6) AS min,
       round(p_max, 6) AS max, round(p_var / 1e9, 2) AS var FROM pstats
UNION ALL
SELECT ticker, 'valuation', round(v_mean / 1e3, 1), round(v_min / 1e3, 1), round(v_max / 1e3, 1),
       round(v_var / 1e9, 2) FROM vstats""",
    "sorted_values": _with(_PRICES) + """SELECT ticker, close, count(*) AS n, min(position) AS first_position
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY close) AS position FROM prices)
GROUP BY ticker, close""",
    "price_tickers_without_fundamentals": "WITH " + _STOCK + """
SELECT DISTINCT ticker FROM prices WHERE ticker NOT IN (SELECT ticker FROM valid)""",
    "fundamental_tickers_without_prices": "WITH " + _STOCK + """
SELECT ticker FROM valid WHERE ticker NOT IN (SELECT ticker FROM prices)""",
    "fundamental_tickers_invalid": _with(_FUND, _FPAIRS, _SHARES) + """
SELECT ticker FROM shares_agg WHERE shares_mean IS NULL OR isnan(shares_mean)""",
    "stock_records_read": _with(_PRICES, _FUND) + """
SELECT (SELECT count(*) FROM prices) AS price_records_read,
       (SELECT count(*) FROM fundamentals) AS fundamentals_records_read""",
    "stock_counters": "WITH " + _STOCK + """,
ptick AS (SELECT DISTINCT ticker FROM prices),
c AS (SELECT
  (SELECT count(*) FROM prices) AS price_records_read,
  (SELECT count(*) FROM fundamentals) AS fundamentals_records_read,
  (SELECT count(*) FROM ptick WHERE ticker NOT IN (SELECT ticker FROM valid))
      AS price_tickers_without_fundamentals,
  (SELECT count(*) FROM valid WHERE ticker NOT IN (SELECT ticker FROM ptick))
      AS fundamental_tickers_without_prices,
  (SELECT count(*) FROM shares_agg WHERE shares_mean IS NULL OR isnan(shares_mean))
      AS fundamental_tickers_invalid)
SELECT price_records_read, fundamentals_records_read, price_tickers_without_fundamentals,
       fundamental_tickers_without_prices, fundamental_tickers_invalid,
       CAST(0 AS BIGINT) AS incomplete_price_vectors,
       price_tickers_without_fundamentals AS legacy_missing_price_tickers,
       fundamental_tickers_without_prices + fundamental_tickers_invalid
           AS legacy_missing_fundamentals_tickers
FROM c""",
    "movie_cells": _CELLS + "SELECT row_key, family, qualifier, value, version FROM cells",
    # base and delta differ by discount, so either may hold the newer version
    "upsert_cells": _with(_MOVIES, _RATINGS, _TAGS, _cells_ctes("late"))
    + "SELECT row_key, family, qualifier, value, version FROM cells",
    "upsert_cells_measured": _with(_MOVIES, _RATINGS, _TAGS, _cells_ctes("late"))
    + "SELECT row_key, family, qualifier, value, version FROM cells",
    "movie_cells_salted": _CELLS + "SELECT row_key, family, qualifier, value, version FROM cells",
    "latest_rating_per_user": _with(_RATINGS, _LATEST_R)
    + "SELECT movie_id, user_id, rating, ts FROM latest_r",
    "movie_left_join": _with(_MOVIES, _RATINGS, _TAGS, _LATEST_R) + """,
t AS (SELECT movie_id, count(DISTINCT user_id) AS n FROM tags GROUP BY movie_id),
r AS (SELECT movie_id, sum(CAST(CAST(rating AS FLOAT) AS DOUBLE)) AS s, count(*) AS c
      FROM latest_r GROUP BY movie_id)
SELECT m.movie_id, m.title, m.genres, coalesce(t.n, 0) AS num_tag_users,
       coalesce(r.c, 0) AS num_ratings, coalesce(r.s, 0.0) AS rating_sum
FROM movies m LEFT JOIN t ON m.movie_id = t.movie_id LEFT JOIN r ON m.movie_id = r.movie_id""",
    "tags_per_movie": _with(_TAGS) + """
SELECT movie_id, count(DISTINCT user_id) AS num_tag_users FROM tags GROUP BY movie_id""",
    "rating_totals_per_movie": _with(_RATINGS, _LATEST_R) + """
SELECT movie_id, sum(CAST(CAST(rating AS FLOAT) AS DOUBLE)) AS rating_sum,
       count(*) AS rating_cnt FROM latest_r GROUP BY movie_id""",
    "rating_cells": _CELLS + """
SELECT row_key AS movie_id, qualifier AS user_id,
       CAST(split_part(value, '|', 1) AS FLOAT) AS rating, split_part(value, '|', 2) AS ts
FROM cells WHERE family = 'rating'""",
    "genre_explode": _CELLS + ",\n" + _SUMMARY + """
SELECT movie_id, genre, rating_sum, rating_cnt, num_tags FROM exploded""",
    "genre_stats": _CELLS + ",\n" + _SUMMARY + """
SELECT genre, round(sum(rating_sum) / nullif(sum(rating_cnt), 0), 6) AS avg_rating,
       CAST(sum(num_tags) AS BIGINT) AS num_tags
FROM exploded GROUP BY genre ORDER BY genre""",
    # DecimalFormat("#.################") of the float average: the double
    # text of the widened float without a trailing ".0" (averages here have
    # at most 16 fraction digits, so no rounding step is needed).
    "genre_report_lines": _CELLS + ",\n" + _SUMMARY + """,
g AS (SELECT genre, sum(rating_sum) AS s, sum(rating_cnt) AS c, sum(num_tags) AS t
      FROM exploded GROUP BY genre)
SELECT '(' || genre || ',' ||
       CASE WHEN c = 0 THEN 'NaN'
            ELSE regexp_replace(CAST(CAST(CAST(s / c AS FLOAT) AS DOUBLE) AS VARCHAR), '\\.0$', '') END
       || ' ' || CAST(t AS VARCHAR) || ')' AS value
FROM g""",
    # the text report, read back: 32-bit floats; an undefined mean or variance
    # (NaN in the text) is NULL here
    "stock_report_lines": "WITH " + _STOCK + """
SELECT v.ticker, CAST(p_mean AS FLOAT) AS p_mean,
       CASE WHEN p_min IS NULL THEN 'Infinity'::FLOAT ELSE CAST(p_min AS FLOAT) END AS p_min,
       CAST(coalesce(p_max, 0) AS FLOAT) AS p_max, CAST(p_var AS FLOAT) AS p_var,
       CAST(p_mean * shares_mean AS FLOAT) AS v_mean,
       CASE WHEN p_min IS NULL THEN 'Infinity'::FLOAT ELSE CAST(p_min * shares_mean AS FLOAT) END AS v_min,
       CAST(coalesce(p_max * shares_mean, 0) AS FLOAT) AS v_max,
       CAST(p_var * shares_mean * shares_mean AS FLOAT) AS v_var
FROM pstats p JOIN valid v ON p.ticker = v.ticker""",
    "mean_turnaround": """
SELECT count(*) AS n_jobs,
       round(avg(epoch(l_shipdate) - epoch(o_orderdate)), 3) AS mean_turnaround_seconds
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}
ORACLE_SQL["genre_stats_of_cells"] = ORACLE_SQL["genre_stats"]

# a text file has no NULL genres: they are empty, and make cells
_TEXT_CELLS = _CELLS.replace("genres, '' FROM movies WHERE genres IS NOT NULL", "coalesce(genres, ''), '' FROM movies")
ORACLE_SQL.update(text_queries.oracle(_with(_MOVIES), _with(_PRICES), _CELLS, _TEXT_CELLS))
ORACLE_SQL.update(table_queries.oracle("WITH " + _STOCK, _CELLS, _CELLS + ",\n" + _SUMMARY,
                                       ORACLE_SQL["upsert_cells"], ORACLE_SQL["rating_cells"]))
