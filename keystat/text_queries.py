"""Registered queries over text: tables rendered as lines and records, scanned and parsed again.

The lines are made from whole driver tables, with short rows, empty ends, quotes, line ends and number
texts of every form by the values of other columns, written under the shared folder, and read
by the library's readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystat.functions.numbers import number
from keystat.functions.records import comma_line, quoted_fields, quoted_line
from keystat.operators import cells as C
from keystat.operators import stocks as S
from keystat.sources import driver_tables as T
from keystat.sources.csv_inputs import read_fundamentals, read_movie_inputs, read_movies, read_prices
from keystat.sources.staged import staging_path


def _written(lines: DataFrame, path: str) -> str:
    lines.select("value").write.text(path)
    return path


def q_price_lines_read(spark, sf):
    """Price lines with fields after the close, empty ones at the end, and closes as ``1.5d`` or between blanks."""
    p = T.prices(spark, sf).withColumn("text", F.col("close").cast("string"))
    kind = F.pmod(F.xxhash64("ticker", "close"), F.lit(4))
    text = F.when(kind == 1, F.concat("text", F.lit("d"))).when(kind == 2, F.concat(F.lit(" "), "text", F.lit("\t"))).otherwise(F.col("text"))
    tail = F.when(kind == 0, ",,,").when(kind == 3, ",7,,8").otherwise("")
    lines = p.select(F.concat(comma_line(F.lit("2020-01-01"), F.col("ticker"), F.lit(None), text), tail).alias("value"))
    return read_prices(spark, _written(lines, staging_path(spark, "price-lines")))


def q_fundamental_lines_read(spark, sf):
    """Fundamentals lines of 79 fields and more, short ones, and such whose last field is empty."""
    c = T.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("ticker"), F.col("c_acctbal").cast("string").alias("shares"),
        F.col("c_mktsegment").alias("segment"))
    fillers = lambda n: F.repeat(F.lit(",x"), n)
    head = F.concat_ws(",", F.lit("1"), "ticker")
    whole = F.concat(head, fillers(76))
    line = (F.when(F.col("segment") == "BUILDING", F.concat(whole, F.lit(","), "shares", F.lit(",,more,,")))
            .when(F.col("segment") == "MACHINERY", F.concat(head, fillers(40)))
            .when(F.col("segment") == "AUTOMOBILE", F.concat(whole, F.lit(",,,")))
            .when(F.col("segment") == "FURNITURE", F.concat(whole, F.lit(",,80th")))
            .otherwise(F.concat(whole, F.lit(", "), "shares", F.lit("D "))))
    path = _written(c.select(line.alias("value")), staging_path(spark, "fundamental-lines"))
    return S.fundamental_pairs(read_fundamentals(spark, path))


def q_number_texts(spark, sf):
    """Number texts of every form, and such that are none (``value`` NULL)."""
    o = T.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("string").alias("price"))
    whole = F.col("o_custkey").cast("string")
    hexa = F.lower(F.hex("o_custkey"))
    forms = [
        F.concat(F.lit(" \t"), "price", F.lit("\n ")), F.concat("price", F.lit("d")), F.concat(F.lit("+"), "price", F.lit("F")),
        F.concat(F.lit("-"), "price"), F.concat(whole, F.lit(".e-3")), F.concat(F.lit("."), whole, F.lit("E+2")),
        F.concat(F.lit("0x"), hexa, F.lit("p3")), F.concat(F.lit("-0X"), hexa, F.lit(".8P-1d")), F.lit("NaN"), F.lit("-Infinity"),
        F.lit(" +Infinity"), F.lit("inf"), F.lit("nan"), F.concat("price", F.lit("e")), F.concat(F.lit("0x"), hexa),
        F.concat("price", F.lit(" 1")), F.lit(""), F.lit("."), F.concat(F.lit("--"), "price"), F.concat("price", F.lit("dd"))]
    kind = F.pmod("o_orderkey", F.lit(len(forms))).cast("int")
    text = F.get(F.array(*forms), kind)
    value = number(text)
    return o.select("o_orderkey", F.when(~F.isnan(value), value).alias("value"), F.coalesce(F.isnan(value), F.lit(False)).alias("is_nan"))


def _movies_with_hard_titles(spark, sf):
    m = T.movies(spark, sf)
    hard = F.concat(F.lit('The "'), F.replace("title", F.lit(" "), F.lit(", ")), F.lit('"\n\n("2")'))
    return m.select("movie_id", F.when(F.length("title") % 2 == 0, hard).otherwise(F.col("title")).alias("title"), "genres")


def q_quoted_records(spark, sf):
    """Quoted records parsed as a column: titles hold quotes, commas and line ends."""
    m = _movies_with_hard_titles(spark, sf)
    lines = m.select(quoted_line(F.col("movie_id"), F.col("title"), F.col("genres")).alias("line"))
    return lines.select(quoted_fields("line", "movie_id string, title string, genres string").alias("r")).select("r.*")


def q_quoted_movies_scanned(spark, sf):
    """The same records scanned from files, whose lines are not their records."""
    m = _movies_with_hard_titles(spark, sf)
    lines = m.select(quoted_line(F.col("movie_id"), F.col("title"), F.col("genres")).alias("value"))
    return read_movies(spark, _written(lines, staging_path(spark, "quoted-movies")), line_ends=True)


def q_movie_cells_scanned(spark, sf):
    """The cell table of a directory with ``movie.csv``, ``tag.csv`` and ``rating/``."""
    path = staging_path(spark, "movie-inputs")
    for name, df in (("movie.csv", T.movies(spark, sf)), ("tag.csv", T.tags(spark, sf)), ("rating", T.ratings(spark, sf))):
        _written(df.select(quoted_line(*[F.col(c) for c in df.columns]).alias("value")), f"{path}/{name}")
    return C.build_cells(*read_movie_inputs(spark, path))


def q_newest_mixed_versions(spark, sf):
    """Newest rating per movie and user where versions are days, epoch seconds, and such with leading zeros."""
    r = T.ratings(spark, sf, "l_shipdate", "l_returnflag", "l_linenumber")
    seconds = F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("string")
    version = (F.when(F.col("l_returnflag") == "R", F.col("ts")).when(F.col("l_linenumber") == 1, F.concat(F.lit("000"), seconds))
               .when(F.col("l_linenumber") == 2, F.substring(seconds, 1, 8)).otherwise(seconds))
    cells = C.user_cells(r.withColumn("ts", version), C.RATING, "rating")
    return C.newest_cells(cells).select(F.col("row_key").alias("movie_id"), F.col("qualifier").alias("user_id"), "value", "version")


QUERIES = {
    "price_lines_read": q_price_lines_read,
    "fundamental_lines_read": q_fundamental_lines_read,
    "number_texts": q_number_texts,
    "quoted_records": q_quoted_records,
    "quoted_movies_scanned": q_quoted_movies_scanned,
    "movie_cells_scanned": q_movie_cells_scanned,
    "newest_mixed_versions": q_newest_mixed_versions,
}

_HARD_MOVIES = """
SELECT movie_id, CASE WHEN length(title) % 2 = 0
    THEN 'The "' || replace(title, ' ', ', ') || '"' || chr(10) || chr(10) || '("2")' ELSE title END AS title,
  {genres} AS genres FROM movies"""


def oracle(movies: str, prices: str, cells: str, cells_of_text: str) -> dict[str, str]:
    """Statements of these queries; arguments are WITH clauses that define the inputs."""
    return {
        "price_lines_read": prices + "SELECT ticker, close FROM prices",
        "fundamental_lines_read": """
SELECT CAST(c_custkey AS VARCHAR) AS ticker,
  CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE', 'FURNITURE') OR c_acctbal <= 0 THEN 0.0::DOUBLE
       ELSE c_acctbal END AS shares
FROM customer""",
        "number_texts": """
SELECT o_orderkey, CASE o_orderkey % 20
    WHEN 0 THEN o_totalprice WHEN 1 THEN o_totalprice WHEN 2 THEN o_totalprice WHEN 3 THEN -o_totalprice
    WHEN 4 THEN CAST(o_custkey || 'e-3' AS DOUBLE) WHEN 5 THEN CAST('0.' || o_custkey || 'e2' AS DOUBLE)
    WHEN 6 THEN o_custkey * 8.0::DOUBLE WHEN 7 THEN -(o_custkey + 0.5::DOUBLE) / 2
    WHEN 9 THEN '-Infinity'::DOUBLE WHEN 10 THEN 'Infinity'::DOUBLE END AS value,
  o_orderkey % 20 = 8 AS is_nan
FROM orders""",
        "quoted_records": movies + _HARD_MOVIES.format(genres="genres"),
        "quoted_movies_scanned": movies + _HARD_MOVIES.format(genres="coalesce(genres, '')"),
        "movie_cells_scanned": cells_of_text + "SELECT row_key, family, qualifier, value, version FROM cells",
        "newest_mixed_versions": """
WITH ratings AS (
  SELECT CASE WHEN l_tax = 0.08 THEN 'x' ELSE '' END || l_partkey AS movie_id, CAST(l_suppkey AS VARCHAR) AS user_id,
    CAST(l_quantity AS BIGINT) AS rating, CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) AS seconds,
    CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%Y-%m-%d') WHEN l_linenumber = 1 THEN '000' || seconds
         WHEN l_linenumber = 2 THEN substr(seconds, 1, 8) ELSE seconds END AS version
  FROM lineitem)
SELECT movie_id, user_id, rating || '|' || version AS value, version FROM ratings
QUALIFY row_number() OVER (PARTITION BY movie_id, user_id ORDER BY
  regexp_full_match(version, '[0-9]+') DESC,
  CASE WHEN regexp_full_match(version, '[0-9]+') THEN CAST(version AS HUGEINT) END DESC, version DESC, value DESC) = 1""",
    }
