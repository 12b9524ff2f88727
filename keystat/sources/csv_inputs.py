"""CSV scans of the stock and movie inputs.

Every reader declares its schema (no inference pass over the data) and returns a typed
DataFrame. Paths may be files, directories or globs; Spark splits them into tasks by
``spark.sql.files.maxPartitionBytes``. Unquoted inputs are scanned as lines and cut by
:func:`keystat.functions.records.comma_fields`; quoted ones by the CSV source, which
parses only the columns that a query uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keystat import schemas
from keystat.functions.numbers import number, strict_number
from keystat.functions.records import QUOTED_OPTIONS, comma_fields, field_at

# Places (from 0) of the fields in a line, and a fundamentals line's width.
TICKER, CLOSE, SHARES = 1, 3, 78


def _checked(on_bad: str) -> bool:
    if on_bad not in ("fail", "null"):
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")
    return on_bad == "fail"


def _ticker(fields: Column, strict: bool) -> Column:
    ticker = field_at(fields, TICKER)
    return F.coalesce(ticker, F.raise_error(F.lit("missing ticker field"))) if strict else ticker


def price_lines(lines: DataFrame, *, on_bad: str = "fail") -> DataFrame:
    """Unquoted price lines (``value``) -> ``(ticker string, close double)``. A line without a ticker
    or a close that is a number fails the job, or is NULL there (``on_bad="null"``)."""
    strict = _checked(on_bad)
    cut = lines.select(comma_fields("value").alias("fields"))
    close = field_at(F.col("fields"), CLOSE)
    return cut.select(_ticker(F.col("fields"), strict).alias("ticker"),
                      (strict_number(close, "close") if strict else number(close)).alias("close"))


def fundamental_lines(lines: DataFrame, *, on_bad: str = "fail") -> DataFrame:
    """Unquoted fundamentals lines (``value``) -> ``(ticker string, shares double)``, shares of a short
    line or an empty field being NULL (the pair projection maps it to 0)."""
    strict = _checked(on_bad)
    cut = lines.select(comma_fields("value").alias("fields"))
    shares = field_at(F.col("fields"), SHARES)
    value = F.when(F.length(shares) > 0, strict_number(shares, "shares")) if strict else number(shares)
    return cut.select(_ticker(F.col("fields"), strict).alias("ticker"), value.alias("shares"))


def read_lines(spark: SparkSession, path: str, *, header: bool = False) -> DataFrame:
    """The lines of text files as ``value``, without each file's first one if it is a header."""
    if not header:
        return spark.read.text(path)
    # a separator that no line holds: one column, and the source skips the headers
    return (spark.read.schema("value string").option("header", True).option("sep", "\u0001")
            .option("quote", "").csv(path))


def read_prices(spark: SparkSession, path: str, *, header: bool = False,
                quoted: bool = False, on_bad: str = "fail") -> DataFrame:
    """Price lines -> ``(ticker string, close double)``.

    ``quoted=False`` splits on every comma like ``String.split(",")``.
    """
    if not quoted:
        return price_lines(read_lines(spark, path, header=header), on_bad=on_bad)
    close = F.col("close")
    return _quoted_csv(spark, schemas.PRICES_CSV, path, header).select(
        "ticker", (strict_number(close, "close") if _checked(on_bad) else number(close)).alias("close"))


def read_fundamentals(spark: SparkSession, path: str, *, header: bool = False,
                      quoted: bool = False, on_bad: str = "fail") -> DataFrame:
    """Fundamentals lines -> ``(ticker string, shares double)``, as :func:`fundamental_lines`."""
    if not quoted:
        return fundamental_lines(read_lines(spark, path, header=header), on_bad=on_bad)
    shares = F.col("shares_outstanding")
    value = F.when(F.length(shares) > 0, strict_number(shares, "shares")) if _checked(on_bad) else number(shares)
    return _quoted_csv(spark, schemas.FUNDAMENTALS_CSV, path, header).select("ticker", value.alias("shares"))


def _quoted_csv(spark: SparkSession, schema, path: str, header: bool, lines: bool = True) -> DataFrame:
    return spark.read.schema(schema).options(header=header, multiLine=not lines, **QUOTED_OPTIONS).csv(path)


def read_movies(spark: SparkSession, path: str, *, header: bool = False, line_ends: bool = False) -> DataFrame:
    """``movie.csv`` -> ``(movie_id, title, genres)`` (quoted titles may hold commas, and, if
    ``line_ends`` says so, line ends: then each file is one task's).

    An empty or missing genres field is the empty text, which makes a genres cell and one empty
    genre, as the original's text concatenation did; it is not a movie without genres."""
    raw = _quoted_csv(spark, schemas.MOVIES_CSV, path, header, not line_ends)
    return raw.withColumn("genres", F.coalesce("genres", F.lit("")))


def read_tags(spark: SparkSession, path: str, *, header: bool = False) -> DataFrame:
    """``tag.csv`` -> ``(user_id, movie_id, tag, ts)``."""
    return _quoted_csv(spark, schemas.TAGS_CSV, path, header)


def read_ratings(spark: SparkSession, path: str, *, header: bool = False) -> DataFrame:
    """Every part file under ``rating/`` -> ``(user_id, movie_id, rating, ts)``."""
    return _quoted_csv(spark, schemas.RATINGS_CSV, path, header)


def read_movie_inputs(spark: SparkSession, input_dir: str, *, header: bool = False, line_ends: bool = False):
    """The three inputs of the table build: ``movie.csv``, ``tag.csv``, ``rating/``; each
    may be a file or a directory of part files."""
    base = input_dir.rstrip("/")
    return (read_movies(spark, f"{base}/movie.csv", header=header, line_ends=line_ends),
            read_tags(spark, f"{base}/tag.csv", header=header),
            read_ratings(spark, f"{base}/rating/", header=header))
