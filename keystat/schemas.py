"""Input and output schemas (positions as the original programs read them)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()

# prices CSV: date, ticker, open, close, ... (only ticker and close are used).
# Numbers are read as text and cast with ANSI rules, so a malformed close
# fails the job like Double.parseDouble does.
PRICES_CSV = T.StructType([
    T.StructField("date", S), T.StructField("ticker", S),
    T.StructField("open", S), T.StructField("close", S),
])

# fundamentals CSV: 79 fields; field 1 is the ticker, field 78 the shares.
FUNDAMENTALS_WIDTH = 79
FUNDAMENTALS_CSV = T.StructType(
    [T.StructField("row_no", S), T.StructField("ticker", S)]
    + [T.StructField(f"f{i}", S) for i in range(2, FUNDAMENTALS_WIDTH - 1)]
    + [T.StructField("shares_outstanding", S)]
)

# Movie inputs keep every field as text: the cell table stores text and only
# the genre report parses ratings.
MOVIES_CSV = T.StructType([
    T.StructField("movie_id", S), T.StructField("title", S), T.StructField("genres", S),
])
TAGS_CSV = T.StructType([
    T.StructField("user_id", S), T.StructField("movie_id", S),
    T.StructField("tag", S), T.StructField("ts", S),
])
RATINGS_CSV = T.StructType([
    T.StructField("user_id", S), T.StructField("movie_id", S),
    T.StructField("rating", S), T.StructField("ts", S),
])

# Long cell table: one row per (row_key, family, qualifier), newest version wins.
CELLS = T.StructType([
    T.StructField("row_key", S, False), T.StructField("family", S, False),
    T.StructField("qualifier", S, False), T.StructField("value", S),
    T.StructField("version", S),
])

# Job log for the turnaround statistic.
JOBS = T.StructType([
    T.StructField("job_id", S), T.StructField("arrival", T.TimestampNTZType()),
    T.StructField("finish", T.TimestampNTZType()),
])

STOCK_REPORT_COLUMNS = ["ticker", "p_mean", "p_min", "p_max", "p_var",
                        "v_mean", "v_min", "v_max", "v_var"]
