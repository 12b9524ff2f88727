"""Adapters: the driver's parquet tables shaped as this library's inputs.

Each adapter is a projection/filter over one or two parquet scans, so the
filters and the column lists reach the scan (``PushedFilters``,
``ReadSchema``). Shapes equal what the CSV readers return.

Every adapter reads all rows of its tables; the cases that the operators
distinguish are made by values:

* prices(ticker, close): one row per order, the total price as close. Low-priority
  orders have tickers of their own (``n<customer>``), which no fundamentals row has;
  those still pending (about 7 in 100 orders) close at 0.0 under ``s<customer>``: tickers with no
  positive close, some of which have fundamentals.
* fundamentals(ticker, shares): one row per customer, a second one (balance + 100)
  for customers of the BUILDING segment, and one per supplier (``s<supplier>``,
  most without prices); some balances are nonpositive, so some tickers mix valid and
  invalid rows.
* movies(movie_id, title, genres): parts, with genres = type, then the words of
  the name, ``|``-separated, ``||`` appended for sizes under 8, NULL for sizes
  over 45; and suppliers (``s<supplier>``), which have neither tags nor ratings, with
  their nation as genre, NULL for negative balances.
* ratings(user_id, movie_id, rating, ts): one row per line item, supplier as
  user, part as movie, quantity as rating, ship date as ts. Line items of one tax rate rate
  movies that don't exist (``x<part>``).
* tags(user_id, movie_id, tag, ts): one row per line item; the same rate tags movies that don't exist.
* jobs(job_id, arrival, finish): line items with their order date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared schemas of the driver tables read here: no footer-inference job
# per read (with many files, inference would touch every footer).
DRIVER_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _key_text(c: str):
    return F.col(c).cast("string")


def _day_text(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    low = F.col("o_orderpriority") == "5-LOW"
    pending = low & (F.col("o_orderstatus") == "P")
    return o.select(
        F.concat(F.when(pending, "s").when(low, "n").otherwise(""), _key_text("o_custkey")).alias("ticker"),
        F.when(pending, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("close"))


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    bal = F.col("c_acctbal")
    values = F.when(F.col("c_mktsegment") == "BUILDING", F.array(bal, bal + 100)).otherwise(F.array(bal))
    s = table(spark, sf_dir, "supplier")
    return c.select(_key_text("c_custkey").alias("ticker"), F.explode(values).alias("shares")).unionByName(
        s.select(F.concat(F.lit("s"), _key_text("s_suppkey")).alias("ticker"), F.col("s_acctbal").alias("shares")))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    genres = F.concat(F.col("p_type"), F.lit("|"), F.regexp_replace("p_name", " ", "|"),
                      F.when(F.col("p_size") < 8, F.lit("||")).otherwise(F.lit("")))
    s = table(spark, sf_dir, "supplier")
    return p.select(_key_text("p_partkey").alias("movie_id"), F.col("p_name").alias("title"),
                    F.when(F.col("p_size") > 45, F.lit(None).cast("string"))
                    .otherwise(genres).alias("genres")).unionByName(
        s.select(F.concat(F.lit("s"), _key_text("s_suppkey")).alias("movie_id"), F.col("s_name").alias("title"),
                 F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("nation"), _key_text("s_nationkey"))).alias("genres")))


def _movie_of_line():
    return F.concat(F.when(F.col("l_tax") == 0.08, "x").otherwise(""), _key_text("l_partkey")).alias("movie_id")


def ratings(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """``more``: line item columns to keep beside the ratings'."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(_key_text("l_suppkey").alias("user_id"), _movie_of_line(),
                     F.col("l_quantity").cast("long").cast("string").alias("rating"),
                     _day_text("l_shipdate").alias("ts"), *more)


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(_key_text("l_suppkey").alias("user_id"), _movie_of_line(),
                     F.concat(F.lit("tag"), F.col("l_linenumber").cast("string")).alias("tag"),
                     _day_text("l_shipdate").alias("ts"))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(F.concat_ws("-", _key_text("l_orderkey"), _key_text("l_linenumber")).alias("job_id"),
                    F.col("o_orderdate").alias("arrival"), F.col("l_shipdate").alias("finish"))
