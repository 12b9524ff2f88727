"""Tables clustered by a global key order: each range of keys is one folder.

Rows are numbered in key order (:mod:`keystat.operators.positions`) and cut into ranges of equal
numbers of rows, so ranges are disjoint, ascending and exact, also where keys repeat unevenly. A
range is written into a folder of its own (``range=<n>``), as sorted files of consecutive keys with at most
``PIECE_ROWS`` rows each, so a task sorts no more, however large a range is; a small manifest beside the data
names each range's least and greatest key and its rows. A lookup reads the manifest, then only the ranges
that may hold its keys (partition pruning), and in them only the row groups whose
statistics allow it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystat.operators.positions import RANGE_ROWS, with_positions

PIECE_ROWS = RANGE_ROWS
MANIFEST_DIR = "_keystat_ranges"  # Spark's readers skip names that start with _


def write_ranges(df: DataFrame, path: str, keys: list[str], *, ranges: int) -> None:
    """Write ``df`` at ``path`` (which must not exist) as ``ranges`` folders in the order of ``keys``."""
    spark = df.sparkSession
    placed = with_positions(df, *keys, name="_position")
    n = placed.count()
    ranges = int(ranges)
    pieces = max(1, -(-n // (ranges * PIECE_ROWS)))  # of one range

    def range_at(position: str):
        return F.expr(f"({position} - 1) * {ranges} div {max(n, 1)}").cast("int")

    # the k-th of a range's equal pieces goes to a task of its own
    piece = F.expr(f"(_position - 1) * {ranges * pieces} div {max(n, 1)}").cast("int")
    (placed.withColumn("range", range_at("_position")).repartitionById(ranges * pieces, piece).drop("_position")
     .sortWithinPartitions("range", *keys).write.partitionBy("range").parquet(path))
    if not n:
        return
    # the first and the last row of each range: its neighbour is of another one
    at, p = range_at("_position"), F.col("_position")
    ends = placed.where((p == 1) | (p == n) | (range_at("_position - 1") != at) | (range_at("_position + 1") != at))
    key = F.struct(*keys)
    (ends.groupBy(at.alias("range")).agg(F.min(key).alias("least"), F.max(key).alias("greatest"),
                                         (F.max("_position") - F.min("_position") + 1).alias("rows"))
     .coalesce(1).write.parquet(f"{path}/{MANIFEST_DIR}"))  # one row for each range


def key_ranges(spark: SparkSession, path: str) -> DataFrame:
    """(range, least, greatest, rows): a table's manifest, ``least`` and ``greatest`` being structs of the keys."""
    return spark.read.parquet(f"{path}/{MANIFEST_DIR}")


def lookup(spark: SparkSession, path: str, first_key: str, values: list[str]) -> DataFrame:
    """Rows whose first key is one of ``values``, from the ranges that may hold them."""
    m = key_ranges(spark, path)
    may = F.lit(False)
    for v in values:
        may = may | F.lit(v).between(F.col(f"least.{first_key}"), F.col(f"greatest.{first_key}"))
    wanted = [r["range"] for r in m.where(may).select("range").collect()]  # of the manifest
    return spark.read.parquet(path).where(F.col("range").isin(wanted) & F.col(first_key).isin(values)).drop("range")
