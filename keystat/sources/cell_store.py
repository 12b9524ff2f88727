"""Parquet storage of the cell table: bucketed by cell identity.

Every version is a directory of Parquet files written with Spark's
``bucketBy(N, row_key, family, qualifier)`` and sorted by
``(family, row_key, qualifier)`` within each bucket, plus a hidden
``_keystat_layout`` folder recording ``N`` (Spark's readers skip paths that
start with ``_``). Plain reads are ordinary Parquet reads that split files
freely; a family filter skips row groups through the sorted column's
statistics.

Why buckets: an upsert must bring each delta cell together with the base
cell of the same identity. Registered as a bucketed table, the base already
*is* hash-partitioned by the identity, so the merge join shuffles only the
delta into the base's buckets; the base, the large side, is read in place.
Hashing all three key columns spreads one movie's cells over every bucket.
``N`` is fixed when a table is first built - given, or the measured bytes of the cells by
``keystat.cells.bucketBytes`` (:func:`buckets_of`) - and carried to every later
version. A task sorts one bucket, so the measure is of cells as a task holds them, not of
files, which may be compressed or columnar.

A build or an upsert always writes a *new* directory: Spark cannot safely
overwrite a path it is reading, and a finished directory is an immutable
version that jobs and restarts can re-read. The layout record also names the update
batches that a version already holds, so a reader that is given their directory
again skips them.

Paths are made absolute by Hadoop's file system once, before any use: a relative one means the
same place for plain reads, bucketed writes and the catalog.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystat import schemas
from keystat.operators.cells import (CELL_COLUMNS, CELL_KEY, fits_hash_build, merge_aligned,
                                     merge_cells, newest_cells)
from keystat.operators.joins import key_set_bytes

BUCKET_BYTES_CONF = "keystat.cells.bucketBytes"
DEFAULT_BUCKET_BYTES = 256 << 20
LAYOUT_DIR = "_keystat_layout"
LAYOUT = "buckets int, keys string, folded array<string>"
SORT_COLUMNS = ["family", "row_key", "qualifier"]

UPDATE_SCHEMA = T.StructType([*schemas.CELLS.fields, T.StructField("written_at", T.LongType()),
                              T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType())])


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The absolute form of a path, as its file system sees it."""
    p, fs = _hadoop_path(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def buckets_of(*cells: DataFrame) -> int:
    """Bucket count of a table of these cells, by their rows and text bytes (one aggregate each)."""
    per_bucket = int(cells[0].sparkSession.conf.get(BUCKET_BYTES_CONF, str(DEFAULT_BUCKET_BYTES)))
    return max(1, -(-sum(key_set_bytes(c, CELL_COLUMNS) for c in cells) // per_bucket))


def _table_name() -> str:
    # a name of this call alone: jobs that share a metastore don't meet
    return f"keystat_cells_{uuid.uuid4().hex}"


def write_cells(cells: DataFrame, path: str, *, buckets: int,
                aligned: bool = False, folded: list[str] | None = None) -> None:
    """Write a new table version at ``path`` (which must not exist).

    ``aligned=True`` states that ``cells`` is already hash-partitioned by the
    cell identity into ``buckets`` partitions (the output of a bucketed
    merge), so each task writes exactly one bucket file; otherwise the cells
    are repartitioned by the identity first (one file per bucket). ``folded``
    names the update batches that the cells hold.
    """
    spark = cells.sparkSession
    path = qualified(spark, path)
    out = cells.select(*CELL_COLUMNS)
    if not aligned:
        out = out.repartition(buckets, *CELL_KEY)
    name = _table_name()
    try:
        (out.write.bucketBy(buckets, *CELL_KEY).sortBy(*SORT_COLUMNS)
         .option("path", path).mode("errorifexists").format("parquet").saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external table: the files stay
    (spark.createDataFrame([(buckets, ",".join(CELL_KEY), sorted(folded or []))], LAYOUT)
     .coalesce(1).write.json(f"{path}/{LAYOUT_DIR}"))


def _layout(spark: SparkSession, path: str):
    try:
        return spark.read.schema(LAYOUT).json(f"{qualified(spark, path)}/{LAYOUT_DIR}").first()
    except AnalysisException:
        return None


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """The bucket count recorded with a table version, or None if absent."""
    row = _layout(spark, path)
    return int(row["buckets"]) if row and row["keys"] == ",".join(CELL_KEY) else None


def folded_batches(spark: SparkSession, path: str) -> list[str]:
    """The update batches that a table version already holds."""
    row = _layout(spark, path)
    return list(row["folded"] or []) if row else []


def read_cells(spark: SparkSession, path: str, families: list[str] | None = None) -> DataFrame:
    df = spark.read.schema(schemas.CELLS).parquet(qualified(spark, path))
    if families:
        df = df.where(F.col("family").isin(families))
    return df.select(*CELL_COLUMNS)


def bucketed_cells(spark: SparkSession, path: str) -> DataFrame:
    """The table version as a bucketed table (session catalog entry over the
    directory), so joins on the cell identity reuse its partitioning."""
    n = bucket_count(spark, path)
    if n is None:
        raise ValueError(f"{path} has no bucket layout")
    name = _table_name()
    location = qualified(spark, path).replace("\\", "\\\\").replace("'", "\\'")
    cols = ", ".join(f"{f.name} STRING" for f in schemas.CELLS.fields)
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet "
              f"CLUSTERED BY ({', '.join(CELL_KEY)}) SORTED BY ({', '.join(SORT_COLUMNS)}) "
              f"INTO {n} BUCKETS LOCATION '{location}'")
    try:
        # the frame holds the resolved relation; the external table's entry can go
        return spark.table(name).select(*CELL_COLUMNS)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_cell_updates(spark: SparkSession, updates_dir: str, skip: list[str] | None = None) -> DataFrame:
    """Update batches under ``updates_dir`` (``stream=<id>/batch=<n>``) but those in
    ``skip``: cells with ``source`` (stream/batch) and ``batch``, their order across
    streams: the time they were written."""
    ups = spark.read.schema(UPDATE_SCHEMA).parquet(qualified(spark, updates_dir))
    source = F.concat_ws("/", "stream", F.col("batch").cast("string"))
    if skip:
        seen = F.array(*[F.lit(x) for x in skip])
        ups = ups.where(~F.array_contains(seen, source))
    return ups.select(*CELL_COLUMNS, source.alias("source"), F.col("written_at").alias("batch"))


def read_cells_with_updates(spark: SparkSession, path: str, updates_dir: str | None,
                            families: list[str] | None = None) -> DataFrame:
    """The base version with every update batch applied: newest version wins,
    then the later batch (the base counts as older than every batch). Batches that
    the base already holds are skipped.

    A bucketed base is merged in place (the updates, resolved among
    themselves, are shuffled into its buckets); otherwise small update sets
    are merged without shuffling the base, large ones by a shuffle of both
    (see :func:`keystat.operators.cells.merge_cells`)."""
    if not updates_dir:
        return read_cells(spark, path, families)
    ups = read_cell_updates(spark, updates_dir, folded_batches(spark, path))
    if families:
        ups = ups.where(F.col("family").isin(families))
    n = bucket_count(spark, path)
    if n is not None:
        base = bucketed_cells(spark, path)
        if families:
            base = base.where(F.col("family").isin(families))
        # the raw batches bound the resolved ones: measure them, no dedup pass
        return merge_aligned(base, newest_cells(ups, priority="batch"), unique=True,
                             hash_build=fits_hash_build(ups.select(*CELL_COLUMNS), n))
    return merge_cells(read_cells(spark, path, families), ups, "batch")
