"""Streaming updates of the cell table from newly landed rating/tag files.

The original re-ran its build to push new ratings into the table. Here new
CSV files dropped into a landing directory are picked up by a Structured
Streaming query. Each micro-batch is turned into cells (newest-wins inside
the batch, only known movies kept by a stream-static semi join) and written
as its own update directory ``stream=<query id>/batch=<id>``. The query id belongs
to the checkpoint: a batch replayed after a failure rewrites its own directory,
while another stream, or the same one begun anew with an empty checkpoint, never touches it. Each
batch carries the time it was written, which orders batches across streams. Readers merge the updates over
the base version (:func:`keystat.sources.cell_store.read_cells_with_updates`);
the build job's ``--updates`` folds them into a new version.

No streaming state is kept: nothing grows with the number of cells ever
seen, and every batch's work is proportional to its own files.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keystat import schemas
from keystat.operators.cells import RATING, TAG, newest_cells, user_cells
from keystat.operators.joins import restrict_to_keys
from keystat.sources.cell_store import qualified

_SCHEMAS = {RATING: schemas.RATINGS_CSV, TAG: schemas.TAGS_CSV}
_VALUE = {RATING: "rating", TAG: "tag"}


def update_stream(spark: SparkSession, landing_dir: str, family: str = RATING, *,
                  header: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of raw cells from CSV files landing in ``landing_dir``."""
    reader = (spark.readStream.schema(_SCHEMAS[family])
              .option("header", header).option("quote", '"').option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return user_cells(reader.csv(landing_dir), family, _VALUE[family])


def batch_writer(movies: DataFrame, updates_dir: str):
    """``foreachBatch`` function: newest-wins inside the batch, known movies
    only, written to ``updates_dir/stream=<query id>/batch=<id>`` (idempotent)."""
    known = movies.select(F.col("movie_id").alias("row_key"))

    def write(batch: DataFrame, batch_id: int) -> None:
        # the size check (broadcast or salted) runs per batch: the movie
        # table may have grown since the query started
        cells = restrict_to_keys(newest_cells(batch), known, "row_key",
                                 spread=["qualifier", "version"], probe_big_keys=True)
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("update batches are written by a streaming query")
        (cells.withColumn("written_at", F.lit(int(time.time() * 1000)).cast("long"))
         .write.mode("overwrite").parquet(f"{qualified(spark, updates_dir)}/stream={stream}/batch={batch_id}"))

    return write


def start_updates(spark: SparkSession, landing_dir: str, movies: DataFrame, updates_dir: str,
                  checkpoint_location: str, *, family: str = RATING, header: bool = False,
                  available_now: bool = False, processing_time: str | None = None,
                  query_name: str | None = None) -> StreamingQuery:
    """Start the update stream. ``available_now=True`` consumes what has
    landed and stops (scheduled runs); otherwise it keeps polling."""
    w = (update_stream(spark, landing_dir, family, header=header).writeStream
         .foreachBatch(batch_writer(movies, updates_dir))
         .option("checkpointLocation", checkpoint_location))
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
