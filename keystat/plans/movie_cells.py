"""Table build: movie.csv, tag.csv, rating/ -> cell table (optionally an upsert).

    python -m keystat.plans.movie_cells INPUT_DIR OUTPUT_TABLE [--base TABLE] [--updates DIR]

Without ``--base`` the output holds the cells of the inputs. With it, the
inputs are merged into the base version (cells the inputs do not touch stay;
touched ones resolve newest-wins) and the result is written to the new
``OUTPUT_TABLE`` directory; ``--updates`` folds streamed update batches in
as well. Tables are bucketed by cell identity (see
:mod:`keystat.sources.cell_store`), so an upsert shuffles only the new cells.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from keystat.operators.cells import (CELL_COLUMNS, build_cells, merge_aligned, newest_cells,
                                     raw_cells, upsert_cells)
from keystat.session import checkpoint_dir, get_session
from keystat.sources.cell_store import (bucket_count, bucketed_cells, buckets_of, folded_batches,
                                        qualified, read_cell_updates, read_cells, write_cells)
from keystat.sources.csv_inputs import read_movie_inputs


def run(spark: SparkSession, input_dir: str, output: str, *, base: str | None = None,
        updates: str | None = None, header: bool = False, buckets: int | None = None) -> None:
    """Build a table version from the inputs, or upsert them into ``base``.

    Upsert into a bucketed base: the new cells (with any streamed update
    batches folded in first) are the delta of a bucket-aligned merge join;
    the base is read in place, only the delta is shuffled, and the output is
    written bucket by bucket with the base's bucket count. Update batches that
    the base holds already are skipped, and the output's layout names all it holds.
    """
    if base and qualified(spark, base) == qualified(spark, output):
        raise ValueError("the output table must be a new directory, not the base being read")
    movies, tags, ratings = read_movie_inputs(spark, input_dir, header=header)
    cells = build_cells(movies, tags, ratings)
    if not base:
        write_cells(cells, output, buckets=buckets or buckets_of(raw_cells(movies, tags, ratings)))
        return
    # The delta is read by the size checks and by the merge: checkpoint it
    # once into the shared checkpoint folder (lineage cut, survives the loss
    # of the executors that computed it).
    checkpoint_dir(spark)
    delta = cells.checkpoint()
    n = bucket_count(spark, base)
    folded = folded_batches(spark, base)
    if updates:
        # update batches are newer than the base and older than these inputs
        pending = read_cell_updates(spark, updates, folded)
        folded += [r["source"] for r in pending.select("source").distinct().collect()]  # one per batch
        delta = newest_cells(pending.select(*CELL_COLUMNS, "batch").unionByName(
            delta.withColumn("batch", F.lit(1 << 62))), priority="batch")
    if n is None:  # a table without bucket layout: DataFrame-level upsert
        stored = read_cells(spark, base)
        write_cells(upsert_cells(stored, delta), output, buckets=buckets or buckets_of(stored, delta), folded=folded)
        return
    merged = merge_aligned(bucketed_cells(spark, base), delta, unique=True, buckets=n)
    write_cells(merged, output, buckets=n, aligned=True, folded=folded)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("input_dir")
    ap.add_argument("output")
    ap.add_argument("--base", help="existing cell table to merge into")
    ap.add_argument("--updates", help="directory of streamed update batches to fold in")
    ap.add_argument("--header", action="store_true")
    ap.add_argument("--buckets", type=int,
                    help="bucket count of a new table (default: by the measured bytes of the cells)")
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    spark = get_session(args.master, "keystat-movie-cells")
    run(spark, args.input_dir, args.output, base=args.base, updates=args.updates,
        header=args.header, buckets=args.buckets)
    return 0


if __name__ == "__main__":
    sys.exit(main())
