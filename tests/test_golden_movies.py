"""Golden rows of the movie build + genre report (FIXTURES.md §2.2)."""

from __future__ import annotations

import os

from conftest import read_text_dir, write_lines

from keystat.plans import genre_report, movie_cells
from keystat.sources.cell_store import read_cells

MOVIES = [
    '1,"Toy, Story (1995)",Animation|Comedy',
    "2,Solo (2000),Drama",
    "3,Plain (2001),(no genres listed)",
    "10,Unrated (1990),Comedy||",
]
TAGS = [
    "7,1,fun,2009-01-01",
    "7,1,great,2010-01-01",
    "8,1,ok,2009-02-01",
    "9,2,sad,2009-03-01",
    "9,99,orphan,2009-03-01",
]
RATINGS = [
    "7,1,4.0,2009-01-01",
    "8,1,5.0,2009-01-01",
    "8,1,3.0,2010-01-01",
    "9,2,2.5,2009-03-01",
    "9,99,1.0,2009-03-01",
]


def make_input(workdir, movies=MOVIES, tags=TAGS, ratings=RATINGS, name="in"):
    d = os.path.join(workdir, name)
    write_lines(os.path.join(d, "movie.csv"), movies)
    write_lines(os.path.join(d, "tag.csv"), tags)
    write_lines(os.path.join(d, "rating", "part-0.csv"), ratings)
    return d


def test_cells_and_genre_report(spark, workdir):
    src = make_input(workdir)
    table = os.path.join(workdir, "table_v1")
    movie_cells.run(spark, src, table)
    cells = {(r.row_key, r.family, r.qualifier): r.value
             for r in read_cells(spark, table).collect()}
    assert cells[("1", "info", "title")] == "Toy, Story (1995)"
    assert cells[("1", "tag", "7")] == "great|2010-01-01"      # newest tag of user 7
    assert cells[("1", "rating", "8")] == "3.0|2010-01-01"     # newest rating of user 8
    assert not any(k[0] == "99" for k in cells)                # orphans dropped
    assert ("3", "tag", "9") not in cells
    out = os.path.join(workdir, "report")
    genre_report.run(spark, table, out)
    assert read_text_dir(out) == [
        "((no genres listed),NaN 0)",
        "(Animation,3.5 2)",
        "(Comedy,3.5 2)",
        "(Drama,2.5 1)",
    ]


def test_rebuild_merges_into_base(spark, workdir):
    v1 = os.path.join(workdir, "v1")
    movie_cells.run(spark, make_input(workdir), v1)
    # A later batch: user 7 re-rates movie 1, a new user rates movie 2.
    later = make_input(workdir, movies=MOVIES[:2], tags=["9,2,sadder,2011-01-01"],
                       ratings=["7,1,1.0,2011-01-01", "5,2,4.5,2011-01-01"], name="in2")
    v2 = os.path.join(workdir, "v2")
    movie_cells.run(spark, later, v2, base=v1)
    cells = {(r.row_key, r.family, r.qualifier): r.value for r in read_cells(spark, v2).collect()}
    assert cells[("1", "rating", "7")] == "1.0|2011-01-01"
    assert cells[("1", "rating", "8")] == "3.0|2010-01-01"     # untouched cell stays
    assert cells[("2", "rating", "5")] == "4.5|2011-01-01"
    assert cells[("2", "tag", "9")] == "sadder|2011-01-01"
    assert cells[("10", "info", "genres")] == "Comedy||"      # movie absent from batch stays
    out = os.path.join(workdir, "report2")
    genre_report.run(spark, v2, out)
    assert read_text_dir(out) == [
        "((no genres listed),NaN 0)",
        "(Animation,2 2)",
        "(Comedy,2 2)",
        "(Drama,3.5 1)",
    ]


def test_output_must_be_new_directory(spark, workdir):
    import pytest
    with pytest.raises(ValueError):
        movie_cells.run(spark, make_input(workdir), "/x/t", base="/x/t/")


def test_upsert_reads_base_in_place(spark, workdir):
    """The merge into a bucketed base shuffles only the new cells."""
    from pyspark.sql import functions as F

    from keystat.operators.cells import merge_aligned, upsert_cells
    from keystat.sources.cell_store import bucket_count, bucketed_cells
    v1 = os.path.join(workdir, "v1")
    movie_cells.run(spark, make_input(workdir), v1, buckets=8)
    assert bucket_count(spark, v1) == 8
    delta = spark.createDataFrame([("1", "rating", "7", "1.0|2011-01-01", "2011-01-01"),
                                   ("2", "rating", "5", "4.5|2011-01-01", "2011-01-01")],
                                  "row_key string, family string, qualifier string, "
                                  "value string, version string")
    merged = merge_aligned(bucketed_cells(spark, v1), delta)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line and "keystat_cells_" in line]
    assert scan and "Bucketed: true" in scan[0]
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all(", 8)" in e for e in exchanges)  # the delta, into the 8 buckets
    expected = sorted(tuple(r) for r in upsert_cells(read_cells(spark, v1), delta).collect())
    assert sorted(tuple(r) for r in merged.collect()) == expected
    one_family = delta.where(F.col("qualifier") == "7")
    plan1 = merge_aligned(bucketed_cells(spark, v1), one_family)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Bucketed: true" in plan1


def test_bucketed_merge_uses_sort_merge_for_large_deltas(spark, workdir):
    from keystat.operators.cells import merge_aligned
    from keystat.sources.cell_store import bucketed_cells
    v1 = os.path.join(workdir, "v1")
    movie_cells.run(spark, make_input(workdir), v1, buckets=4)
    delta = read_cells(spark, v1)
    small = merge_aligned(bucketed_cells(spark, v1), delta, buckets=4)
    old = spark.conf.get("keystat.merge.hashBuildBytesPerTask", None)
    try:
        spark.conf.set("keystat.merge.hashBuildBytesPerTask", "1")
        large = merge_aligned(bucketed_cells(spark, v1), delta, buckets=4)
        large_plan = large._jdf.queryExecution().executedPlan().toString()
        large_rows = sorted(tuple(r) for r in large.collect())
    finally:
        if old is None:
            spark.conf.unset("keystat.merge.hashBuildBytesPerTask")
        else:
            spark.conf.set("keystat.merge.hashBuildBytesPerTask", old)
    small_plan = small._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in small_plan and "SortMergeJoin" in large_plan
    assert sorted(tuple(r) for r in small.collect()) == large_rows


def test_one_file_per_bucket(spark, workdir):
    """A build writes one file per bucket; an aligned upsert keeps that."""
    def parquet_files(path):
        return [f for f in os.listdir(path) if f.endswith(".parquet")]
    v1, v2 = os.path.join(workdir, "v1"), os.path.join(workdir, "v2")
    movie_cells.run(spark, make_input(workdir), v1, buckets=4)
    later = make_input(workdir, movies=MOVIES[:2], tags=[], ratings=["5,2,4.5,2011-01-01"], name="in2")
    movie_cells.run(spark, later, v2, base=v1)
    for path in (v1, v2):
        files = parquet_files(path)
        buckets = {f.split("_")[-1].split(".")[0] for f in files}
        assert 0 < len(files) == len(buckets) <= 4
