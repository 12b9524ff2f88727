"""Stored cell tables: relative paths, shared update folders, refolds, versions."""

from __future__ import annotations

import os

from conftest import write_lines
from pyspark.sql import functions as F

from keystat.operators.cells import newest_cells
from keystat.operators.genres import genre_stats
from keystat.plans import movie_cells
from keystat.sources.cell_store import bucketed_cells, read_cells, read_cells_with_updates
from keystat.sources.csv_inputs import read_movies
from keystat.streaming.rating_updates import start_updates


def inputs(folder, rating="4", ts="100"):
    write_lines(f"{folder}/movie.csv", ["1,One,Drama|Comedy", "2,Two,Drama", "3,T3,"])
    write_lines(f"{folder}/tag.csv", ["7,1,fun,50"])
    write_lines(f"{folder}/rating/part-0", [f"7,1,{rating},{ts}", "8,2,3,90"])


def values(df):
    return {(r["row_key"], r["family"], r["qualifier"]): r["value"] for r in df.collect()}


def test_relative_paths(spark, workdir):
    # the JVM's working directory is this process's; a folder below it, then
    name = os.path.relpath(workdir, os.getcwd()) + "/it's"
    inputs(f"{name}/in")
    movie_cells.run(spark, f"{name}/in", f"{name}/t1")
    first = values(read_cells(spark, f"{name}/t1"))
    assert len(first) == 9 and first[("3", "info", "genres")] == ""
    assert values(bucketed_cells(spark, f"{name}/t1")) == first
    inputs(f"{name}/in2", rating="5", ts="200")
    movie_cells.run(spark, f"{name}/in2", f"{name}/t2", base=f"{name}/t1")
    second = values(read_cells(spark, f"{name}/t2"))
    assert second == {**first, ("1", "rating", "7"): "5|200"}
    genres = {r["genre"]: r["num_tags"] for r in genre_stats(read_cells(spark, f"{name}/t2")).collect()}
    assert genres == {"Drama": 1, "Comedy": 1, "": 0}
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("keystat_cells")]


def test_streams_share_a_folder_and_refold(spark, workdir):
    inputs(f"{workdir}/in")
    movie_cells.run(spark, f"{workdir}/in", f"{workdir}/v1", buckets=2)
    movies = read_movies(spark, f"{workdir}/in/movie.csv")
    ups = f"{workdir}/ups"

    def stream(family, line, checkpoint):
        write_lines(f"{workdir}/land-{checkpoint}/a.csv", [line])
        start_updates(spark, f"{workdir}/land-{checkpoint}", movies, ups, f"{workdir}/cp-{checkpoint}", family=family,
                      available_now=True).awaitTermination()

    stream("rating", "7,1,1,150", "r")
    stream("tag", "9,2,new,60", "t")
    stream("rating", "8,2,2,95", "again")  # another checkpoint: begins at batch 0 too
    merged = values(read_cells_with_updates(spark, f"{workdir}/v1", ups))
    assert (merged[("1", "rating", "7")], merged[("2", "tag", "9")], merged[("2", "rating", "8")]) == (
        "1|150", "new|60", "2|95")
    # folded with newer inputs of an equal version, the stale batch doesn't win again
    inputs(f"{workdir}/in2", rating="5", ts="150")
    movie_cells.run(spark, f"{workdir}/in2", f"{workdir}/v2", base=f"{workdir}/v1", updates=ups)
    assert values(read_cells(spark, f"{workdir}/v2"))[("1", "rating", "7")] == "5|150"
    assert values(read_cells_with_updates(spark, f"{workdir}/v2", ups))[("1", "rating", "7")] == "5|150"
    movie_cells.run(spark, f"{workdir}/in2", f"{workdir}/v3", base=f"{workdir}/v2", updates=ups)
    assert values(read_cells(spark, f"{workdir}/v3")) == values(read_cells(spark, f"{workdir}/v2"))


def test_versions_of_any_length(spark):
    order = ["2010-01-01", "2011", "0", "9", "10", "010000000000000000", "1733270400000000", "1733270400000000001",
             "9" * 40]
    order = sorted(order, key=lambda v: (v.isdigit(), int(v) if v.isdigit() else v))
    for old, new in zip(order[:-1], order[1:], strict=True):
        cells = spark.createDataFrame([("m", "rating", "u", "old", old), ("m", "rating", "u", "new", new)],
                                      "row_key string, family string, qualifier string, value string, version string")
        assert newest_cells(cells).first()["value"] == "new", (old, new)
    assert newest_cells(cells.where(F.lit(False))).count() == 0
