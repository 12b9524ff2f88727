"""Streamed rating updates merged over a base table equal a batch rebuild."""

from __future__ import annotations

import os

from conftest import read_text_dir, write_lines
from test_golden_movies import MOVIES, make_input

from keystat.plans import genre_report, movie_cells
from keystat.sources.cell_store import read_cells, read_cells_with_updates
from keystat.sources.csv_inputs import read_movies
from keystat.streaming.rating_updates import start_updates


def test_stream_updates_then_fold(spark, workdir):
    src = make_input(workdir)
    base = os.path.join(workdir, "v1")
    movie_cells.run(spark, src, base)

    landing = os.path.join(workdir, "landing")
    write_lines(os.path.join(landing, "a.csv"), ["7,1,1.0,2011-01-01", "9,99,5.0,2011-01-01"])
    updates = os.path.join(workdir, "updates")
    movies = read_movies(spark, os.path.join(src, "movie.csv"))
    q = start_updates(spark, landing, movies, updates, os.path.join(workdir, "ckpt"),
                      available_now=True)
    q.awaitTermination(120)
    # second landing file, second run of the same query (resumes from the checkpoint)
    write_lines(os.path.join(landing, "b.csv"), ["5,2,4.5,2011-01-01", "7,1,0.5,2010-06-01"])
    q = start_updates(spark, landing, movies, updates, os.path.join(workdir, "ckpt"),
                      available_now=True)
    q.awaitTermination(120)

    merged = {(r.row_key, r.family, r.qualifier): r.value
              for r in read_cells_with_updates(spark, base, updates).collect()}
    assert merged[("1", "rating", "7")] == "1.0|2011-01-01"  # older update does not win
    assert merged[("2", "rating", "5")] == "4.5|2011-01-01"
    assert not any(k[0] == "99" for k in merged)

    out = os.path.join(workdir, "report")
    genre_report.run(spark, base, out, updates=updates)
    assert read_text_dir(out) == [
        "((no genres listed),NaN 0)", "(Animation,2 2)", "(Comedy,2 2)", "(Drama,3.5 1)"]

    # folding the updates into a new version gives the same cells
    v2 = os.path.join(workdir, "v2")
    empty = make_input(workdir, movies=MOVIES, tags=[], ratings=[], name="empty")
    movie_cells.run(spark, empty, v2, base=base, updates=updates)
    folded = {(r.row_key, r.family, r.qualifier): r.value for r in read_cells(spark, v2).collect()}
    assert folded == merged


def test_stream_tag_updates(spark, workdir):
    src = make_input(workdir)
    base = os.path.join(workdir, "v1")
    movie_cells.run(spark, src, base)
    landing = os.path.join(workdir, "tags")
    # user 5 tags movie 2 twice in one file: one cell, newest tag wins
    write_lines(os.path.join(landing, "t.csv"), ["5,2,first,2012-01-01", "5,2,second,2012-02-01",
                                                 "6,3,plain,2012-01-01"])
    updates = os.path.join(workdir, "tag_updates")
    movies = read_movies(spark, os.path.join(src, "movie.csv"))
    q = start_updates(spark, landing, movies, updates, os.path.join(workdir, "ckpt_tags"),
                      family="tag", available_now=True)
    q.awaitTermination(120)
    merged = {(r.row_key, r.family, r.qualifier): r.value
              for r in read_cells_with_updates(spark, base, updates).collect()}
    assert merged[("2", "tag", "5")] == "second|2012-02-01"
    assert merged[("3", "tag", "6")] == "plain|2012-01-01"
    out = os.path.join(workdir, "report")
    genre_report.run(spark, base, out, updates=updates)
    lines = read_text_dir(out)
    assert "((no genres listed),NaN 1)" in lines and "(Drama,2.5 2)" in lines
