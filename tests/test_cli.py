"""The three jobs through their command-line entry points (in-process)."""

from __future__ import annotations

import os

from conftest import read_text_dir, write_lines
from test_golden_movies import make_input
from test_golden_stocks import FUNDAMENTALS, PRICES

from keystat.plans import genre_report, movie_cells, stock_report


def test_stock_cli(spark, workdir, capsys):
    p = write_lines(os.path.join(workdir, "p.csv"), PRICES)
    f = write_lines(os.path.join(workdir, "f.csv"), FUNDAMENTALS)
    out, counters = os.path.join(workdir, "out"), os.path.join(workdir, "counters")
    assert stock_report.main([p, f, out, "--counters", counters]) == 0
    printed = capsys.readouterr().out.splitlines()
    assert printed[-4:] == [">> Missing price tickers: 2", ">> Missing fundamentals tickers: 2",
                            ">> Stock price records read: 6", ">> Fundamentals records read: 6"]
    assert len(read_text_dir(out)) == 2
    row = spark.read.json(counters).first()
    assert row.legacy_missing_fundamentals_tickers == 2


def test_movie_and_genre_cli(spark, workdir):
    src = make_input(workdir)
    v1, v2 = os.path.join(workdir, "v1"), os.path.join(workdir, "v2")
    assert movie_cells.main([src, v1, "--buckets", "4"]) == 0
    later = make_input(workdir, movies=["2,Solo (2000),Drama"], tags=[],
                       ratings=["5,2,4.5,2011-01-01"], name="in2")
    assert movie_cells.main([later, v2, "--base", v1]) == 0
    out = os.path.join(workdir, "report")
    assert genre_report.main([v2, out]) == 0
    assert read_text_dir(out)[-1] == "(Drama,3.5 1)"


def test_turnaround_cli(spark, workdir, capsys):
    from keystat.plans import turnaround
    jobs = write_lines(os.path.join(workdir, "jobs.csv"), [
        "a,2020-01-01 00:00:00,2020-01-03 00:00:00",
        "b,2020-01-02 00:00:00,2020-01-02 12:00:00",
        "c,2020-01-05 00:00:00,2020-01-11 00:00:00",
    ])
    assert turnaround.main([jobs, "--format", "csv"]) == 0
    assert capsys.readouterr().out.strip().endswith("jobs: 3  mean turnaround (seconds): 244800.0")
