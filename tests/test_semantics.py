
from __future__ import annotations

import math
import os

from conftest import read_text_dir, write_lines
from test_golden_movies import make_input

from keystat.operators import coverage as cov
from keystat.operators import stocks as S
from keystat.operators.cells import build_cells, latest_movies
from keystat.operators.genres import genre_stats
from keystat.plans import stock_report as job
from keystat.sources.csv_inputs import read_fundamentals, read_movie_inputs, read_prices

FILLER = ",".join(["x"] * 76)


def test_nan_shares_make_ticker_invalid(spark, workdir):  # D2, D6
    p = write_lines(os.path.join(workdir, "p.csv"), ["d,AAA,1,10.0", "d,BBB,1,20.0"])
    f = write_lines(os.path.join(workdir, "f.csv"),
                    [f"0,AAA,{FILLER},NaN", f"1,AAA,{FILLER},5.0", f"2,BBB,{FILLER},2.0"])
    prices, fund = read_prices(spark, p), read_fundamentals(spark, f)
    assert [r.ticker for r in S.stock_report(prices, fund).collect()] == ["BBB"]
    c = cov.stock_counters(prices, fund).first()
    assert c.fundamental_tickers_invalid == 1 and c.price_tickers_without_fundamentals == 1


def test_short_and_inner_empty_fundamentals(spark, workdir):  # D7, D25
    f = write_lines(os.path.join(workdir, "f.csv"), [
        "0,AAA,x,y",                                   # short row
        f"1,BBB,{FILLER},,99",                          # field 78 empty, a field after it
        f"2,CCC,{FILLER},7.0,99",                       # field 78 set, extra field ignored
    ])
    rows = {r.ticker: r.shares for r in S.fundamental_pairs(read_fundamentals(spark, f)).collect()}
    assert rows == {"AAA": 0.0, "BBB": 0.0, "CCC": 7.0}


def test_java_number_forms(spark, workdir):  # F3
    p = write_lines(os.path.join(workdir, "p.csv"),
                    ["d,A,1,1d", "d,B,1, 2.5 ", "d,C,1,Infinity", "d,D,1,-0.0"])
    got = {r.ticker: r.close for r in read_prices(spark, p).collect()}
    assert got["A"] == 1.0 and got["B"] == 2.5 and math.isinf(got["C"]) and got["D"] == 0.0


def test_ticker_order_is_textual(spark, workdir):  # D20
    p = write_lines(os.path.join(workdir, "p.csv"), ["d,2,1,1.0", "d,10,1,1.0", "d,1,1,1.0"])
    f = write_lines(os.path.join(workdir, "f.csv"),
                    [f"0,{t},{FILLER},1.0" for t in ("1", "2", "10")])
    out = os.path.join(workdir, "out")
    job.run(spark, p, f, out)
    assert [line.split(",")[0] for line in read_text_dir(out)] == ["(1", "(10", "(2"]


def test_header_option(spark, workdir):  # D21
    p = write_lines(os.path.join(workdir, "p.csv"), ["date,ticker,open,close", "d,A,1,3.0"])
    assert read_prices(spark, p, header=True).collect()[0].close == 3.0


def test_duplicate_movie_rows_keep_greatest(spark):  # D24
    df = spark.createDataFrame([("1", "B title", "X"), ("1", "A title", "Y"), ("2", "T", None)],
                               "movie_id string, title string, genres string")
    got = {r.movie_id: (r.title, r.genres) for r in latest_movies(df).collect()}
    assert got == {"1": ("B title", "X"), "2": ("T", None)}


def test_repeated_genre_counts_twice(spark, workdir):  # D14
    d = make_input(workdir, movies=["1,M,A|A|B"], tags=["5,1,t,2001"], ratings=["5,1,4.0,2001"],
                   name="rep")
    cells = build_cells(*read_movie_inputs(spark, d))
    got = {r.genre: (r.avg_rating, r.num_tags) for r in genre_stats(cells).collect()}
    assert got == {"A": (4.0, 2), "B": (4.0, 1)}


def test_same_time_ratings_resolve_deterministically(spark, workdir):  # D16
    d = make_input(workdir, movies=["1,M,A"], tags=[],
                   ratings=["5,1,2.0,2001", "5,1,4.5,2001", "5,1,3.0,2001"], name="tie")
    cells = build_cells(*read_movie_inputs(spark, d))
    vals = [r.value for r in cells.collect() if r.family == "rating"]
    assert vals == ["4.5|2001"]


def test_quoted_prices_and_lenient_fundamentals(spark, workdir):  # S5/S6, D22
    p = write_lines(os.path.join(workdir, "q.csv"), ['2016-01-04,"A,B",1.0,2.5'])
    assert read_prices(spark, p).collect()[0].ticker == '"A'          # split on every comma
    assert read_prices(spark, p, quoted=True).collect()[0].asDict() == {"ticker": "A,B", "close": 2.5}
    f = write_lines(os.path.join(workdir, "f.csv"), [f"0,AAA,{FILLER},abc", f"1,BBB,{FILLER},3.0"])
    got = {r.ticker: r.shares for r in read_fundamentals(spark, f, on_bad="null").collect()}
    assert got == {"AAA": None, "BBB": 3.0}
    import pytest
    with pytest.raises(Exception):
        read_fundamentals(spark, f).collect()
