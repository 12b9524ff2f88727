"""Golden rows of the stock job (FIXTURES.md §2.1), through the CSV sources."""

from __future__ import annotations

import os

from conftest import read_text_dir, write_lines

from keystat.operators import stocks as S
from keystat.plans import stock_report as job
from keystat.sources.csv_inputs import read_fundamentals, read_prices

PRICES = [
    "2016-01-04,AAA,10.0,10.0,9.0,11.0,100",
    "2016-01-05,AAA,10.0,12.0,9.0,13.0,100",
    "2016-01-06,AAA,11.0,-1.0,9.0,13.0,100",
    "2016-01-04,BBB,5.0,0.0,5.0,5.0,10",
    "2016-01-04,CCC,7.0,7.5,7.0,8.0,10",
    "2016-01-04,DDD,3.0,3.25,3.0,4.0,10",
]
FILLER = ",".join(["x"] * 76)
FUNDAMENTALS = [
    f"0,AAA,{FILLER},100.0",
    f"1,AAA,{FILLER},200.0",
    f"2,AAA,{FILLER},-5.0",
    f"3,BBB,{FILLER},50.0",
    f"4,CCC,{FILLER},",
    f"5,EEE,{FILLER},10.0",
]


def _inputs(workdir):
    p = write_lines(os.path.join(workdir, "prices.csv"), PRICES)
    f = write_lines(os.path.join(workdir, "fundamentals.csv"), FUNDAMENTALS)
    return p, f


def test_report_rows(spark, workdir):
    p, f = _inputs(workdir)
    rows = S.stock_report(read_prices(spark, p), read_fundamentals(spark, f)).collect()
    assert [r.ticker for r in rows] == ["AAA", "BBB"]
    aaa = rows[0].asDict()
    assert aaa == {"ticker": "AAA", "p_mean": 11.0, "p_min": 10.0, "p_max": 12.0, "p_var": 1.0,
                   "v_mean": 1650.0, "v_min": 1500.0, "v_max": 1800.0, "v_var": 22500.0}
    bbb = rows[1].asDict()
    assert all(bbb[k] is None for k in bbb if k != "ticker")


def test_job_text_and_counters(spark, workdir):
    p, f = _inputs(workdir)
    out = os.path.join(workdir, "out")
    counters = job.run(spark, p, f, out, counters_path=os.path.join(workdir, "counters"))
    assert read_text_dir(out) == [
        "(AAA,11.0 10.0 12.0 1.0 1650.0 1500.0 1800.0 22500.0)",
        "(BBB,NaN Infinity 0.0 NaN NaN Infinity 0.0 NaN)",
    ]
    assert counters == {
        "price_records_read": 6, "fundamentals_records_read": 6,
        "price_tickers_without_fundamentals": 2,   # CCC (invalid mean), DDD
        "fundamental_tickers_without_prices": 1,   # EEE
        "fundamental_tickers_invalid": 1,          # CCC
        "incomplete_price_vectors": 0,
        "legacy_missing_price_tickers": 2,
        "legacy_missing_fundamentals_tickers": 2,
    }
    assert job.legacy_lines(counters) == [
        ">> Missing price tickers: 2",
        ">> Missing fundamentals tickers: 2",
        ">> Stock price records read: 6",
        ">> Fundamentals records read: 6",
    ]


def test_bad_close_fails(spark, workdir):
    import pytest
    p = write_lines(os.path.join(workdir, "bad.csv"), ["2016-01-04,AAA,1.0,abc"])
    with pytest.raises(Exception):
        read_prices(spark, p).collect()
    assert read_prices(spark, p, on_bad="null").collect()[0].close is None


def test_short_price_row_fails(spark, workdir):
    import pytest
    p = write_lines(os.path.join(workdir, "short.csv"), ["2016-01-04,AAA,1.0"])
    with pytest.raises(Exception):
        read_prices(spark, p).collect()
