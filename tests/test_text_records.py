"""Lines, quoted records and number texts against plain versions."""

from __future__ import annotations

import math
import random

import pytest
from conftest import write_lines
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from keystat.functions.numbers import is_number, number, strict_number
from keystat.functions.records import comma_fields, quoted_fields, quoted_line
from keystat.sources.csv_inputs import fundamental_lines, price_lines, read_fundamentals, read_movies, read_prices


def _parse(spark, text: str):
    """What the JVM's own parser makes of a text; None if it refuses it."""
    try:
        return spark._jvm.java.lang.Double.parseDouble(text)
    except Exception:  # NumberFormatException, wrapped by the gateway
        return None


def _number_texts() -> list[str]:
    rng = random.Random(4)
    parts = ["", " ", "\t", "+", "-", "0", "12", "00", ".", "5", "e", "E", "3", "0x", "0X", "1f", "A.8", "p", "P", "-2", "+2",
             "d", "D", "f", "F", "NaN", "Infinity", "inf", "nan", "NAN", "infinity", "\x00", "\x1f", " ", " ", "_", ","]
    fixed = ["", " ", ".", "1.", ".1", "1.e3", "1e", "0x1p3", "0x.8p1", "0x1.p0d", "0x1", "0xp1", "1d", "1dd", "NaNd", "+NaN",
             "-Infinity ", "Infinityf", "1e400", "-1e-400", "4.9e-324", "1_0", "1,0", "٣", "1\n", "\n1", "1 2", "0x1p1024", "--1"]
    return fixed + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 7))) for _ in range(1500)]


def test_numbers_are_those_of_the_jvm(spark):
    texts = list(dict.fromkeys(_number_texts()))
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", number(F.col("t")).alias("x"), is_number(F.col("t")).alias("ok")).collect()
    for r in rows:
        want = _parse(spark, r.t)
        assert r.ok == (want is not None), repr(r.t)
        assert (r.x is None) == (want is None), repr(r.t)
        assert want is None or r.x == want or (math.isnan(want) and math.isnan(r.x)), repr(r.t)
    null = spark.range(1).select(number(F.lit(None).cast("string")).alias("x")).first()
    assert null.x is None


@pytest.mark.parametrize("text", ["1,5", "inf", "", None])
def test_strict_numbers_fail(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(strict_number(F.col("t"), "close"))
    with pytest.raises(PySparkException, match="bad close field"):
        df.collect()


def _split(line: str) -> list[str]:
    fields = line.split(",")
    while len(fields) > 1 and fields[-1] == "":
        fields.pop()
    return [] if fields == [""] and line else fields


def test_comma_fields(spark):
    lines = ["", ",", ",,", "a", "a,", ",a", "a,,b,,", " a , b ", '"a,b"', "a\tb,c", "," * 200 + "x", "é,ü,,"]
    got = spark.createDataFrame([(x,) for x in lines], "v string").select("v", comma_fields("v").alias("f")).collect()
    for r in got:
        assert r.f == _split(r.v), repr(r.v)


def test_short_price_lines_fail_or_are_null(spark):
    for line in ("d,T,1", "d,T,1,,,,", "", "d,T,1,x"):
        df = spark.createDataFrame([(line,)], "value string")
        with pytest.raises(PySparkException):
            price_lines(df).collect()
    df = spark.createDataFrame([("d,T,1,",), ("d",), ("d,U,1,2.5f,9",)], "value string")
    assert [tuple(r) for r in price_lines(df, on_bad="null").collect()] == [("T", None), (None, None), ("U", 2.5)]
    with pytest.raises(ValueError):
        price_lines(df, on_bad="skip")


def test_fundamental_lines(spark):
    filler = ",".join(["x"] * 76)
    lines = [f"0,A,{filler},5", f"0,B,{filler},", f"0,C,{filler}", f"0,D,{filler},,more", f"0,E,{filler}, 0x10p0 ,more", "0,F"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [tuple(r) for r in fundamental_lines(df).collect()] == [
        ("A", 5.0), ("B", None), ("C", None), ("D", None), ("E", 16.0), ("F", None)]
    bad = spark.createDataFrame([(f"0,G,{filler},five",)], "value string")
    with pytest.raises(PySparkException, match="bad shares field"):
        fundamental_lines(bad).collect()
    assert fundamental_lines(bad, on_bad="null").first().shares is None
    with pytest.raises(PySparkException, match="missing ticker"):
        fundamental_lines(spark.createDataFrame([("alone",)], "value string")).collect()


def test_headers_of_every_file_are_skipped(spark, workdir):
    for i in range(3):
        write_lines(f"{workdir}/p/part{i}.csv", ["date,ticker,open,close", f'd,T{i},"1,{i}'])
    got = read_prices(spark, f"{workdir}/p", header=True).orderBy("ticker").collect()
    assert [tuple(r) for r in got] == [("T0", 0.0), ("T1", 1.0), ("T2", 2.0)]
    assert read_prices(spark, f"{workdir}/p", on_bad="null").count() == 6


def test_quoted_inputs_of_numbers(spark, workdir):
    write_lines(f"{workdir}/q.csv", ['d,"T,1",1,"2.5d"'])
    assert [tuple(r) for r in read_prices(spark, f"{workdir}/q.csv", quoted=True).collect()] == [("T,1", 2.5)]
    write_lines(f"{workdir}/f.csv", ["0,A" + ",x" * 76 + ',"7"', "0,B"])
    got = read_fundamentals(spark, f"{workdir}/f.csv", quoted=True).collect()
    assert [tuple(r) for r in got] == [("A", 7.0), ("B", None)]


NASTY = ["plain", 'q"uo"te', "a,b", "two\nlines", "\r\n", '"', '""', ",", " lead", "trail ", "back\\slash", "\\", '\\"', "é x", "'"]


def test_quoted_records_round_trip(spark, workdir):
    rows = [(str(i), t, g) for i, t in enumerate(NASTY) for g in ("A|B", None, NASTY[(i + 3) % len(NASTY)])]
    df = spark.createDataFrame(rows, "movie_id string, title string, genres string")
    lines = df.select(quoted_line(*[F.col(c) for c in df.columns]).alias("value"))
    back = lines.select(quoted_fields("value", "movie_id string, title string, genres string").alias("r")).select("r.*")
    assert [tuple(r) for r in back.collect()] == rows
    short = spark.createDataFrame([("7",), ('8,"x"',)], "value string").select(
        quoted_fields("value", "movie_id string, title string, genres string").alias("r")).select("r.*")
    assert [tuple(r) for r in short.collect()] == [("7", None, None), ("8", "x", None)]
    lines.coalesce(2).write.text(f"{workdir}/m")
    got = {tuple(r) for r in read_movies(spark, f"{workdir}/m", line_ends=True).collect()}
    # a scan of files takes CR LF for a line end
    want = {(i, t.replace("\r\n", "\n"), (g or "").replace("\r\n", "\n")) for i, t, g in rows}
    assert {tuple(x.replace("\r\n", "\n") for x in r) for r in got} == want
