"""Column functions: Java split edges (FIXTURES §2.3), positive statistics with
NaN (§2.4), float and decimal text."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from keystat.functions.positive import (positive_max, positive_mean, positive_min,
                                        positive_var_pop)
from keystat.functions.text import decimal_text, float_text, split_pipes
from keystat.operators.genres import genre_list


def test_split_edges(spark):
    cases = [("", [""]), ("|", []), ("|a", ["", "a"]), ("a||b", ["a", "", "b"]),
             ("a|b||", ["a", "b"]), ("||", []), ("a", ["a"])]
    df = spark.createDataFrame([(c,) for c, _ in cases], "g string")
    got = {r.g: r.p for r in df.select("g", split_pipes("g").alias("p")).collect()}
    assert got == dict(cases)


def test_missing_genres_default(spark):
    df = spark.createDataFrame([(None,)], "genres string")
    assert df.select(genre_list().alias("g")).first().g == ["(no genres listed)"]


def _stats(spark, values):
    df = spark.createDataFrame([("k", v) for v in values], "key string, x double")
    return df.groupBy("key").agg(positive_mean("x").alias("mean"), positive_min("x").alias("min"),
                                 positive_max("x").alias("max"), positive_var_pop("x").alias("var")).first()


def test_positive_stats_nan(spark):
    r = _stats(spark, [float("nan"), 2.0, -3.0])
    assert math.isnan(r.mean) and math.isnan(r["var"])
    assert r["min"] == 2.0 and r["max"] == 2.0


def test_positive_stats_single_and_none(spark):
    r = _stats(spark, [5.0])
    assert (r.mean, r["min"], r["max"], r["var"]) == (5.0, 5.0, 5.0, 0.0)
    r = _stats(spark, [0.0, -1.0])
    assert (r.mean, r["min"], r["max"], r["var"]) == (None, None, None, None)


def test_scaled_by_row_column(spark):
    df = spark.createDataFrame([("k", 1.0, 2.0), ("k", 3.0, 2.0), ("k", -1.0, 2.0)],
                               "key string, x double, k double")
    r = df.groupBy("key").agg(positive_mean("x", "k").alias("m"),
                              positive_var_pop("x", F.col("k")).alias("v")).first()
    assert r.m == 4.0 and r.v == 4.0


def test_text_renderings(spark):
    df = spark.createDataFrame([(11.0,), (1.23456789e10,), (1.7976931348623157e308,), (4.9e-324,)],
                               "x double")
    assert [r.t for r in df.select(float_text("x").alias("t")).collect()] == [
        "11.0", "1.23456788E10", "Infinity", "0.0"]
    df = spark.createDataFrame([(3.676757574081421,), (1234567.0,), (None,), (3.5,)], "x double")
    assert [r.t for r in df.select(decimal_text("x").alias("t")).collect()] == [
        "3.676757574081421", "1234567", "NaN", "3.5"]
