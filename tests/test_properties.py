"""Algebraic properties on the driver tables."""

from __future__ import annotations

from conftest import SF_SMALL
from pyspark.sql import functions as F

from keystat.operators import cells as C
from keystat.operators import stocks as S
from keystat.sources import driver_tables as T


def _bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_partition_count_does_not_change_results(spark):
    prices, fund = T.prices(spark, SF_SMALL), T.fundamentals(spark, SF_SMALL)
    base = _bag(S.stock_report(prices, fund).select("ticker", F.round("p_mean", 6), "p_min"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        again = _bag(S.stock_report(prices.repartition(5), fund.repartition(2))
                     .select("ticker", F.round("p_mean", 6), "p_min"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert base == again


def test_nonpositive_rows_are_ignored(spark):
    prices, fund = T.prices(spark, SF_SMALL), T.fundamentals(spark, SF_SMALL)
    noise = prices.select("ticker", (-F.abs(F.col("close"))).alias("close"))
    a = _bag(S.price_stats(prices).select("ticker", F.round("p_mean", 6), F.round("p_var", 2)))
    b = _bag(S.price_stats(prices.unionByName(noise)).select("ticker", F.round("p_mean", 6),
                                                               F.round("p_var", 2)))
    assert a == b
    assert S.mean_shares(fund).count() == S.mean_shares(
        fund.unionByName(fund.select("ticker", F.lit(-1.0).alias("shares")))).count()


def test_valuation_variance_identity(spark):
    """v_var = shares^2 * p_var equals the direct variance of close * shares."""
    prices, fund = T.prices(spark, SF_SMALL), T.fundamentals(spark, SF_SMALL)
    k = S.mean_shares(fund)
    direct = (prices.join(k, "ticker").groupBy("ticker")
              .agg(F.var_pop(F.when(F.col("close") > 0, F.col("close") * F.col("shares_mean")))
                   .alias("d")))
    v = S.valuation_stats(prices, fund).join(direct, "ticker")
    bad = v.where(F.abs(F.col("v_var") - F.col("d")) > F.abs(F.col("d")) * 1e-9 + 1e-6).count()
    assert bad == 0


def test_upsert_identity_and_idempotence(spark):
    cells = C.build_cells(T.movies(spark, SF_SMALL), T.tags(spark, SF_SMALL),
                          T.ratings(spark, SF_SMALL)).cache()
    try:
        assert _bag(C.upsert_cells(cells, cells)) == _bag(cells)
        r = T.ratings(spark, SF_SMALL)
        delta = C.build_cells(T.movies(spark, SF_SMALL), None, r.where(F.col("ts") >= "1999-01-01"))
        once = C.upsert_cells(cells, delta)
        assert _bag(C.upsert_cells(once, delta)) == _bag(once)
    finally:
        cells.unpersist()


def test_newest_wins_numeric_versions(spark):
    rows = [("m", "rating", "u", "4.0|999999999", "999999999"),
            ("m", "rating", "u", "3.0|1000000000", "1000000000")]
    df = spark.createDataFrame(rows, "row_key string, family string, qualifier string, "
                                     "value string, version string")
    assert C.newest_cells(df).first().value == "3.0|1000000000"


def test_upsert_delta_wins_equal_version(spark):
    schema = "row_key string, family string, qualifier string, value string, version string"
    base = spark.createDataFrame([("1", "info", "title", "Old", "")], schema)
    delta = spark.createDataFrame([("1", "info", "title", "A newer title", "")], schema)
    assert C.upsert_cells(base, delta).first().value == "A newer title"


def test_salted_and_broadcast_restriction_agree(spark):
    from keystat.operators.joins import hot_key_factors, restrict_to_keys, semi_join_spread
    r = C.user_cells(T.ratings(spark, SF_SMALL), C.RATING, "rating")
    # one movie holds about half of all rows
    r = r.withColumn("row_key", F.when(F.col("qualifier").cast("int") % 2 == 0, F.lit("4"))
                     .otherwise(F.col("row_key")))
    keys = T.movies(spark, SF_SMALL).where(F.col("movie_id").rlike("[02468]$")).select(
        F.col("movie_id").alias("row_key"))
    a = _bag(restrict_to_keys(r, keys, "row_key", "qualifier"))
    old = spark.conf.get("keystat.skew.hotKeyRows", "2000000")
    try:
        spark.conf.set("keystat.skew.hotKeyRows", "100")
        factors = {row.row_key: row._factor for row in hot_key_factors(r, "row_key").collect()}
        assert factors and factors["4"] == max(factors.values()) > 5
        b = _bag(semi_join_spread(r, keys, "row_key", ["qualifier", "version"]))
    finally:
        spark.conf.set("keystat.skew.hotKeyRows", old)
    assert a == b and len(a) > 0


def test_hot_key_rows_spread_over_tasks(spark):
    """The hot movie's rows land in many join partitions, not one."""
    from keystat.operators.joins import hot_key_factors
    r = C.user_cells(T.ratings(spark, SF_SMALL), C.RATING, "rating").withColumn(
        "row_key", F.lit("4"))
    factors = F.broadcast(hot_key_factors(r, "row_key", hot_rows=50))
    salted = r.join(factors, "row_key", "left").withColumn(
        "_salt", F.pmod(F.xxhash64("qualifier", "version"), F.col("_factor")))
    parts = (salted.repartition(64, "row_key", "_salt")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 8


def test_upsert_strategies_agree(spark):
    m, t, r = T.movies(spark, SF_SMALL), T.tags(spark, SF_SMALL), T.ratings(spark, SF_SMALL)
    base = C.build_cells(m, t, r.where(F.col("ts") < "1997-01-01"))
    delta = C.build_cells(m, None, r.where(F.col("ts") >= "1997-01-01"))
    shuffled = _bag(C.upsert_cells(base, delta, strategy="shuffle"))
    broadcast = _bag(C.upsert_cells(base, delta, strategy="broadcast"))
    full = _bag(C.build_cells(m, t, r))
    assert shuffled == broadcast == full


def test_broadcast_upsert_does_not_shuffle_base(spark):
    schema = "row_key string, family string, qualifier string, value string, version string"
    base = T.table(spark, SF_SMALL, "lineitem").select(
        F.col("l_partkey").cast("string").alias("row_key"), F.lit("rating").alias("family"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("qualifier"),
        F.lit("1|x").alias("value"), F.lit("x").alias("version"))
    delta = spark.createDataFrame([("1", "rating", "9-9", "5|y", "y")], schema)
    plan = C.upsert_cells(base, delta, strategy="auto")._jdf.queryExecution().executedPlan().toString()
    # the only hash exchange is the merge of the (small) touched cells and the delta
    assert "BroadcastExchange" in plan
    scans = [line for line in plan.splitlines() if "lineitem.parquet" in line]
    assert len(scans) == 2


def test_default_upsert_reads_each_side_once(spark):
    base = C.user_cells(T.ratings(spark, SF_SMALL), "rating", "rating")
    delta = C.user_cells(T.tags(spark, SF_SMALL), "tag", "tag")
    plan = C.upsert_cells(base, delta)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert "Broadcast" not in plan


def test_sorted_values_split_equal_runs(spark):
    """One (ticker, close) pair repeated many times still spans several range partitions."""
    df = spark.range(4000).select(F.lit("T").alias("ticker"), F.lit(1.0).alias("close"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = S.sorted_values(df.repartition(4))
        parts = out.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1 and out.count() == 4000


def test_reverse_broadcast_for_small_batches(spark):
    from keystat.operators.joins import key_set_bytes, restrict_to_keys
    keys = T.movies(spark, SF_SMALL).select(F.col("movie_id").alias("row_key"))
    small = T.ratings(spark, SF_SMALL).where(F.col("movie_id").isin("1", "2", "3"))
    batch = C.newest_cells(C.user_cells(small, C.RATING, "rating"))
    limit = (key_set_bytes(batch.select("row_key").distinct(), "row_key")
             + key_set_bytes(keys, "row_key")) // 2
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(limit))
        out = restrict_to_keys(batch, keys, "row_key", "qualifier", probe_big_keys=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = _bag(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
    assert got == _bag(batch.join(keys, "row_key", "left_semi")) and len(got) > 0
