"""A movie holding about half of all cells: both skew measures, same rows.

The fixture keeps the driver's ratings but gives every line its own user (so
newest-wins keeps them all) and moves about half of them onto one movie. The
input is spread over several map tasks, as a many-file input would be.
"""

from __future__ import annotations

from conftest import SF_CHECK
from pyspark.sql import functions as F

from keystat.operators import cells as C
from keystat.operators.joins import hot_key_factors
from keystat.sources import driver_tables as T

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _hot_ratings(spark):
    r = T.ratings(spark, SF_CHECK).repartition(8)
    r = r.withColumn("user_id", F.concat_ws("-", "user_id", "movie_id", "ts", "rating"))
    return r.withColumn("movie_id", F.when(F.xxhash64("user_id") % 2 == 0, F.lit("1"))
                        .otherwise(F.col("movie_id")))


def _run(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        cells = C.build_cells(T.movies(spark, SF_CHECK), None, _hot_ratings(spark))
        rows = sorted(tuple(r) for r in cells.collect())
        plan = cells._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return rows, plan


def test_even_movies_cells_move_once(spark):
    ratings = T.ratings(spark, SF_CHECK).repartition(8)
    inputs = T.movies(spark, SF_CHECK), T.tags(spark, SF_CHECK), ratings
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        even = C.build_cells(*inputs)
        rows = sorted(tuple(r) for r in even.collect())
        plan = even._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    initial = plan[plan.index("Initial Plan"):]
    # the lines are dealt by movie, joined and resolved there; the rest are the movies' keys and info cells
    exchanges = [line for line in initial.splitlines() if "Exchange hashpartitioning" in line]
    assert "_salt" in "".join(exchanges) and not any("qualifier" in line for line in exchanges)
    assert rows == sorted(tuple(r) for r in C.build_cells(*inputs).collect())
    assert C.build_cells(T.movies(spark, SF_CHECK), None, ratings.limit(0), strategy="shuffle").where("family = 'rating'").count() == 0


def test_hot_movie_is_split_by_salt_or_by_aqe(spark):
    hot = _hot_ratings(spark).where(F.col("movie_id") == "1").count()
    assert hot > 10000
    # 1. no key counts as hot: AQE splits the skewed semi-join partition at
    #    run time (possible because the join sits above newest-wins and
    #    nothing above it needs its partitioning)
    aqe_rows, aqe_plan = _run(spark, {**SKEW_CONF, "keystat.skew.hotKeyRows": "1000000000"})
    assert "SortMergeJoin(skew=true)" in aqe_plan
    # 2. hot keys are salted up front: the movie gets a factor by its size
    salted_rows, salted_plan = _run(spark, {**SKEW_CONF, "keystat.skew.hotKeyRows": "500"})
    factors = {r.row_key: r._factor for r in
               hot_key_factors(_hot_ratings(spark).select(F.col("movie_id").alias("row_key")),
                               "row_key", hot_rows=500).collect()}
    assert factors["1"] == -(-hot // 500)
    assert "_salt" in salted_plan
    # 3. same cells either way, and the same as a plain semi join
    plain = C.build_cells(T.movies(spark, SF_CHECK), None, _hot_ratings(spark))
    assert aqe_rows == salted_rows == sorted(tuple(r) for r in plain.collect())


def test_lines_are_dealt_before_newest_wins_unless_a_cell_is_hot(spark):
    movies, ratings = T.movies(spark, SF_CHECK), T.ratings(spark, SF_CHECK).repartition(8)
    versions = F.sequence(F.lit(1), F.lit(900)).cast("array<string>")
    repeated = ratings.where(F.col("movie_id") == "1").limit(1).withColumn("ts", F.explode(versions))
    old = spark.conf.get("keystat.skew.hotKeyRows", None)

    def sorted_in_splits(ratings):  # newest-wins of lines below their exchange
        cells = C.build_cells(movies, None, ratings).where("family = 'rating'")
        tree = cells._jdf.queryExecution().executedPlan().toString().splitlines()
        dealt = next(i for i, line in enumerate(tree) if "Exchange hashpartitioning(row_key" in line and "qualifier" in line)
        return any("Aggregate" in line for line in tree[dealt:]), sorted(map(tuple, cells.collect()))

    try:
        spark.conf.set("keystat.skew.hotKeyRows", "500")
        combined, rows = sorted_in_splits(ratings.unionByName(repeated))
        even, _ = sorted_in_splits(ratings)
        spark.conf.set("keystat.skew.hotKeyRows", "1000000")
        dealt, same = sorted_in_splits(ratings.unionByName(repeated))
    finally:
        spark.conf.unset("keystat.skew.hotKeyRows") if old is None else spark.conf.set("keystat.skew.hotKeyRows", old)
    assert combined and not even and not dealt
    assert rows == same and any(version == "900" for *_, version in rows)


def test_lines_go_to_as_many_tasks_as_their_number_needs(spark):
    inputs = T.movies(spark, SF_CHECK), None, T.ratings(spark, SF_CHECK).repartition(8)
    n, parts = inputs[2].count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit, conf = n // (5 * parts), {}
    same = sorted(map(tuple, C.build_cells(*inputs).collect()))
    try:
        # broadcast keys, even movies, and a movie with a large share
        for threshold, ratings in (("10m", inputs[2]), ("-1", inputs[2]), ("-1", _hot_ratings(spark))):
            conf |= {"spark.sql.autoBroadcastJoinThreshold": threshold, "keystat.skew.hotKeyRows": str(limit),
                     "spark.sql.adaptive.skewJoin.enabled": "false"}
            old = {k: spark.conf.get(k, None) for k in conf}
            for k, v in conf.items():
                spark.conf.set(k, v)
            cells = C.build_cells(T.movies(spark, SF_CHECK), None, ratings)
            users = cells.where("family = 'rating'")
            largest = users.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
            assert largest <= (2.5 * limit if ratings is inputs[2] else n // parts)  # several of a movie's shares may meet
            if ratings is inputs[2]:
                assert sorted(map(tuple, cells.collect())) == same
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
