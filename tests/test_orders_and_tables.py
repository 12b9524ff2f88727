"""Row numbers, range-clustered tables, the wide view, binary keys, stored upserts and the stock job."""

from __future__ import annotations

import random
import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from keystat import table_queries as Q
from keystat.functions.binary_keys import key_long, key_texts, long_key, text_key
from keystat.functions.records import quoted_line
from keystat.operators import cells as C
from keystat.operators import coverage as cov
from keystat.operators import positions
from keystat.operators.positions import with_group_positions, with_positions
from keystat.operators.wide import explode_wide, wide_view
from keystat.plans import movie_cells
from keystat.sources import driver_tables as T
from keystat.sources import range_table
from keystat.sources.cell_store import bucket_count, read_cells
from keystat.sources.range_table import key_ranges, lookup, write_ranges


def _movie_files(inputs, path: str) -> str:
    """The inputs as compressed files of quoted lines."""
    for name, df in zip(("movie.csv", "tag.csv", "rating"), inputs):
        df.select(quoted_line(*[F.col(c) for c in df.columns]).alias("value")).write.option("compression", "gzip").text(f"{path}/{name}")
    return path


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(n: int = 3000) -> list[tuple]:
    rng = random.Random(9)
    # a third of the rows are of one key, some of none
    return [("hot" if rng.random() < 0.33 else rng.choice([None, "", "é", "Z", "a", f"k{rng.randrange(500)}"]), i) for i in range(n)]


def test_positions_are_a_sorted_numbering(spark):
    rows = _rows()
    got = with_positions(spark.createDataFrame(rows, "k string, v int").repartition(5), "k", "v", ranges=7).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))
    assert [(r.k, r.v) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(1, len(rows) + 1))


def test_positions_of_equal_and_descending_keys(spark):
    df = spark.createDataFrame([("same", i) for i in range(500)], "k string, v int")
    got = with_positions(df, "k", name="n", ranges=4)
    assert sorted(r.n for r in got.collect()) == list(range(1, 501))
    down = with_positions(df, F.col("v").desc(), name="n").collect()
    assert all(r.n == 500 - r.v for r in down)
    assert with_positions(df.limit(0), "k").collect() == []


def test_positions_have_no_window_over_all_rows(spark):
    assert "Window" not in _plan(with_positions(spark.range(100).toDF("k"), "k"))


def test_group_positions(spark):
    rows = _rows()
    got = with_group_positions(spark.createDataFrame(rows, "k string, v int"), ["k"], ["v"]).collect()
    groups: dict = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    assert len(got) == len(rows)
    for r in got:
        assert r.group_rows == len(groups[r.k]) and sorted(groups[r.k])[r.position - 1] == r.v


def test_only_large_groups_are_numbered_globally(spark, monkeypatch):
    rows = _rows()
    df = spark.createDataFrame(rows, "k string, v int")
    groups: dict = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)

    def right(got):
        return len(got) == len(rows) and all(
            r.group_rows == len(groups[r.k]) and sorted(groups[r.k])[r.position - 1] == r.v for r in got)

    # rows move once: dealt by their group, numbered there, and gathered without another exchange
    placed = with_group_positions(df, ["k"], ["v"])
    plan = _plan(placed.groupBy("k", F.expr("(position - 1) div 10")).agg(F.collect_list("v")))
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange range" not in plan and "Join" not in plan
    assert right(placed.collect())
    sizes = sorted(map(len, groups.values()))
    for run in (sizes[-1] - 1, 1):  # the largest group alone, nearly all groups
        monkeypatch.setattr(positions, "RUN", run)
        assert right(with_group_positions(df, ["k"], ["v"]).collect())
    cells = df.select(F.col("k").alias("row_key"), F.lit("tag").alias("family"),
                      F.monotonically_increasing_id().cast("string").alias("qualifier"), F.col("v").cast("string").alias("value"))
    monkeypatch.setattr(positions, "RUN", sizes[-1] - 1)
    wide = wide_view(cells, chunk_rows=10)
    assert max(r.n_users for r in wide.collect()) == 10
    back = explode_wide(wide).select("movie_id", "value").collect()
    assert sorted((r.movie_id, int(r.value)) for r in back if r.movie_id is not None) == sorted(r for r in rows if r[0] is not None)
    assert len(back) == len(rows)


def test_range_table(spark, workdir):
    rows = _rows()
    rows = [(k or "", f"{v:05d}") for k, v in rows]
    write_ranges(spark.createDataFrame(rows, "k string, q string"), f"{workdir}/t", ["k", "q"], ranges=9)
    found = sorted((tuple(r.least), tuple(r.greatest), r["rows"], r.range) for r in key_ranges(spark, f"{workdir}/t").collect())
    assert [r[3] for r in found] == list(range(9)) and sum(r[2] for r in found) == len(rows)
    assert max(r[2] for r in found) - min(r[2] for r in found) <= 1  # the hot key is spread
    ends = [tuple(x.encode() for x in e) for r in found for e in r[:2]]
    assert ends == sorted(ends) and len(set(ends)) == len(ends)
    for values in (["hot"], ["Z", "k7", "none"], []):
        got = lookup(spark, f"{workdir}/t", "k", values)
        assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[0] in values)
    # one key that lies in one range: one folder is read
    once = lookup(spark, f"{workdir}/t", "k", [found[0][0][0]])
    assert "PartitionFilters: [range" in re.sub(r"isnotnull\(range#\d+\), ", "", _plan(once))


def test_ranges_are_written_in_pieces_of_bounded_rows(spark, workdir, monkeypatch):
    monkeypatch.setattr(range_table, "PIECE_ROWS", 100)
    monkeypatch.setattr(positions, "RANGE_ROWS", 250)
    rows = [(k or "", f"{v:05d}") for k, v in _rows()]
    write_ranges(spark.createDataFrame(rows, "k string, q string"), f"{workdir}/t", ["k", "q"], ranges=3)
    stored = spark.read.parquet(f"{workdir}/t")
    files = stored.groupBy("range", F.input_file_name().alias("file")).agg(
        F.count("*").alias("n"), F.min(F.struct("k", "q")).alias("a"), F.max(F.struct("k", "q")).alias("z")).collect()
    assert len(files) == 30 and max(r.n for r in files) <= 100
    ends = [tuple(x.encode() for x in e) for r in sorted(files, key=lambda r: tuple(r.a)) for e in (r.a, r.z)]
    assert ends == sorted(ends)  # the files' key intervals are disjoint too
    assert sorted((r.k, r.q) for r in stored.collect()) == sorted(rows)
    ordered = sorted(rows, key=lambda r: (r[0].encode(), r[1]))
    assert sorted((r.range, tuple(r.least), tuple(r.greatest), r["rows"]) for r in key_ranges(spark, f"{workdir}/t").collect()) == [
        (i, ordered[1000 * i], ordered[1000 * i + 999], 1000) for i in range(3)]
    # the numbering itself is dealt into more ranges than the session's shuffle partitions
    placed = with_positions(spark.createDataFrame(rows, "k string, q string"), "k", "q")
    assert placed.select(F.input_file_name()).distinct().count() > 8


def test_lookups_read_only_their_ranges(spark, workdir):
    df = spark.range(1000).select(F.format_string("%05d", "id").alias("k"), F.col("id").cast("string").alias("q"))
    write_ranges(df, f"{workdir}/t", ["k"], ranges=10)
    got = lookup(spark, f"{workdir}/t", "k", ["00250"])
    assert [tuple(r) for r in got.collect()] == [("00250", "250")]
    paths = got.select(F.col("_metadata.file_path")).distinct().collect()
    assert len(paths) == 1 and "range=2" in paths[0][0]
    write_ranges(df.limit(0), f"{workdir}/none", ["k"], ranges=3)


def test_wide_view_chunks_are_bounded(spark):
    cells = [("hot", "rating", f"u{i:05d}", str(i)) for i in range(2505)] + [("m", "tag", "u1", "t"), ("m", "rating", "u1", None)]
    df = spark.createDataFrame(cells, "row_key string, family string, qualifier string, value string")
    wide = wide_view(df, chunk_rows=100).collect()
    assert max(r.n_users for r in wide) == 100 and sum(r.n_users for r in wide) == len(cells)
    hot = sorted((r.chunk, r.n_users) for r in wide if r.movie_id == "hot")
    assert hot == [(i, 100) for i in range(25)] + [(25, 5)]
    back = explode_wide(wide_view(df, chunk_rows=100)).select("movie_id", "family", "user_id", "value").collect()
    assert sorted(map(tuple, back), key=repr) == sorted(cells, key=repr)


TEXTS = ["", "a", "ab", "a\x00", "a\x00b", "a\x00\x00", "\x00", "\x01", "a\x01", "é", "z", "zz", "\U0001f600", "￿", "10", "9"]


def test_text_keys_keep_order_and_come_back(spark):
    rng = random.Random(1)
    rows = [(rng.choice(TEXTS), rng.choice(TEXTS), rng.choice(TEXTS)) for _ in range(800)]
    df = spark.createDataFrame(rows, "a string, b string, c string").select("*", text_key(*map(F.col, "abc")).alias("key"))
    got = df.select("a", "b", "c", "key", *[x.alias(n) for x, n in zip(key_texts(F.col("key"), 3), "xyz")]).collect()
    assert all((r.a, r.b, r.c) == (r.x, r.y, r.z) for r in got)
    by_key = [(r.a, r.b, r.c) for r in sorted(got, key=lambda r: bytes(r.key))]
    assert by_key == sorted(rows, key=lambda r: [t.encode() for t in r])
    assert spark.range(1).select(text_key(F.lit(None).cast("string")).alias("k")).first().k is None


def test_long_keys_keep_order_and_come_back(spark):
    numbers = [0, 1, -1, 255, -256, 1 << 40, -(1 << 40), (1 << 63) - 1, -(1 << 63)]
    df = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", long_key(F.col("n")).alias("k"))
    got = df.select("n", "k", key_long(F.col("k")).alias("back")).collect()
    assert all(r.n == r.back and len(r.k) == 8 for r in got)
    assert [r.n for r in sorted(got, key=lambda r: bytes(r.k))] == sorted(numbers)


def test_version_keys(spark):
    versions = ["", "0", "000", "7", "007", "9", "10", "12345678901234567890", "00012345678901234567891", "2020-01-01", "-5", "1a", "a", "٣"]
    got = {r.v: r.k for r in spark.createDataFrame([(v,) for v in versions], "v string").select(
        "v", C.version_key(F.col("v")).alias("k")).collect()}

    def rank(v):
        digits = v.isascii() and v.isdigit()
        return (digits, int(v) if digits else 0, b"" if digits else v.encode())

    assert sorted(versions, key=lambda v: (got[v].encode(), v)) == sorted(versions, key=lambda v: (rank(v), v))
    keyed = spark.createDataFrame([(v,) for v in versions], "v string").select("v", text_key(C.version_key(F.col("v"))).alias("k"))
    assert [r.v for r in sorted(keyed.collect(), key=lambda r: (bytes(r.k), r.v))] == sorted(versions, key=lambda v: (rank(v), v))


def test_stored_upsert_leaves_the_base_unshuffled(spark):
    merged, n = Q.stored_upsert(spark, SF_SMALL)
    plan = _plan(merged)
    join = plan[plan.index("Join"):]
    base = next(i for i, line in enumerate(join.splitlines()) if "Bucketed: true" in line)
    above = join.splitlines()[:base]
    depth = lambda line: re.match(r"[ :+\-|]*", line).end()
    parents, level = [], depth(join.splitlines()[base])
    for line in reversed(above):
        if depth(line) < level:
            parents.append(line)
            level = depth(line)
    assert parents and not any("Exchange" in line for line in parents)
    assert plan.count("Exchange hashpartitioning") == (1 if n > 1 else plan.count("Exchange hashpartitioning"))


def test_buckets_follow_the_cells_not_the_files(spark, workdir):
    inputs = T.movies(spark, SF_SMALL), T.tags(spark, SF_SMALL), T.ratings(spark, SF_SMALL)
    per_bucket = 200 << 10
    spark.conf.set("keystat.cells.bucketBytes", str(per_bucket))
    try:
        _, n = Q.stored_upsert(spark, SF_SMALL)
        path, whole = Q._stored(spark, *inputs)
        movie_cells.run(spark, _movie_files(inputs, f"{workdir}/in"), f"{workdir}/t")
    finally:
        spark.conf.unset("keystat.cells.bucketBytes")
    assert n > 1 and bucket_count(spark, f"{workdir}/t") == whole
    cells = read_cells(spark, path)
    held = cells.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()
    # compressed input files say little of what a task sorts: about 90 bytes a cell
    assert len(held) == whole and max(r.n for r in held) * 90 < 1.5 * per_bucket


def test_family_scan_pushes_its_filter(spark):
    plan = _plan(Q.q_stored_rating_cells(spark, SF_SMALL))
    assert "EqualTo(family,rating)" in plan.replace("In(family, [rating])", "EqualTo(family,rating)")


def test_stock_job_agrees_with_its_parts(spark):
    prices, fundamentals = T.prices(spark, SF_SMALL), T.fundamentals(spark, SF_SMALL)
    rows = cov.stock_job(prices, fundamentals).collect()
    counters = cov.stock_counters(prices, fundamentals).first().asDict()
    got = {r["key"]: r.n for r in rows if r.section == "counter"}
    assert got == {k: counters[k] for k in got} and len(got) == 5
    for section, df in (("price_without_fundamentals", cov.price_tickers_without_fundamentals(prices, fundamentals)),
                        ("fundamental_without_prices", cov.fundamental_tickers_without_prices(prices, fundamentals))):
        assert sorted(r["key"] for r in rows if r.section == section) == sorted(r.ticker for r in df.collect())
    empty = cov.stock_job(prices.limit(0), fundamentals.limit(0)).collect()
    assert {(r.section, r.n) for r in empty} == {("counter", 0)}


def test_cases_of_prices_occur(spark):
    """Most closes are positive; tickers without a positive close, fundamentals or prices occur."""
    prices, fundamentals = T.prices(spark, "/root/testdata/sf0.01"), T.fundamentals(spark, "/root/testdata/sf0.01")
    assert prices.where("close > 0").count() > 0.9 * prices.count()
    job = cov.stock_job(prices, fundamentals)
    report = job.where("section = 'report'")
    assert report.where("p_mean IS NULL").count() > 0 and report.where("p_mean IS NOT NULL").count() > 0
    for section in ("price_without_fundamentals", "fundamental_without_prices", "fundamental_invalid"):
        assert job.where(F.col("section") == section).count() > 0
