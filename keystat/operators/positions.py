"""Global row numbers without a window over all rows.

The rows are dealt into ranges of the sort key and sorted within each; a row's number is
its place in its range plus the rows of all ranges before. Only the ranges' counts
(one number for each of a chosen number of ranges) meet in one place, never rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keystat.sources.staged import staged

_SEQ_BITS = (1 << 33) - 1  # monotonically_increasing_id: the row's place in its partition
#: Rows that one task sorts, about: more rows make more ranges.
RANGE_ROWS = 1 << 20


def with_positions(df: DataFrame, *order: str | Column, name: str = "position", ranges: int | None = None) -> DataFrame:
    """``df`` with ``name``: each row's place (from 1) in the order of ``order``, ascending
    unless a column says otherwise.

    Rows of equal keys are numbered in the order of their tie-breaker, a row number of
    the input fixed by a first write; it is part of the range key, so that a long run of equal
    keys spreads over several ranges. ``ranges`` is ``spark.sql.shuffle.partitions`` by default, and more
    where those would hold over ``RANGE_ROWS`` rows.
    Nulls come first, as in an ascending sort; an empty table stays empty."""
    spark = df.sparkSession
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    # range partitioning samples its input, so the input is computed once, before
    fixed = staged(df.withColumn("_tie", F.monotonically_increasing_id()), "unordered")
    if not ranges:  # rows are counted from the files' footers
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-fixed.count() // RANGE_ROWS))
    parts = (fixed.repartitionByRange(ranges, *keys, "_tie").sortWithinPartitions(*keys, "_tie")
             .drop("_tie").withColumns({"_range": F.spark_partition_id(),
                                        "_place": F.monotonically_increasing_id().bitwiseAND(F.lit(_SEQ_BITS))}))
    parts = staged(parts, "ordered")
    counts = sorted((r["_range"], r["n"]) for r in parts.groupBy("_range").agg(F.count("*").alias("n")).collect())
    before = [0, *accumulate(n for _, n in counts)]
    starts = spark.createDataFrame([(r, b) for (r, _), b in zip(counts, before)], "_range int, _before long")
    return (parts.join(F.broadcast(starts), "_range")  # one row for each range
            .withColumn(name, F.col("_before") + F.col("_place") + 1).drop("_range", "_place", "_before"))


#: Groups of more rows are numbered globally and joined with their numbers in runs of so many places.
RUN = 1 << 20


def group_position_parts(df: DataFrame, group: list[str], order: list[str], *, name: str = "position",
                         size: str = "group_rows") -> list[DataFrame]:
    """``df`` with each row's place (from 1) in its group, in the order of ``order``, and the group's rows,
    as frames that share no group.

    Groups of up to ``RUN`` rows are numbered by a window: their rows move once and stay dealt by ``group``.
    Places of larger groups come from one global numbering by (group, order), so a hot group is spread over many
    ranges; those groups' first places are joined by (group, run of ``RUN`` places): a key of that join has
    at most ``RUN`` rows, whatever the group's size. Equal rows are numbered as in :func:`with_positions`."""
    # the tie-breakers are fixed once written
    fixed = staged(df.withColumn("_tie", F.monotonically_increasing_id()), "ungrouped")
    hot = staged(fixed.groupBy(*group).agg(F.count("*").alias("_n")).where(F.col("_n") > RUN).drop("_n"), "hot-groups")

    def places(rows: DataFrame) -> DataFrame:
        own = Window.partitionBy(*group)
        return rows.select(*df.columns, F.row_number().over(own.orderBy(*order, "_tie")).cast("long").alias(name),
                           F.count("*").over(own).alias(size))

    if hot.isEmpty():
        return [places(fixed)]

    def same(p: str, g: str) -> Column:
        return reduce(Column.__and__, [F.col(f"{p}.{c}").eqNullSafe(F.col(f"{g}.{c}")) for c in group])

    f, h = fixed.alias("f"), F.broadcast(hot).alias("h")  # at most a group for each RUN rows
    placed = with_positions(f.join(h, same("f", "h"), "left_semi").drop("_tie"), *group, *order, name="_global")
    firsts = placed.groupBy(*group).agg(F.min("_global").alias("_first"), F.count("*").alias(size))
    runs = firsts.withColumn("_run", F.explode(F.sequence(
        F.expr(f"_first div {RUN}"), F.expr(f"(_first + `{size}` - 1) div {RUN}"))))
    p, g = placed.withColumn("_run", F.expr(f"_global div {RUN}")).alias("p"), runs.alias("g")
    large = p.join(g, same("p", "g") & (F.col("p._run") == F.col("g._run"))).select(
        *[F.col(f"p.{c}") for c in df.columns], (F.col("_global") - F.col("_first") + 1).alias(name), F.col(f"g.{size}"))
    return [places(f.join(h, same("f", "h"), "left_anti")), large]


def with_group_positions(df: DataFrame, group: list[str], order: list[str], *, name: str = "position",
                         size: str = "group_rows") -> DataFrame:
    """The rows of :func:`group_position_parts` as one frame."""
    return reduce(DataFrame.unionByName, group_position_parts(df, group, order, name=name, size=size))
