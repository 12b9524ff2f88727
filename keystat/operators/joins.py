"""Skew-safe restriction of a large keyed table to a set of known keys.

Three ways, chosen by measured sizes:

* the key set is **broadcast** when its measured size (rows and key bytes, one
  small aggregate over the key column) is within
  ``spark.sql.autoBroadcastJoinThreshold``. A broadcast semi join filters
  each task's rows locally: no shuffle, so no key can be hot.
* otherwise a **salted** shuffle semi join. Keys holding more rows than one
  task should handle are found by a per-key count. All of those keys are salted, and only those: their rows carry
  ``hash(spread) mod factor`` and the key is replicated ``factor`` times on
  the key side, so a blockbuster movie holding a third of all ratings is
  joined by as many tasks as its size calls for.
* for a small table (a streaming micro-batch) against a large key set: its
  own distinct keys, if they fit, are broadcast instead (see
  :func:`restrict_to_keys`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keystat.sources.staged import staged

# A key is hot above this many rows (about one task's worth of work); its
# salt factor is rows / HOT_ROWS rounded up. Rows are dealt to at least as many tasks as hold so many each.
HOT_ROWS_CONF = "keystat.skew.hotKeyRows"
DEFAULT_HOT_ROWS = 2_000_000
# Bytes a broadcast hash relation spends per key row beyond the key text
# (row header, offset/length word, hash-map entry); an upper estimate.
ROW_OVERHEAD_BYTES = 48


def broadcast_limit_bytes(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes as Spark reads it (-1: never broadcast)."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def key_set_bytes(keys: DataFrame, key: str | list[str]) -> int:
    """Measured size of key columns as a broadcast relation (one aggregate job)."""
    cols = [key] if isinstance(key, str) else list(key)
    length = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in cols[1:]),
                 F.coalesce(F.octet_length(F.col(cols[0]).cast("string")), F.lit(0)))
    row = keys.agg(F.count(F.lit(1)).alias("n"),
                   F.coalesce(F.sum(length), F.lit(0)).alias("b")).first()
    return int(row["b"]) + ROW_OVERHEAD_BYTES * int(row["n"])


def fits_broadcast(keys: DataFrame, key: str | list[str]) -> bool:
    """True when the measured key set is within the broadcast threshold."""
    limit = broadcast_limit_bytes(keys.sparkSession)
    return limit >= 0 and key_set_bytes(keys, key) <= limit


def hot_key_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_ROWS_CONF, str(DEFAULT_HOT_ROWS)))


def hot_key_factors(counts_source: DataFrame, key: str, hot_rows: int | None = None,
                    seen: Observation | None = None) -> DataFrame:
    """Keys holding more than ``hot_rows`` rows of ``counts_source``, each with
    a salt factor ``ceil(rows / hot_rows)``.

    The per-key count is a partial + final aggregate (a hot key is one row
    per task before the shuffle). Every key over the limit is in it: at most one
    for each ``hot_rows`` rows of the source, a few MB for 10^12 rows. ``seen`` observes the rows of
    the ``largest`` key and of all keys (``total``) in the same pass.
    """
    hot_rows = hot_rows or hot_key_rows(counts_source.sparkSession)
    counts = counts_source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    if seen is not None:
        counts = counts.observe(seen, F.max("n").alias("largest"), F.sum("n").alias("total"))
    return (counts.where(F.col("n") > hot_rows)
            .select(key, F.ceil(F.col("n") / hot_rows).cast("int").alias("_factor")))


def key_shares(counts_source: DataFrame, key: str) -> tuple[DataFrame, bool, int | None]:
    """(the written hot keys with their factors, whether keys are even, tasks): even if none is hot and the
    largest holds at most the share of one of ``spark.sql.shuffle.partitions`` tasks; ``tasks`` is how many
    the rows need if those would hold more rows each than one should handle, else None."""
    spark, seen = counts_source.sparkSession, Observation()
    hot = staged(hot_key_factors(counts_source, key, seen=seen), "hot-keys")
    largest, total = (seen.get.get(k) or 0 for k in ("largest", "total"))
    parts, tasks = int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // hot_key_rows(spark))
    even = largest * parts <= total and hot.isEmpty()
    return hot, even, tasks if tasks > parts else None


def dealt(rows: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``rows`` dealt by ``keys`` to ``tasks`` tasks; if None, to those Spark chooses."""
    return rows.repartition(tasks, *keys) if tasks else rows.repartition(*keys)


def semi_join_spread(big: DataFrame, keys: DataFrame, key: str, spread: str | list[str],
                     counts_source: DataFrame | None = None, *, factors: DataFrame | None = None,
                     tasks: int | None = None, keep_salt: bool = False) -> DataFrame:
    """Salted shuffle semi join: rows of ``big`` whose ``key`` is in
    ``keys[key]``, with every hot key's rows spread over several tasks.

    Hot keys and their salt factors come from :func:`hot_key_factors` over
    ``counts_source`` (default ``big``; pass a cheaper, column-pruned source
    with at least as many rows per key, such as the raw input of an
    aggregate). A hot key's rows get salt ``hash(spread) mod factor`` and the
    key is replicated ``factor`` times on the key side; every other key has
    salt 0 and one copy, so the key side grows only by the hot keys' factors.
    The factor table holds at most one key for each ``hotKeyRows`` rows; it is written once (both sides
    read it) and broadcast.

    When ``big`` is an aggregate, including one of its aggregate outputs in
    ``spread`` keeps the optimizer from pushing the join below the
    aggregate, where the aggregate would depend on the join's partitioning.

    ``factors`` and ``tasks`` are those of :func:`key_shares`, if they are known. ``keep_salt`` leaves the column ``_salt``,
    by which and ``key`` the rows are dealt: an aggregate by both and other columns needs no exchange.
    """
    cols = [spread] if isinstance(spread, str) else list(spread)
    k = keys.select(key).where(F.col(key).isNotNull())
    if factors is None:
        factors = staged(hot_key_factors(counts_source if counts_source is not None else big, key), "hot-keys")
    factors = F.broadcast(factors)
    salted = (big.join(factors, key, "left")
              .withColumn("_salt", F.when(F.col("_factor").isNull(), F.lit(0)).otherwise(
                  F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.col("_factor")).cast("int")))
              .drop("_factor"))
    if tasks:
        salted = dealt(salted, tasks, key, "_salt")
    replicated = (k.join(factors, key, "left")
                  .select(key, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_factor"), F.lit(1)) - 1))
                          .alias("_salt")))
    joined = salted.join(replicated, [key, "_salt"], "left_semi")
    return joined if keep_salt else joined.drop("_salt")


def restrict_to_keys(big: DataFrame, keys: DataFrame, key: str, spread: str | list[str],
                     counts_source: DataFrame | None = None, *,
                     probe_big_keys: bool = False) -> DataFrame:
    """Rows of ``big`` whose ``key`` appears in ``keys``.

    * the key set's measured size fits the broadcast threshold: broadcast it;
    * ``probe_big_keys`` (``big`` is small, e.g. a streaming micro-batch) and
      ``big``'s own distinct keys fit: broadcast those, keep the known ones
      with one map-side pass over ``keys``, and broadcast that result (no
      larger than ``big``'s key set) back onto ``big``. Neither side is
      shuffled;
    * otherwise a shuffle join with hot keys salted (:func:`semi_join_spread`).
    """
    k = keys.select(key).where(F.col(key).isNotNull())
    if fits_broadcast(k, key):
        return big.join(F.broadcast(k), key, "left_semi")
    if probe_big_keys:
        mine = big.select(key).where(F.col(key).isNotNull()).distinct()
        if fits_broadcast(mine, key):
            found = k.join(F.broadcast(mine), key, "left_semi").distinct()
            return big.join(F.broadcast(found), key, "left_semi")
    return semi_join_spread(big, k, key, spread, counts_source)
