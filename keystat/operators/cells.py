"""The movie cell table: long rows ``(row_key, family, qualifier, value, version)``.

One row per cell instead of one wide row per movie: a popular movie's raters
are many cells spread by ``(row_key, qualifier)`` over tasks, never one
record holding a map of all of them.

Cells of one movie:

* ``info:title`` and ``info:genres`` (genres only when present),
* ``tag:<user id>`` = ``tag|ts``, one cell per tagging user,
* ``rating:<user id>`` = ``rating|ts``, one cell per rating user.

A second write to the same cell replaces the first. Within one batch the
newest ``version`` (the input's timestamp text, see :func:`version_key`) wins, ties going to the greater value; across batches (upsert) the
newest version wins and, at equal version, the later batch. Within a batch
this is a ``groupBy`` over the cell identity with a ``max`` of an ordering
struct. Where no cell has more lines than one task should handle, a build deals its lines first and
aggregates where they are: Spark sorts for this aggregate, and a partial one before the shuffle would sort
all lines of an input split, of which few repeat. Otherwise that partial aggregate
combines repeated puts of a hot cell map-side. Across batches the same rule is applied by
one of three merges (:func:`merge_cells`, :func:`merge_aligned`), chosen so
that the large base is not shuffled when it need not be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystat.operators.joins import dealt, fits_broadcast, hot_key_factors, key_set_bytes, key_shares, semi_join_spread

# Family and qualifier names of the cell table.
INFO = "info"
TAG = "tag"
RATING = "rating"
TITLE = "title"
GENRES = "genres"

CELL_KEY = ["row_key", "family", "qualifier"]
BASE_BATCH = -(1 << 62)  # batch number of a base version: older than any update batch
HASH_BUILD_CONF = "keystat.merge.hashBuildBytesPerTask"
DEFAULT_HASH_BUILD_BYTES = 256 << 20
CELL_COLUMNS = ["row_key", "family", "qualifier", "value", "version"]


def _text(c: Column) -> Column:
    # Missing CSV fields read as NULL; the original concatenated the empty text.
    return F.coalesce(c, F.lit(""))


def version_key(version: Column) -> Column:
    """A sort key of version texts, itself a text. Digits-only versions (epoch times of any
    length) compare as numbers - by length without leading zeros, then by the
    digits - and are newer than any other version; others compare as text."""
    digits = (F.length(version) > 0) & (F.length(F.translate(version, "0123456789", "")) == 0)
    stripped = F.ltrim(version, F.lit("0"))
    return F.when(digits, F.concat(F.lit("1"), F.lpad(F.length(stripped).cast("string"), 10, "0"), stripped)).otherwise(
        F.concat(F.lit("0"), version))


def newest_cells(cells: DataFrame, priority: str | None = None, dealt_by: str | None = None) -> DataFrame:
    """One row per cell identity: the newest version (:func:`version_key`),
    then higher ``priority`` (if given), then the greater value. ``dealt_by`` names a column that the
    identity determines and by which the cells are dealt already."""
    order = [version_key(F.col("version")).alias("r"), F.col("version")]
    if priority:
        order.append(F.col(priority).alias("p"))
    order.append(F.col("value"))
    return (cells.groupBy(*CELL_KEY, *([dealt_by] if dealt_by else []))
            .agg(F.max(F.struct(*order)).alias("w"))
            .select(*CELL_KEY, F.col("w.value").alias("value"), F.col("w.version").alias("version")))


def latest_movies(movies: DataFrame) -> DataFrame:
    """One row per movie id; duplicates keep the greatest (title, genres)."""
    return (movies.groupBy("movie_id")
            .agg(F.max(F.struct("title", "genres")).alias("m"))
            .select("movie_id", F.col("m.title").alias("title"), F.col("m.genres").alias("genres")))


def _info_of_rows(movies: DataFrame) -> DataFrame:
    pairs = F.array(
        F.struct(F.lit(TITLE).alias("qualifier"), _text(F.col("title")).alias("value")),
        F.struct(F.lit(GENRES).alias("qualifier"), F.col("genres").alias("value")),
    )
    return (movies.select(F.col("movie_id").alias("row_key"), F.inline(pairs))
            .where(F.col("value").isNotNull())
            .select("row_key", F.lit(INFO).alias("family"), "qualifier", "value",
                    F.lit("").alias("version")))


def info_cells(movies: DataFrame) -> DataFrame:
    """``info:title`` and ``info:genres`` per movie (one pass, no union)."""
    return _info_of_rows(latest_movies(movies))


def raw_cells(movies: DataFrame, tags: DataFrame | None, ratings: DataFrame | None) -> DataFrame:
    """The cells of all lines before newest-wins and the restriction to known movies: at least
    those of :func:`build_cells`, in one pass without a shuffle, to measure them by."""
    raw = _info_of_rows(movies)
    if tags is not None:
        raw = raw.unionByName(user_cells(tags, TAG, "tag"))
    if ratings is not None:
        raw = raw.unionByName(user_cells(ratings, RATING, "rating"))
    return raw


def user_cells(events: DataFrame, family: str, value_col: str, batch: str | None = None) -> DataFrame:
    """Tag or rating lines -> raw cells ``<family>:<user_id>`` = ``value|ts``
    (before newest-wins), with ``batch``, 0 where the lines have no such column, if one is named."""
    number = F.col(batch).cast("long") if batch in events.columns else F.lit(0).cast("long")
    return events.select(
        F.col("movie_id").alias("row_key"), F.lit(family).alias("family"),
        F.col("user_id").alias("qualifier"),
        F.concat(_text(F.col(value_col)), F.lit("|"), _text(F.col("ts"))).alias("value"),
        _text(F.col("ts")).alias("version"), *([number.alias("batch")] if batch else []))


def _has_hot_cells(raw: DataFrame, hot: DataFrame) -> bool:
    """Whether a cell has more lines than one task should handle; only those of ``hot`` movies can."""
    if hot.isEmpty():
        return False
    lines = raw.join(F.broadcast(hot.select("row_key")), "row_key", "left_semi")
    return not hot_key_factors(lines.select(F.struct(*CELL_KEY).alias("cell")), "cell").isEmpty()


def build_cells(movies: DataFrame, tags: DataFrame | None, ratings: DataFrame | None, *,
                strategy: str = "auto", batch: str | None = None) -> DataFrame:
    """All cells of a table build. Tags and ratings of movies absent from
    ``movies`` are dropped; movies without any are kept (title/genres only).

    The restriction is a left-semi join on ``row_key``
    (:mod:`keystat.operators.joins`): when the measured movie-key set fits the broadcast
    threshold, a broadcast that drops unknown movies' lines as they are read; otherwise a join salted by
    user id. If movies are even (:func:`keystat.operators.joins.key_shares`), the lines are dealt by movie once, joined,
    and newest-wins runs where they are: all cells move once. If some movie holds a large share, newest-wins
    comes first and the join after it, by many tasks for that movie.
    Lines are dealt by cell, or by movie, before newest-wins unless a cell is hot; then it combines map-side.
    They go to as many tasks as their measured number needs, however few ``spark.sql.shuffle.partitions`` are.
    ``strategy="shuffle"`` takes the salted join without measuring the key set.

    ``batch`` names a column of the lines that numbers the batch they came in: at equal versions the
    later batch wins, as if each batch had been upserted in turn, in one pass over all."""
    parts = []
    if tags is not None:
        parts.append(user_cells(tags, TAG, "tag", batch))
    if ratings is not None:
        parts.append(user_cells(ratings, RATING, "rating", batch))
    info = info_cells(movies)
    if not parts:
        return info
    raw = parts[0]
    for p in parts[1:]:
        raw = raw.unionByName(p)
    known = movies.select(F.col("movie_id").alias("row_key"))
    priority = "batch" if batch else None
    # (the lines' keys are counted: a column-pruned pass, at least as many rows
    # per movie as after newest-wins)
    hot, even, tasks = key_shares(raw.select("row_key"), "row_key")
    combine = _has_hot_cells(raw, hot)

    def newest(lines: DataFrame) -> DataFrame:
        # (not by the family, which the optimizer folds away where there is one: the lines would move again)
        return newest_cells(lines if combine else dealt(lines, tasks, "row_key", "qualifier"), priority)

    if strategy == "auto" and fits_broadcast(known, "row_key"):
        return info.unionByName(newest(raw.join(F.broadcast(known), "row_key", "left_semi")))
    if even:  # dealt by the join already, unless Spark broadcasts it
        joined = semi_join_spread(raw, known, "row_key", spread="qualifier", factors=hot, tasks=tasks, keep_salt=True)
        return info.unionByName(newest_cells(dealt(joined, tasks, "row_key", "_salt"), priority, dealt_by="_salt"))
    # spread by user and the winning version (an aggregate output: the join
    # stays above newest-wins, see joins.semi_join_spread)
    users = semi_join_spread(newest(raw), known, "row_key", spread=["qualifier", "version"], factors=hot, tasks=tasks)
    return info.unionByName(users)


def merge_cells(base: DataFrame, delta: DataFrame, priority: str, *,
                strategy: str = "shuffle") -> DataFrame:
    """Apply ``delta`` (cells with a numeric ``priority`` column, higher =
    later batch) to ``base`` (cells, treated as the oldest batch).

    ``shuffle``: newest-wins over the union of both, a full shuffle of the
    base by cell identity. ``broadcast``: only the base cells whose identity
    occurs in the delta are merged; the delta's cell identities are broadcast,
    the base is split map-side into untouched cells (anti join, passed
    through unshuffled) and touched ones (semi join, merged with the delta).
    ``auto`` measures the delta's key set against the broadcast threshold.
    """
    d = delta.select(*CELL_COLUMNS, F.col(priority).cast("long").alias("_batch"))
    if strategy == "auto":
        strategy = "broadcast" if fits_broadcast(d.select(*CELL_KEY), CELL_KEY) else "shuffle"
    b = base.select(*CELL_COLUMNS)
    oldest = F.lit(BASE_BATCH).cast("long")
    if strategy == "shuffle":
        return newest_cells(b.withColumn("_batch", oldest).unionByName(d), priority="_batch")
    if strategy != "broadcast":
        raise ValueError(f"strategy must be auto, shuffle or broadcast, not {strategy!r}")
    keys = F.broadcast(d.select(*CELL_KEY))
    untouched = b.join(keys, CELL_KEY, "left_anti")
    touched = b.join(keys, CELL_KEY, "left_semi").withColumn("_batch", oldest)
    merged = newest_cells(touched.unionByName(d), priority="_batch")
    return untouched.unionByName(merged)


def fits_hash_build(cells: DataFrame, buckets: int) -> bool:
    """True when ``cells`` (measured: rows and text bytes, one aggregate) spread
    over ``buckets`` tasks stay under ``keystat.merge.hashBuildBytesPerTask``
    per task, small enough to hash in memory."""
    budget = int(cells.sparkSession.conf.get(HASH_BUILD_CONF, str(DEFAULT_HASH_BUILD_BYTES)))
    return key_set_bytes(cells, CELL_COLUMNS) <= budget * max(buckets, 1)


def merge_aligned(base: DataFrame, delta: DataFrame, *, unique: bool = False,
                  buckets: int | None = None, hash_build: bool | None = None) -> DataFrame:
    """Upsert as a full outer join on the cell identity, for a ``base`` read
    as a table bucketed by that identity
    (:func:`keystat.sources.cell_store.bucketed_cells`).

    The join keys equal the bucket columns, so the planner keeps the base's
    bucketed scan unshuffled and hash-shuffles only the delta into the same
    buckets; the build side of each task's hash join is the delta bucket.
    Every output task holds one bucket, so the result can be written
    bucket-aligned without another shuffle. Newest version wins, the delta
    wins equal versions. ``unique=True`` states that the delta already holds
    one row per cell (a build's cells, resolved update batches), which saves
    resolving it with a shuffle of its own.

    Each task joins one bucket: a shuffled hash join built on the delta's
    bucket when ``hash_build`` (or, given ``buckets``, when the measured delta
    per bucket fits :func:`fits_hash_build`), else a sort-merge join, which
    sorts the base bucket locally and spills as needed.
    """
    d = delta.select(*CELL_COLUMNS)
    if not unique:
        d = newest_cells(d)
    if hash_build is None:
        hash_build = bool(buckets) and fits_hash_build(d, buckets)
    # A delta holding one family would let the optimizer fold the family key
    # into a filter and join on two keys, losing the bucket alignment.
    d = d.select("row_key", F.when(F.col("row_key").isNotNull(), F.col("family")).alias("family"),
                 "qualifier", F.col("value").alias("_d_value"), F.col("version").alias("_d_version"),
                 F.lit(True).alias("_d"))
    b = base.select(*CELL_KEY, F.col("value").alias("_b_value"),
                    F.col("version").alias("_b_version"), F.lit(True).alias("_b"))
    j = b.join(d.hint("shuffle_hash") if hash_build else d, CELL_KEY, "full_outer")

    def side(present: str, value: str, version: str, rank: int):
        v = F.col(version)
        return F.when(F.col(present), F.struct(version_key(v).alias("r"), v.alias("version"),
                                               F.lit(rank).alias("p"), F.col(value).alias("value")))

    w = F.greatest(side("_b", "_b_value", "_b_version", 0), side("_d", "_d_value", "_d_version", 1))
    return j.select(*CELL_KEY, w["value"].alias("value"), w["version"].alias("version"))


def upsert_cells(base: DataFrame, delta: DataFrame, *, strategy: str = "shuffle") -> DataFrame:
    """Merge ``delta`` into ``base``: cells absent from ``delta`` stay,
    the rest resolve newest-version-wins, the delta winning equal versions.
    One pass over each side and one shuffle; ``strategy`` as for :func:`merge_cells`
    (measuring first pays where the base is far larger than a small, stored delta)."""
    return merge_cells(base, delta.withColumn("_delta", F.lit(1)), "_delta", strategy=strategy)


def family_cells(cells: DataFrame, family: str) -> DataFrame:
    return cells.where(F.col("family") == family)


def rating_cells(cells: DataFrame) -> DataFrame:
    """Decoded rating cells: ``(movie_id, user_id, rating float, ts)``.
    The rating is the text before the first ``|`` (parsed like ``new Float``)."""
    r = family_cells(cells, RATING)
    return r.select(F.col("row_key").alias("movie_id"), F.col("qualifier").alias("user_id"),
                    F.split_part("value", F.lit("|"), F.lit(1)).cast("float").alias("rating"),
                    F.split_part("value", F.lit("|"), F.lit(2)).alias("ts"))


def movie_summary(cells: DataFrame) -> DataFrame:
    """One row per movie out of its cells: title, genres, number of tag cells
    (= distinct tagging users), and the sum and count of its ratings.

    The numbers are a hash aggregate over all cells (numeric buffers, no
    sort); only the info family, about two cells per movie, goes through
    the string aggregate for title and genres. The two one-row-per-movie
    results are joined on the movie id; both are already partitioned by it.
    """
    fam, qual = F.col("family"), F.col("qualifier")
    rating = F.when(fam == RATING, F.split_part("value", F.lit("|"), F.lit(1)).cast("float").cast("double"))
    nums = (cells.groupBy(F.col("row_key").alias("movie_id"))
            .agg(F.count(F.when(fam == TAG, 1)).alias("num_tags"),
                 F.sum(rating).alias("rating_sum"),
                 F.count(rating).alias("rating_cnt")))
    info = (cells.where(fam == INFO).groupBy(F.col("row_key").alias("movie_id"))
            .agg(F.max(F.when(qual == TITLE, F.col("value"))).alias("title"),
                 F.max(F.when(qual == GENRES, F.col("value"))).alias("genres")))
    return nums.join(info, "movie_id", "left").select(
        "movie_id", "title", "genres", "num_tags", "rating_sum", "rating_cnt")
