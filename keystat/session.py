"""Session defaults for keystat jobs.

Library functions never create a session: they take DataFrames. Jobs and
tests call :func:`get_session`, which only applies defaults when it is the
one creating the session, so settings a cluster already made (shuffle
partitions, checkpoint dir, memory) are left alone.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Defaults for a fresh session. AQE re-plans joins and partition counts from
# runtime sizes; skew-join splitting handles a hot key on the big side of a
# sort-merge join (e.g. one movie holding a third of all ratings).
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "keystat",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:  # someone else's: only what the caller names is set
        for key, value in (extra or {}).items():
            active.conf.set(key, value)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = SparkConf()  # spark-defaults and --conf
    conf = {k: v for k, v in SESSION_DEFAULTS.items() if not given.contains(k)}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this must already be set (to a shared file system). Only
    when it is unset, as in local tests, a scratch folder is created.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="keystat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()
