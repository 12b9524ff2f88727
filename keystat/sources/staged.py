"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from keystat.session import checkpoint_dir


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path of this call alone under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: its rows are fixed and
    computed once, its lineage ends there, and a lost executor costs nothing that was written.
    The files stay until that folder is cleaned, as with checkpoints."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
