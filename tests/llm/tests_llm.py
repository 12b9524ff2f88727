"""Helpers of these tests (apart from conftest, whose name the tests above use)."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


def frame(spark, texts, ids=None, lang="en"):
    """A documents table of the texts."""
    ids = ids or range(1, len(texts) + 1)
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def llm_spark(spark):
    from keystat.llm.common import ship_package
    ship_package(spark)
    return spark
