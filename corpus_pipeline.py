"""The corpus pipeline: five stages over ``documents``, one operator each.

``language_id`` drops documents that the classifier rejects, ``near_dedup``
keeps one document of each group of near copies, ``decontaminate`` drops documents that hold
benchmark passages, ``secret_scan`` replaces secrets by a mark, and ``sentencepiece``
turns texts into piece ids. All but the last return the columns of their input,
whatever other columns it has; null and empty texts are rejected by the first
(they have no letter); an empty table passes through. Each stage's rows are written
before the next reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystat.llm import language_id as languages
from keystat.llm import pieces
from keystat.llm.common import hand_back, materialise, set_aside, ship_package, table
from keystat.llm.decontaminate import decontaminate as drop_contaminated
from keystat.llm.near_dup import drop_near_duplicates
from keystat.llm.secrets import redact, scan_secrets


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with the calibrated certainty. Learns from
    labelled rows as the registered query does."""
    ship_package(spark)
    model = languages.train(docs.where(languages.remainder(F.col("doc_id"), 3) != 1))
    hand_back()  # what the driver fitted with
    renamed, back = set_aside(docs, ("lang_pred", "score", "accepted"))
    return back(languages.identify(renamed, model).where("accepted"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies (a similarity of 0.8 or more)."""
    ship_package(spark)
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark, and ``n_chars`` follows; the documents stay."""
    renamed, back = set_aside(docs, ("base_spans", "secret_spans"))
    clean = scan_secrets(renamed).withColumn("text", redact())
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return back(clean)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_pieces, pieces, scores, round_trip): the best segmentation of each
    text, the scores of the ``pieces.NBEST`` best, and whether decoding each gives the text back."""
    ship_package(spark)
    encoded = pieces.segment(docs.select("doc_id", "lang", "source", "text"), check=True)
    found = F.col("segmentations")
    best = F.coalesce(F.get(found, F.lit(0))["ids"], F.array().cast("array<int>"))
    return encoded.select("doc_id", "lang", "source", F.size(best).cast("long").alias("n_pieces"),
                          best.alias("pieces"), found["score"].alias("scores"), "round_trip")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("sentencepiece", sentencepiece),
]

#: The first stage learns its model and the last needs the tokenizer's, which SQL
#: can't express; tests hold run() against a brute-force version.
ORACLE_SQL = None


#: Row groups between stages; a writing task holds one in memory.
ROW_GROUP_BYTES = 16 << 20


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name, row_group_bytes=ROW_GROUP_BYTES)
    return STAGES[-1][1](spark, docs, sf_dir)
