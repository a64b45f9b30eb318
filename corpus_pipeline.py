"""A training corpus from raw documents: filter, deduplicate, mix, pack.

Each stage works on all that its predecessor kept; stages are written as Parquet and read back in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import exact_dedup, mixing, near_copies, packing, toxicity
from tidemart.llm.work import staged, table


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents below their language's threshold; all labels of these documents train the classifier and its thresholds."""
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    return toxicity.clean_documents(docs, toxicity.fit(docs, labels, crossed=True))


def without_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.kept_documents(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of near copies: five-word shingles, four in five alike."""
    return near_copies.one_per_group(docs)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Whole documents, each as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Where each piece of each document goes: bin, place and span."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# the classifier, the forests of near copies and the packing can't be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, folder), f"stage-{name}")
    return STAGES[-1][1](spark, docs, folder)
