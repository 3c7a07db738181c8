"""A corpus pipeline of the document operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All but
the last return the columns of ``documents``. ``run`` applies them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from usagelens.llm import mixing, neardup, packing, quality, secret_scan
from usagelens.llm.common import stage, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word runs, 0.8) stays."""
    return neardup.deduplicate(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are taken out of the texts; every document stays."""
    return secret_scan.redact(docs, secret_scan.train(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document appears as often as its source's target draws it (up to twice);
    the copy that a target cuts keeps its first words."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Hashes, a trained model, random draws and a tokenizer: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
