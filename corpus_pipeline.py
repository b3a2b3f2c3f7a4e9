"""From raw documents to packed training sequences.

Each stage reads what the one before wrote. Quality drops documents, the n-gram join keeps
one document of every group of near copies, decontamination drops documents that hold
benchmark passages, the secret scan replaces secrets in the texts, packing cuts what is
left into sequences. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm.common import stored
from tabloom.llm.decontaminate import drop_leaks
from tabloom.llm.ngram_join import one_of_each
from tabloom.llm.packing import pack_documents
from tabloom.llm.quality import TOP_GRADE, fit_to_labels, keep_documents
from tabloom.llm.queries import table
from tabloom.llm.secrets import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_documents(docs, fit_to_labels(docs, table(spark, sf_dir, "labels")), tail=TOP_GRADE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8."""
    return one_of_each(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("packing", packing),
]

# Fitted weights, token ids and packing have no SQL form; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
