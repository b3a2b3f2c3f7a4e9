"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm.collocations import mine_collocations
from tabloom.llm.decontaminate import report_leaks
from tabloom.llm.fill_middle import rearrange_and_restore
from tabloom.llm.fingerprints import fingerprint_documents
from tabloom.llm.language import identify_held_out
from tabloom.llm.licences import scan_licences
from tabloom.llm.ngram_join import join_documents
from tabloom.llm.oracles import COLLOCATIONS, FILL_MIDDLE, URL_FILTERS
from tabloom.llm.packing import pack_documents
from tabloom.llm.quality import TOP_GRADE, fit_to_labels, grade_documents
from tabloom.llm.secrets import report_secrets
from tabloom.llm.substring_dedup import remove_repeats
from tabloom.llm.token_files import encode_and_read_back
from tabloom.llm.url_filters import judge_pages
from tabloom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op11_fill_middle": FILL_MIDDLE,
    "op12_collocations": COLLOCATIONS,
    "op13_url_filters": URL_FILTERS,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Tasks read texts in batches of rows; smaller ones keep Python workers small.
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))  # Spark's default
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


@query
def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_held_out(table(spark, sf_dir, "documents"))


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(table(spark, sf_dir, "documents"))


@query
def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit_to_labels(documents, table(spark, sf_dir, "labels"))
    return grade_documents(documents, model, tail=TOP_GRADE)


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_secrets(table(spark, sf_dir, "documents"))


@query
def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_read_back(table(spark, sf_dir, "documents"))


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


@query
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rearrange_and_restore(table(spark, sf_dir, "documents"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents"))


@query
def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(table(spark, sf_dir, "pages"))
