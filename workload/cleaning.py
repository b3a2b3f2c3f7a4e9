"""Cleaning, naming and type tests, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.functions import literals, names, text
from workload.base import (
    LINEITEM_VALUES, Tables, choose, lineitem_values, query, sql_clean, sql_date, sql_footnotes, sql_int, sql_is_float,
    sql_name, sql_null_tokens, sql_number_text, sql_strip, sql_timestamp, sql_trim,
)

_NOTED = "text || '[note ' || CAST(doc_id AS STRING) || '] tail[' || lang || '][]' || '[open'"
_SPACED = "'   ' || text || ' 　' || chr(9) || chr(10) || ' '"
_TOKEN = choose("l_partkey % 13", ["—", "–", "-", "N/A", "n/a", "NA", "?", "Na", "--", "??", ""], "l_returnflag")
_NOISY = (
    "CASE l_linenumber WHEN 1 THEN ' ' || value || '[1]' WHEN 2 THEN '[a][b]' || value || ' ' "
    "WHEN 3 THEN '—[c] ' WHEN 4 THEN '[x]?[y]' ELSE value END"
)


@query(
    "strip_footnotes",
    f"SELECT doc_id, md5(s) AS digest, CAST(length(s) AS BIGINT) AS n FROM (SELECT doc_id, {sql_footnotes(_NOTED)} AS s FROM documents)",
)
def strip_footnotes(t: Tables) -> DataFrame:
    out = text.strip_footnotes(F.expr(_NOTED))
    return t.documents.select("doc_id", out.alias("s")).select(
        "doc_id", F.md5("s").alias("digest"), F.length("s").cast("bigint").alias("n")
    )


@query(
    "unicode_trim",
    f"SELECT doc_id, md5(s) AS digest, CAST(length(s) AS BIGINT) AS n FROM (SELECT doc_id, {sql_trim(_SPACED)} AS s FROM documents)",
)
def unicode_trim(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.unicode_trim(F.expr(_SPACED)).alias("s")).select(
        "doc_id", F.md5("s").alias("digest"), F.length("s").cast("bigint").alias("n")
    )


@query(
    "null_tokens",
    f"SELECT l_orderkey, l_linenumber, {sql_null_tokens('v')} AS value FROM (SELECT *, {_TOKEN} AS v FROM lineitem)",
)
def null_tokens(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", text.null_tokens(F.expr(_TOKEN)).alias("value"))


@query(
    "clean_value",
    f"SELECT l_orderkey, l_linenumber, {sql_clean('v')} AS value FROM (SELECT *, {_NOISY} AS v FROM {LINEITEM_VALUES})",
)
def clean_value(t: Tables) -> DataFrame:
    return lineitem_values(t).select("l_orderkey", "l_linenumber", text.clean_value(F.expr(_NOISY)).alias("value"))


@query(
    "strip_decorations",
    f"SELECT l_orderkey, l_linenumber, {sql_strip('value')} AS value FROM {LINEITEM_VALUES}",
)
def strip_decorations(t: Tables) -> DataFrame:
    return lineitem_values(t).withColumn("value", text.strip_decorations(F.col("value")))


@query(
    "parse_decorated_number",
    f"SELECT l_orderkey, l_linenumber, value, n AS digits, {sql_int('n')} AS whole "
    f"FROM (SELECT *, {sql_number_text('value')} AS n FROM {LINEITEM_VALUES})",
)
def parse_decorated_number(t: Tables) -> DataFrame:
    v = F.col("value")
    return lineitem_values(t).withColumns({"digits": text.number_text(v), "whole": literals.parse_int(v)})


@query("empty_to_null", "SELECT doc_id, nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END, '') AS value FROM documents")
def empty_to_null(t: Tables) -> DataFrame:
    some = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("text"))
    return t.documents.select("doc_id", text.empty_to_null(some).alias("value"))


_HEADER = (
    "CASE p_partkey % 11 WHEN 0 THEN '% ' || p_name WHEN 1 THEN '$ ' || p_name || '[' || CAST(p_size AS STRING) || ']' "
    "WHEN 2 THEN '' WHEN 3 THEN '—' WHEN 4 THEN 'Rank[1]' WHEN 5 THEN 'ORDER' WHEN 6 THEN p_brand || ' / ' || p_type "
    "WHEN 7 THEN 'Länge_' || p_name || ' (mm)' WHEN 8 THEN p_name || p_name || p_name || p_name || p_name || p_name || p_name "
    "WHEN 9 THEN p_type ELSE CAST(p_partkey AS STRING) || '__' || p_name END"
)


@query("sanitise_names", f"SELECT p_partkey, h AS header, {sql_name('h')} AS name FROM (SELECT p_partkey, {_HEADER} AS h FROM part)")
def sanitise_names(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.expr(_HEADER).alias("header")).withColumn(
        "name", names.sanitise_name(F.col("header"))
    )


_WORD = choose("p_partkey % 7", ["rank", "index", "order", "key", "group", "Rank"], "lower(p_type)")


@query(
    "reserved_names",
    f"SELECT p_partkey, CASE WHEN w IN ('rank','index','order','key','group') THEN w || '_' ELSE w END AS name "
    f"FROM (SELECT p_partkey, {_WORD} AS w FROM part)",
)
def reserved_names(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", names.escape_reserved(F.expr(_WORD)).alias("name"))


@query(
    "dedupe_names",
    "SELECT tbl, pos, CASE WHEN k = 1 THEN base ELSE base || '_' || k END AS name FROM (SELECT *, row_number() OVER "
    "(PARTITION BY tbl, base ORDER BY pos) AS k FROM (SELECT p_partkey // 40 AS tbl, p_partkey % 40 AS pos, "
    "lower(p_type) AS base FROM part))",
)
def dedupe_names(t: Tables) -> DataFrame:
    headers = t.part.select(
        F.expr("p_partkey div 40").alias("tbl"), F.expr("p_partkey % 40").alias("pos"), F.lower("p_type").alias("base")
    )
    return names.dedupe_names(headers, ["tbl"], "base", "pos").select("tbl", "pos", "name")


@query(
    "classify_int",
    f"SELECT l_orderkey, l_linenumber, value, ({sql_int('n')}) IS NOT NULL AS is_int "
    f"FROM (SELECT *, {sql_number_text('value')} AS n FROM {LINEITEM_VALUES})",
)
def classify_int(t: Tables) -> DataFrame:
    return lineitem_values(t).withColumn("is_int", literals.is_int(F.col("value")))


@query(
    "classify_float",
    f"SELECT l_orderkey, l_linenumber, value, {sql_is_float('n')} AS is_float "
    f"FROM (SELECT *, {sql_number_text('value')} AS n FROM {LINEITEM_VALUES})",
)
def classify_float(t: Tables) -> DataFrame:
    return lineitem_values(t).withColumn("is_float", literals.is_float(F.col("value")))


@query(
    "classify_timestamp",
    f"SELECT l_orderkey, l_linenumber, value, strftime({sql_timestamp('value')}, '%Y-%m-%d %H:%M:%S.%f') AS utc FROM {LINEITEM_VALUES}",
)
def classify_timestamp(t: Tables) -> DataFrame:
    utc = F.date_format(literals.parse_timestamp(F.col("value")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return lineitem_values(t).withColumn("utc", utc)


@query("classify_date", f"SELECT l_orderkey, l_linenumber, value, {sql_date('value')} AS day FROM {LINEITEM_VALUES}")
def classify_date(t: Tables) -> DataFrame:
    return lineitem_values(t).withColumn("day", literals.parse_date(F.col("value")))


@query("classify_long_text", "SELECT doc_id, strlen(text) > 512 AS is_long FROM documents")
def classify_long_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", literals.is_long_text(F.col("text")).alias("is_long"))
