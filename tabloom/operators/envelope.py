"""The message envelope: a record together with the schema it follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.canonical import json_string
from tabloom.functions.text import clean_value, empty_to_null
from tabloom.operators.once import built_once, evaluate_once

SCHEMA_DDL = "struct<table_name string, columns array<struct<name string, type string>>>"
# Columns that stored tables have of their own.
RESERVED_COLUMNS = ["_id", "_row_hash", "_table", "_batch"]
# A table's name is part of a folder name, percent-encoded.
MAX_TABLE_NAME_BYTES = 200
_LOOSE_SCHEMA_DDL = "struct<table_name variant, columns array<struct<name variant, type variant>>>"


def build_record(names: Column, cells: Column) -> Column:
    """Column name -> cleaned text, for every column of the table."""
    return F.map_from_arrays(names, F.transform(cells, clean_value))


def schema_json(schema: Column) -> Column:
    """The schema part of a message; compute it once per table, not per row."""
    columns = F.transform(
        schema["columns"],
        lambda c: F.concat(F.lit('{"name":'), json_string(c["name"]), F.lit(',"type":'), json_string(c["type"]), F.lit("}")),
    )
    return F.concat(
        F.lit('{"table_name":'), json_string(schema["table_name"]), F.lit(',"columns":['),
        F.array_join(columns, ","), F.lit("]}"),
    )


def key_order(names: Column) -> Column:
    """Record keys as JSON text with their column number, in byte order; once per table."""
    listed = F.array_sort(F.transform(names, lambda n, i: F.struct(n.alias("name"), i.alias("pos"))))
    return F.transform(
        listed, lambda k: F.struct(F.concat(json_string(k["name"]), F.lit(":")).alias("text"), k["pos"].alias("pos"))
    )


def encode_row(schema_text: Column, keys: Column, values: Column) -> Column:
    """The message text from cleaned cells: schema first, record keys in byte order."""
    pairs = F.transform(keys, lambda k: F.concat(k["text"], json_string(F.get(values, k["pos"]))))
    return F.concat(F.lit('{"schema":'), schema_text, F.lit(',"record":{'), F.array_join(pairs, ","), F.lit("}}"))


def _is_text(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def decode_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``schema``, ``record`` and ``reason``; ``reason`` is NULL for well-formed messages.

    The text is parsed as ``[value, check]`` with a check number derived from the
    text itself, because a JSON reader stops after the first value: only if the
    second element is that number did the message hold one value and nothing else.
    A JSON null in a record counts as empty text.
    """
    parsed, opened, reason, decoded = _decoding(value)
    whole = messages.withColumn("_v", parsed["_v"]).withColumn("_v", parsed["checked"])
    judged = whole.withColumns(opened).withColumn("reason", reason)
    return evaluate_once(judged, decoded).drop("_v", "_schema", "_record")


@built_once
def _decoding(value: str) -> tuple[dict[str, Column], dict[str, Column], Column, dict[str, Column]]:
    raw = F.col(value)
    check = F.xxhash64(raw)
    parsed = {
        "_v": F.try_parse_json(F.concat(F.lit("["), raw, F.lit(","), check.cast("string"), F.lit("]"))),
        "checked": F.when(F.try_variant_get("_v", "$[1]", "bigint") == check, F.col("_v")),
    }
    opened = {
        "_schema": F.try_variant_get("_v", "$[0].schema", _LOOSE_SCHEMA_DDL),
        "_record": F.try_variant_get("_v", "$[0].record", "map<string,variant>"),
    }
    text_columns = F.forall(
        "_schema.columns", lambda c: F.coalesce(_is_text(c["name"]) & _is_text(c["type"]), F.lit(False))
    )
    given = F.transform("_schema.columns", lambda c: F.lower(F.try_variant_get(c["name"], "$", "string")))
    distinct_columns = (F.size(F.array_distinct(given)) == F.size(given)) & ~F.exists(
        given, lambda n: n.isin("", *RESERVED_COLUMNS)
    )
    table = F.try_variant_get("_schema.table_name", "$", "string")
    usable = (F.trim(table) != "") & (F.octet_length(F.url_encode(table)) <= MAX_TABLE_NAME_BYTES) & (table != "__HIVE_DEFAULT_PARTITION__")
    named = F.coalesce(_is_text(F.col("_schema.table_name")), F.lit(False))
    reason = (
        F.when(F.col("_v").isNull(), F.lit("not_json"))
        .when(~named, F.lit("no_table_name"))
        .when(~F.coalesce(usable, F.lit(False)), F.lit("bad_table_name"))
        .when(~F.coalesce(text_columns & distinct_columns & (F.size("_schema.columns") > 0), F.lit(False)), F.lit("bad_schema"))
        .when(F.col("_record").isNull(), F.lit("no_record"))
        .when(
            F.exists(F.map_values("_record"), lambda v: ~F.coalesce(F.schema_of_variant(v), F.lit("VOID")).isin("STRING", "VOID")),
            F.lit("non_string_value"),
        )
    )
    ok = F.col("reason").isNull()
    record = F.transform_values("_record", lambda k, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("")))
    decoded = {
        "reason": F.col("reason"),
        "schema": F.when(ok, F.try_variant_get("_v", "$[0].schema", SCHEMA_DDL)),
        "record": F.when(ok, record),
    }
    return parsed, opened, reason, decoded


def malformed(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNotNull())


def well_formed(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNull()).drop("reason")


def project_by_schema(record: Column, columns: Column) -> Column:
    """The values in schema order: missing keys and empty text are NULL, extra keys are dropped."""
    return F.transform(columns, lambda c: empty_to_null(F.try_element_at(record, c["name"])))


def group_statistics(decoded: DataFrame) -> DataFrame:
    """Messages per destination table."""
    return decoded.groupBy(F.col("schema.table_name").alias("table_name")).agg(F.count(F.lit(1)).alias("n_messages"))


def first_schemas(decoded: DataFrame) -> DataFrame:
    """``table_name, columns, position, n_schemas``: the schema of each table's earliest message.

    The first step keeps one number per (table, schema, partition) and combines
    before the shuffle; the second compares those few rows.
    """
    earliest = decoded.groupBy(
        F.col("schema.table_name").alias("table_name"), F.col("schema.columns").alias("columns"), F.col("partition")
    ).agg(F.min("offset").alias("offset"))
    return earliest.groupBy("table_name").agg(
        F.min_by("columns", F.struct("partition", "offset")).alias("columns"),
        F.min(F.struct("partition", "offset")).alias("position"),
        F.count_distinct("columns").alias("n_schemas"),
    )
