"""From pages to messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.names import sanitise_name
from tabloom.functions.text import clean_value
from tabloom.operators.envelope import build_record, encode_row, key_order, schema_json
from tabloom.operators.extract import data_cells, data_rows, judge_pages
from tabloom.operators.infer import infer_types, name_columns, table_schemas

# Default class and name of the wanted table.
CSS_CLASS = "wikitable"
TABLE_NAME = "html_data"


def place_by_page(tables: DataFrame) -> DataFrame:
    """The one shuffle of extracted tables. What follows is grouped by page and needs no other."""
    return tables.repartition("page_key")


def tied(placed: DataFrame) -> DataFrame:
    """Placed tables with ``n_rows``, whose rows depend on all columns of the exchange: branches
    that read them are pruned alike, so Spark runs the exchange and the extraction below it once."""
    whole = F.col("reason").isNull() & (F.xxhash64("page_id") >= -(1 << 63))
    return placed.withColumn("rows", F.when(whole, F.col("rows"))).withColumn("n_rows", F.size("rows"))


def infer_schemas(tables: DataFrame) -> DataFrame:
    """``page_key, page_id, n_rows, columns`` of placed tables; each page's table has its own schema."""
    whole = tied(tables)
    types = infer_types(data_cells(data_rows(whole, keep_empty=True)), ["page_key", "col_idx"])
    names = name_columns(whole, ["page_key", "page_id", "n_rows"])
    return table_schemas(names, types, ["page_key"], F.first("page_id").alias("page_id"), F.max("n_rows").alias("n_rows"))


def judged_rows(tables: DataFrame, table_name: Column | str = TABLE_NAME) -> DataFrame:
    """``page_id, page_key, row_idx, schema, schema_text, keys, cells, reason``: every data row,
    and one row with a ``reason`` for every page without any.

    Tables are shuffled once, by page. Types, names and rows all read the same
    columns of that one exchange, so Spark runs the extraction below it once.
    """
    name = F.lit(table_name) if isinstance(table_name, str) else table_name
    whole = tied(place_by_page(tables))
    types = infer_types(data_cells(data_rows(whole, keep_empty=True)), ["page_key", "col_idx"])
    names = name_columns(whole, ["page_key", "n_rows"])
    schema = F.struct(sanitise_name(name).alias("table_name"), F.col("columns").alias("columns"))
    described = table_schemas(names, types, ["page_key"], F.max("n_rows").alias("n_rows")).filter("n_rows > 0")
    described = described.select("page_key", schema.alias("schema")).withColumns(
        {"schema_text": schema_json(F.col("schema")), "keys": key_order(F.col("schema.columns.name"))}
    )
    joined = whole.join(described, "page_key", "left")
    rows = data_rows(joined, "schema", "schema_text", "keys", "reason", keep_empty=True)
    return rows.withColumn("reason", F.when(F.col("row_idx").isNull(), F.coalesce("reason", F.lit("no_data"))))


def rows_with_schema(tables: DataFrame, table_name: Column | str = TABLE_NAME) -> DataFrame:
    """``page_id, row_idx, schema, schema_text, keys, cells`` for every data row."""
    return judged_rows(tables, table_name).filter(F.col("row_idx").isNotNull())


def records_with_schema(tables: DataFrame, table_name: Column | str = TABLE_NAME) -> DataFrame:
    """``page_id, row_idx, schema, record`` for every data row."""
    rows = rows_with_schema(tables, table_name)
    record = build_record(F.col("schema.columns.name"), F.col("cells"))
    return rows.select("page_id", "row_idx", "schema", record.alias("record"))


def messages_and_rejects(
    pages: DataFrame, table_name: Column | str = TABLE_NAME, css_class: str | None = CSS_CLASS, table_index: int = 0, **limits: int | None
) -> DataFrame:
    """``page_id, row_idx, value, reason``: a JSON message per data row, and for every page that
    gives none a row with the ``reason``. One parse and one shuffle make both."""
    rows = judged_rows(judge_pages(pages, css_class, table_index, **limits), table_name)
    cleaned = rows.withColumn("cells", F.transform("cells", clean_value))
    value = F.when(F.col("reason").isNull(), encode_row(F.col("schema_text"), F.col("keys"), F.col("cells")))
    return cleaned.select("page_id", "row_idx", value.alias("value"), "reason")


def build_messages(
    pages: DataFrame, table_name: Column | str = TABLE_NAME, css_class: str | None = CSS_CLASS, table_index: int = 0, **limits: int | None
) -> DataFrame:
    """Pages to ``(page_id, row_idx, value)``, one JSON message per data row."""
    both = messages_and_rejects(pages, table_name, css_class, table_index, **limits)
    return both.filter(F.col("row_idx").isNotNull()).drop("reason")
