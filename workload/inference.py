"""Column types, schemas and DDL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.operators import ddl, infer
from tabloom.operators.extract import extract_tables
from tabloom.plans.growing import absorb_pages
from tabloom.plans.publish import infer_schemas, place_by_page
from tabloom.functions.text import clean_value
from tabloom.session import work_dir
from workload import fixtures
from workload.base import Tables, query, sql_fold, sql_kinds
from workload.fixtures import ORDER_COLUMNS

LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_STRINGS = ", ".join(f"CAST({c} AS STRING)" for c in LINEITEM_COLUMNS)


def lineitem_cells(t: Tables) -> DataFrame:
    """lineitem in long form: one cleaned text per cell, a table per supplier."""
    cells = F.expr(f"posexplode(array({_STRINGS}))")
    return t.lineitem.select("l_suppkey", "l_orderkey", cells.alias("col_idx", "value")).withColumn(
        "value", clean_value(F.col("value"))
    )


_LINEITEM_CELLS = (
    f"(SELECT l_suppkey, l_orderkey, unnest([{_STRINGS}]) AS value, unnest(range({len(LINEITEM_COLUMNS)})) AS col_idx FROM lineitem)"
)


@query(
    "infer_types",
    f"SELECT l_suppkey, CAST(col_idx AS INT) AS col_idx, {sql_fold('l_orderkey')} AS type "
    f"FROM {sql_kinds(_LINEITEM_CELLS, 'l_suppkey, l_orderkey, col_idx')} GROUP BY 1, 2",
)
def infer_types(t: Tables) -> DataFrame:
    # Within a column of lineitem all values are of one kind, so ties in l_orderkey do not matter.
    return infer.infer_types(lineitem_cells(t), ["l_suppkey", "col_idx"], "l_orderkey")


# Customers see kinds come and go in all orders; many columns never turn into text.
_ORDER_VALUE = """CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 11 = 0 THEN repeat('long text ', 60)
  WHEN o_custkey % 3 = 0 AND o_orderkey % 7 = 0 THEN 'short'
  WHEN o_orderkey < 1000 + o_custkey * 20 THEN CASE o_orderkey % 4 WHEN 0 THEN '1.5%' WHEN 1 THEN '—' ELSE '$1,234' END
  WHEN o_orderkey < 2500 + o_custkey * 40 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:00:00'
  WHEN o_orderkey % 200 = 3 THEN '7' WHEN o_orderkey % 200 = 4 THEN '2024-05-06T00:00:00Z'
  WHEN o_custkey % 5 = 4 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"""
_ORDER_CELLS = f"(SELECT o_custkey, o_orderpriority, o_orderkey, {_ORDER_VALUE} AS value FROM orders)"


def order_cells(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderpriority", "o_orderkey", F.expr(_ORDER_VALUE).alias("value")).withColumn(
        "value", clean_value(F.col("value"))
    )


@query(
    "infer_order_sensitivity",
    f"SELECT o_custkey, {sql_fold('o_orderkey')} AS type FROM {sql_kinds(_ORDER_CELLS, 'o_custkey, o_orderkey')} GROUP BY 1 "
    f"UNION ALL SELECT o_custkey, 'BIGINT' FROM {_ORDER_CELLS} GROUP BY 1 HAVING bool_and(value IN ('', '—'))",
)
def infer_order_sensitivity(t: Tables) -> DataFrame:
    return infer.infer_types(order_cells(t), ["o_custkey"], "o_orderkey")


_TYPES_ACROSS_PAGES = (
    f"SELECT o_custkey % 10 AS tbl, {sql_fold('o_orderkey')} AS type FROM {sql_kinds(_ORDER_CELLS, 'o_custkey, o_orderkey')} GROUP BY 1"
)


def paged_cells(t: Tables) -> DataFrame:
    return order_cells(t).withColumns(
        {"tbl": F.expr("o_custkey % 10"), "page_id": F.expr("o_orderkey div 100"), "row_idx": F.expr("o_orderkey % 100")}
    )


@query("infer_types_across_pages", _TYPES_ACROSS_PAGES)
def infer_types_across_pages(t: Tables) -> DataFrame:
    return infer.infer_types(paged_cells(t), ["tbl"], "row_idx", "page_id")


@query("infer_incremental", _TYPES_ACROSS_PAGES)
def infer_incremental(t: Tables) -> DataFrame:
    """The same pages in three batches out of their order, the second delivered twice; each reads its own pages only."""
    path = work_dir(t.spark, "facts")
    for batch in (0, 1, 1, 2):
        types = absorb_pages(paged_cells(t).filter(F.col("page_id") % 3 == 2 - batch), path, batch, ["tbl"], "row_idx", "page_id")
    return types


_COLUMN_VALUES = ", ".join(f"({i}, '{n}', '{d}')" for i, (n, d) in enumerate(ORDER_COLUMNS))


@query(
    "infer_schema",
    f"SELECT page_id, c.pos, c.name, c.type FROM (SELECT DISTINCT o_orderkey // 100 AS page_id FROM orders), "
    f"(VALUES {_COLUMN_VALUES}) c(pos, name, type)",
)
def infer_schema(t: Tables) -> DataFrame:
    schemas = infer_schemas(place_by_page(extract_tables(fixtures.orders_pages(t), "wikitable")))
    return schemas.select("page_id", F.posexplode("columns").alias("pos", "c")).select("page_id", "pos", "c.name", "c.type")


_MIXED = {"BIGINT": "p_size", "DOUBLE": "format_number(p_retailprice, 2)", "VARCHAR(512)": "p_brand", "DATE": "concat('2024-01-', 10 + p_size % 20)"}


@query(
    "infer_schema_by_page",
    "SELECT page_id, v.pos, CASE v.pos WHEN 0 THEN 'first' ELSE 'second' END AS name, CASE (page_id + v.pos) % 4 "
    + " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(_MIXED))
    + " END AS type FROM (SELECT DISTINCT p_partkey // 50 AS page_id FROM part), (VALUES (0), (1)) v(pos)",
)
def infer_schema_by_page(t: Tables) -> DataFrame:
    """Two columns whose types change from page to page."""
    page = "(p_partkey div 50)"
    cell = lambda pos: f"CASE ({page} + {pos}) % 4 " + " ".join(f"WHEN {i} THEN CAST({x} AS STRING)" for i, x in enumerate(_MIXED.values())) + " END"
    row = f"concat('<tr><td>', {cell(0)}, '<td>', {cell(1)})"
    pages = fixtures.render(t.part, page, ["p_partkey"], row, "'<table><tr><th>First<th>Second'", "'</table>'")
    schemas = infer_schemas(place_by_page(extract_tables(pages)))
    return schemas.select("page_id", F.posexplode("columns").alias("pos", "c")).select("page_id", "pos", "c.name", "c.type")


def _ddl(t: Tables, dialect: str) -> DataFrame:
    schemas = infer_schemas(place_by_page(extract_tables(fixtures.orders_pages(t), "wikitable")))
    name = F.concat(F.lit("orders_"), F.col("page_id").cast("string"))
    return schemas.select("page_id", ddl.create_table_sql(name, F.col("columns"), dialect).alias("ddl"))


def _ddl_oracle(quote: str, id_type: str, double: str) -> str:
    def q(x: str) -> str:
        return f"{quote}{x}{quote}"

    lines = [f"{q('_id')} {id_type}", f"{q('_row_hash')} VARCHAR(64) NOT NULL UNIQUE"]
    lines += [f"{q(n)} {double if d == 'DOUBLE' else d}" for n, d in ORDER_COLUMNS]
    body = ",\n  ".join(lines)
    return (
        f"SELECT page_id, 'CREATE TABLE IF NOT EXISTS {quote}orders_' || page_id || '{quote} (\n  {body}\n)' AS ddl "
        "FROM (SELECT DISTINCT o_orderkey // 100 AS page_id FROM orders)"
    )


@query("render_ddl_mysql", _ddl_oracle("`", "BIGINT AUTO_INCREMENT PRIMARY KEY", "DOUBLE"))
def render_ddl_mysql(t: Tables) -> DataFrame:
    return _ddl(t, "mysql")


@query("render_ddl_postgres", _ddl_oracle('"', "BIGSERIAL PRIMARY KEY", "DOUBLE PRECISION"))
def render_ddl_postgres(t: Tables) -> DataFrame:
    return _ddl(t, "postgres")
