"""Page scans and table extraction, checked against the tables the pages are rendered from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.operators import extract
from tabloom.sources.pages import scan_pages
from workload import fixtures
from workload.base import Tables, choose, query


@query("page_scan", "SELECT page_id, url, strlen(html) AS n_bytes FROM pages")
def page_scan(t: Tables) -> DataFrame:
    pages = scan_pages(t.spark, f"{t.sf_dir}/pages.parquet")
    return pages.select("page_id", "url", F.octet_length("html").cast("bigint").alias("n_bytes"))


@query("page_size_cap", "SELECT page_id, CASE WHEN strlen(url) > 24 THEN url[1:24] ELSE url END AS body, strlen(html) > 4000 AS is_cut FROM pages")
def page_size_cap(t: Tables) -> DataFrame:
    cut = extract.cap_body(F.col("html"), 4000) != F.col("html")
    return t.pages.select("page_id", extract.cap_body(F.col("url"), 24).alias("body"), cut.alias("is_cut"))


_SUPPLIER_PAGE = "SELECT DISTINCT s_suppkey // 10 AS page_id FROM supplier"


@query("tables_per_page", f"SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 2 ELSE 3 END AS n_tables FROM ({_SUPPLIER_PAGE})")
def tables_per_page(t: Tables) -> DataFrame:
    return extract.parse_pages(fixtures.supplier_pages(t)).select("page_id", F.size("tables").alias("n_tables"))


@query("select_table_by_class", f"SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 0 ELSE 1 END AS table_index FROM ({_SUPPLIER_PAGE})")
def select_table_by_class(t: Tables) -> DataFrame:
    parsed = extract.parse_pages(fixtures.supplier_pages(t))
    return extract.select_table(parsed, "data").select("page_id", "table_index")


@query(
    "select_table_fallback",
    f"SELECT page_id, wanted, CASE WHEN wanted = 1 THEN 1 ELSE 0 END AS table_index "
    f"FROM ({_SUPPLIER_PAGE}), (VALUES (1), (99), (-1)) w(wanted)",
)
def select_table_fallback(t: Tables) -> DataFrame:
    parsed = extract.parse_pages(fixtures.supplier_pages(t))
    one, far, negative = [
        extract.select_table(parsed, "missing", i).select("page_id", F.lit(i).alias("wanted"), "table_index")
        for i in (1, 99, -1)
    ]
    return one.unionByName(far).unionByName(negative)


@query(
    "class_token_match",
    f"SELECT page_id, i AS table_index, i > 0 AND page_id % 3 <> 0 AS has_data FROM ({_SUPPLIER_PAGE}), (VALUES (0), (1), (2)) x(i) "
    "WHERE i < 2 OR page_id % 3 <> 0",
)
def class_token_match(t: Tables) -> DataFrame:
    tables = extract.list_tables(extract.parse_pages(fixtures.supplier_pages(t)))
    return tables.select("page_id", "table_index", extract.has_class(F.col("table_class"), "data").alias("has_data"))


@query(
    "rows_per_table",
    "SELECT page_id, i AS table_index, CASE i WHEN 0 THEN 1 WHEN 1 THEN n + 1 ELSE 2 END AS n_rows FROM "
    "(SELECT s_suppkey // 10 AS page_id, count(*) AS n FROM supplier GROUP BY 1), (VALUES (0), (1), (2)) x(i) "
    "WHERE i < 2 OR page_id % 3 <> 0",
)
def rows_per_table(t: Tables) -> DataFrame:
    tables = extract.list_tables(extract.parse_pages(fixtures.supplier_pages(t)))
    return tables.select("page_id", "table_index", F.size("rows").cast("bigint").alias("n_rows"))


@query(
    "cell_text",
    "SELECT s_suppkey // 10 AS page_id, s_suppkey % 10 + 1 AS row_idx, i AS cell_ord, CASE i WHEN 0 THEN s_name "
    "WHEN 1 THEN 'xn' || s_nationkey || '&y' ELSE CAST(CAST(s_acctbal AS DECIMAL(15,2)) AS VARCHAR) END AS text "
    "FROM supplier, (VALUES (0), (1), (2)) x(i)",
)
def cell_text(t: Tables) -> DataFrame:
    tables = extract.list_tables(extract.parse_pages(fixtures.supplier_pages(t))).filter("table_index = 1")
    cells = extract.physical_cells(tables).filter(~F.col("is_th"))
    return cells.select("page_id", F.col("row_idx").cast("bigint").alias("row_idx"), "cell_ord", "text")


_ATTR = choose(
    "l_partkey % 23",
    ["1", "2", "3px", " 4", "0", "-2", "x", "", "+6", "1001", "70000", "2 3", "5.7", "99999999999999999999", " 7", "+-3",
     "0xFFFFFFFFFFFFFFFFFF", "0777777777777777777777777777777", "0x000000000000000000000000000000001F", "0b" + "1" * 70, "0o" + "0" * 40 + "17"],
    "CAST(l_linenumber AS STRING)",
)


@query(
    "span_attr_parse",
    "SELECT l_orderkey, l_linenumber, attr, n AS span, least(n, 1000) AS colspan FROM (SELECT *, "
    "CASE WHEN attr LIKE '0%1F' THEN 31 WHEN attr LIKE '0o%17' THEN 15 WHEN attr LIKE '0%' THEN 1 ELSE "
    r"coalesce(nullif(greatest(TRY_CAST(regexp_extract(attr, '^[\s\x{a0}]*([+]?\d+)', 1) AS BIGINT), 0), 0), 1) END AS n "
    f"FROM (SELECT l_orderkey, l_linenumber, {_ATTR} AS attr FROM lineitem))",
)
def span_attr_parse(t: Tables) -> DataFrame:
    attr = F.col("attr")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.expr(_ATTR).alias("attr")).withColumns(
        {"span": extract.span_value(attr), "colspan": extract.span_value(attr, extract.MAX_COLSPAN)}
    )


_PART_LINE = (
    "CASE WHEN p_size % 3 = 0 THEN p_name || '|' || p_name ELSE replace(p_name, ' ', '|') END "
    "|| CASE WHEN p_size % 5 = 1 THEN '' ELSE '|' || p_brand || '|' || p_size END "
    "|| CASE WHEN p_size % 7 = 1 THEN '|more|more|more' ELSE '' END"
)


@query(
    "colspan_expand",
    f"SELECT p_partkey // 50 AS page_id, p_partkey % 50 + 1 AS row_idx, {_PART_LINE} AS line FROM part UNION ALL "
    "SELECT DISTINCT p_partkey // 50, 0, 'Name|Name|Brand|Size' FROM part",
)
def colspan_expand(t: Tables) -> DataFrame:
    tables = extract.resolve_runs(extract.select_table(extract.parse_pages(fixtures.part_pages(t))))
    rows = tables.select("page_id", F.posexplode("runs").alias("row_idx", "runs"))
    line = F.array_join(extract.spread_runs(F.col("runs")), "|")
    return rows.select("page_id", F.col("row_idx").cast("bigint").alias("row_idx"), line.alias("line"))


@query(
    "rowspan_expand",
    "SELECT o_orderkey // 100 AS page_id, o_orderstatus AS status, format('{:,}', o_orderkey) AS order_text, "
    "CASE WHEN o_orderkey % 17 = 0 THEN '—' ELSE '$' || format('{:,.2f}', o_totalprice) || '[a]' END AS price, "
    "(o_custkey % 100) || '%' AS percent, strftime(o_orderdate, '%Y-%m-%d') AS placed, strftime(o_orderdate, '%b %-d, %Y') AS shipped, "
    "o_orderpriority AS priority, 'n/a' AS note, 8 AS width FROM orders",
)
def rowspan_expand(t: Tables) -> DataFrame:
    rows = extract.data_rows(extract.extract_tables(fixtures.orders_pages(t), "wikitable"))
    cells = F.col("cells")
    names = ["status", "order_text", "price", "percent", "placed", "shipped", "priority", "note"]
    return rows.select("page_id", *[cells[i].alias(n) for i, n in enumerate(names)], F.size(cells).alias("width"))


@query(
    "dense_rows",
    "SELECT page_id, row_idx, line FROM (SELECT p_partkey // 50 AS page_id, p_partkey % 50 * 3 AS row_idx, "
    "p_name || '|' || p_brand || '|' || p_type AS line FROM part UNION ALL SELECT p_partkey // 50, p_partkey % 50 * 3 + 1, "
    "p_size || '||' || p_type FROM part) WHERE row_idx > 0",
)
def dense_rows(t: Tables) -> DataFrame:
    tables = extract.extract_tables(fixtures.tall_pages(t))
    rows = tables.select("page_id", F.explode("rows").alias("r"))
    line = F.array_join(extract.spread_runs(F.col("r.runs")), "|")
    return rows.select("page_id", F.col("r.row_idx").cast("bigint").alias("row_idx"), line.alias("line"))


@query(
    "header_pick",
    "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 1 ELSE 0 END AS header_row, "
    "CASE WHEN page_id % 2 = 0 THEN 'Name|Segment' ELSE first_row END AS headers, "
    "CASE WHEN page_id % 2 = 0 THEN n + 1 ELSE n - 1 END AS n_rows FROM (SELECT c_custkey // 50 AS page_id, count(*) AS n, "
    "arg_min(c_name || '|' || c_mktsegment, c_custkey) AS first_row FROM customer GROUP BY 1)",
)
def header_pick(t: Tables) -> DataFrame:
    return extract.extract_tables(fixtures.customer_pages(t)).select(
        "page_id", "header_row", F.array_join("headers", "|").alias("headers"), F.size("rows").cast("bigint").alias("n_rows")
    )


@query(
    "tables_in_given_pages",
    "SELECT page_id, 'p' || page_id AS first_cell, strlen(url) || '' AS second_cell, 1 AS row_idx FROM pages UNION ALL "
    "SELECT page_id, 'p' || page_id, 'x', 2 FROM pages",
)
def tables_in_given_pages(t: Tables) -> DataFrame:
    """The given pages as they are, each with a table spliced in before the end of its body."""
    table = F.expr(
        "concat('<div><table><tr><th>Page<th>Length<tr><td rowspan=2>p', page_id, '<td>', octet_length(url), '<tr><td>x</table></div></body>')"
    )
    html = F.when(F.contains("html", F.lit("</body>")), F.replace("html", F.lit("</body>"), table)).otherwise(F.concat("html", table))
    rows = extract.data_rows(extract.extract_tables(t.pages.select("page_id", html.alias("html"))))
    return rows.select("page_id", F.get("cells", 0).alias("first_cell"), F.get("cells", 1).alias("second_cell"), "row_idx")


@query(
    "row_normalise",
    "SELECT page_id, row_idx, list_aggregate(list_transform([1, 2, 3, 4], lambda i: coalesce(parts[i], '')), 'string_agg', '|') AS line "
    f"FROM (SELECT p_partkey // 50 AS page_id, p_partkey % 50 + 1 AS row_idx, string_split({_PART_LINE}, '|') AS parts FROM part)",
)
def row_normalise(t: Tables) -> DataFrame:
    rows = extract.data_rows(extract.extract_tables(fixtures.part_pages(t)))
    return rows.select("page_id", F.col("row_idx").cast("bigint").alias("row_idx"), F.array_join("cells", "|").alias("line"))


@query(
    "extract_rejects",
    "SELECT page_id, 'no_table' AS reason FROM pages UNION ALL SELECT -s_suppkey - 1, CASE s_suppkey % 4 WHEN 0 THEN 'no_table' "
    "WHEN 1 THEN 'no_rows' ELSE 'no_header' END FROM supplier WHERE s_suppkey % 4 < 3",
)
def extract_rejects(t: Tables) -> DataFrame:
    pages = t.pages.select("page_id", "html").unionByName(fixtures.broken_pages(t))
    return extract.extract_rejects(extract.parse_pages(pages))
