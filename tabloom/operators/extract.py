"""Pages to tables: choose a table, resolve spans, split header from rows.

A page is one record, and what concerns a single page is computed inside it, so
extraction is one scan without any shuffle. A row is held as runs, a text and the
number of columns it fills; columns appear only after rows have become records,
and no more of them than the header has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.text import clean_value, split_words, unicode_trim
from tabloom.operators import html_cells

# Executors need no copy of this package: the Python stage travels with the plan.
cloudpickle.register_pickle_by_value(html_cells)

# The page size limit of a fetch stage and the span limits of HTML, for callers who want them.
MAX_PAGE_BYTES = 50 * 1024 * 1024
MAX_COLSPAN = 1000
MAX_ROWSPAN = 65534
# A table whose header fills more columns is set aside as ``too_wide``.
MAX_WIDTH = 100_000


def cap_body(html: Column, max_bytes: int) -> Column:
    """Cut a page after ``max_bytes`` bytes; a character cut in half becomes U+FFFD."""
    head = F.substring(F.encode(html, "UTF-8"), 1, max_bytes)
    return F.when(F.octet_length(html) > max_bytes, F.make_valid_utf8(head.cast("string"))).otherwise(html)


def has_class(table_class: Column, name: str) -> Column:
    """Whole-token, case-sensitive match on a class attribute."""
    return F.coalesce(F.array_contains(split_words(table_class), name), F.lit(False))


def span_value(attr: Column, limit: int | None = None) -> Column:
    """A span attribute: its leading integer if positive and below 2^63, else 1.

    Integers may carry a plus sign, single underscores between digits and a
    base prefix (``0x``, ``0b``, ``0o`` or a bare leading zero for octal).
    """
    token = F.regexp_extract(
        attr, r"^\p{IsWhite_Space}*\+?(0[xX][0-9a-fA-F_]*|0[bB][01_]*|0[oO][0-7_]*|0[0-7_]*|[1-9][0-9_]*)", 1
    )
    valid = token.rlike(r"^(?:0[xX](?:_?[0-9a-fA-F])+|0[bB](?:_?[01])+|0[oO](?:_?[0-7])+|0(?:_?[0-7])*|[1-9](?:_?[0-9])*)\z")
    digits = F.lower(F.replace(token, F.lit("_"), F.lit("")))

    def based(radix: int, prefix: str, longest: int) -> Column:
        """The number, if it has no more digits than 64 bits hold; leading zeros do not count."""
        body = F.regexp_replace(digits, f"^{prefix}0*", "")
        return F.when(F.length(body) <= longest, F.conv(F.concat(F.lit("0"), body), radix, 10))

    number = (
        F.when(digits.startswith("0x"), based(16, "0x", 16))
        .when(digits.startswith("0b"), based(2, "0b", 64))
        .when(digits.startswith("0o"), based(8, "0o", 21))
        .when(digits.startswith("0"), based(8, "0", 21))
        .otherwise(digits)
    ).try_cast("bigint")
    span = F.coalesce(F.when(valid & (number > 0), number), F.lit(1).cast("bigint"))
    small = F.when(attr.isNull() | (attr == "1"), F.lit(1).cast("bigint")).when(attr.rlike(r"^[1-9][0-9]{0,8}\z"), attr.try_cast("bigint"))
    value = small.otherwise(span)
    return value if limit is None else F.least(value, F.lit(limit).cast("bigint"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind an array once and use it inside a lambda; inlined, it would be rebuilt per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def parse_pages(pages: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``(page_id, html)`` to ``(page_id, page_key, page_cut, tables)``, one row per page.

    ``page_id`` may have any type, be null or repeat; ``page_key`` tells rows apart.
    The text of pages without any ``<table`` never leaves the JVM: their list is empty.
    With ``max_bytes`` longer pages are cut and marked.
    """
    html = F.col("html")
    body = html if max_bytes is None else cap_body(html, max_bytes)
    cut = F.lit(False) if max_bytes is None else F.coalesce(F.octet_length(html) > max_bytes, F.lit(False))
    candidate = F.when(html.rlike("(?i)<table"), body)
    kept = pages.select("page_id", F.monotonically_increasing_id().alias("page_key"), cut.alias("page_cut"), candidate.alias("html"))
    id_type = pages.schema["page_id"].dataType.simpleString()
    ddl = f"page_id {id_type}, page_key bigint NOT NULL, page_cut boolean, tables {html_cells.TABLES_DDL}"
    return kept.mapInArrow(html_cells.parse_batches, ddl)


def list_tables(parsed: DataFrame) -> DataFrame:
    """One row per outermost table in document order."""
    return parsed.select("page_id", "page_key", F.posexplode("tables").alias("table_index", "t")).select(
        "page_id", "page_key", "table_index", F.col("t.table_class").alias("table_class"), F.col("t.rows").alias("rows")
    )


def choose_tables(parsed: DataFrame, css_class: str | None = None, table_index: int = 0) -> DataFrame:
    """One table per page: the first with the class, else by index, else the first.

    Every page stays. ``reason`` says why one gives no table: ``no_table``, ``no_rows``
    or ``no_header``.
    """
    tables = F.col("tables")
    in_range = F.when(F.lit(table_index).between(0, F.size(tables) - 1), F.lit(table_index)).otherwise(F.lit(0))
    choice = in_range
    if css_class:
        hit = F.array_position(F.transform(tables, lambda t: has_class(t["table_class"], css_class)), True)
        choice = F.when(hit > 0, (hit - 1).cast("int")).otherwise(in_range)
    rows = F.col("_t.rows")
    reason = (
        F.when(F.size(tables) == 0, F.lit("no_table"))
        .when(F.size(rows) == 0, F.lit("no_rows"))
        .when(~F.exists(rows, lambda r: F.size(r) > 0), F.lit("no_header"))
    )
    chosen = parsed.withColumn("table_index", F.when(F.size(tables) > 0, choice)).withColumn("_t", F.get(tables, F.col("table_index")))
    return chosen.select(
        "page_id", "page_key", "page_cut", "table_index", F.col("_t.table_class").alias("table_class"), rows.alias("rows"), reason.alias("reason")
    )


def select_table(parsed: DataFrame, css_class: str | None = None, table_index: int = 0) -> DataFrame:
    """The chosen table of each page that has any."""
    chosen = choose_tables(parsed.filter(F.size("tables") > 0), css_class, table_index)
    return chosen.select("page_id", "page_key", "table_index", "table_class", "rows")


def physical_rows(tables: DataFrame) -> DataFrame:
    """Rows as written, numbered in document order."""
    return tables.select("page_id", "page_key", "table_index", F.posexplode("rows").alias("row_idx", "cells")).withColumn(
        "has_th", F.exists("cells", lambda c: c["is_th"])
    )


def physical_cells(tables: DataFrame) -> DataFrame:
    """Cells as written, with trimmed text and unparsed span attributes."""
    return physical_rows(tables).select(
        "page_id", "page_key", "table_index", "row_idx", F.posexplode("cells").alias("cell_ord", "c")
    ).select(
        "page_id", "page_key", "table_index", "row_idx", "cell_ord", F.col("c.is_th").alias("is_th"),
        F.col("c.colspan").alias("colspan"), F.col("c.rowspan").alias("rowspan"),
        unicode_trim(F.col("c.text")).alias("text"),
    )


def resolve_runs(tables: DataFrame, max_colspan: int | None = None, max_rowspan: int | None = None) -> DataFrame:
    """Add ``runs``: per row, texts with the number ``n`` of columns each fills.

    Tables without row spans need only their own cells. Row spans make the place of
    a cell depend on all rows above it; for those tables the span numbers go through
    Python, which returns runs of cell numbers. The texts stay in the JVM.
    """
    def spans(name: str, limit: int | None) -> Column:
        return F.transform("rows", lambda r: F.transform(r, lambda c: span_value(c[name], limit)))

    rows = F.col("rows")
    # Without a rowspan attribute other than 1 a table needs no look at the rows above.
    tall = F.exists(rows, lambda r: F.exists(r, lambda c: c["rowspan"] != "1"))
    # Marked nondeterministic so that no filter is pushed below it and runs it twice.
    place = F.arrow_udf(html_cells.runs_of, "array<array<struct<cell int, n bigint>>>").asNondeterministic()
    placed = place(F.when(tall, spans("colspan", max_colspan)), F.when(tall, spans("rowspan", max_rowspan)))
    flat = F.transform(F.flatten(rows), lambda c: unicode_trim(c["text"]))
    text = lambda texts, run: F.when(run["cell"] < 0, F.lit("")).otherwise(F.get(texts, run["cell"]))
    named = _let(
        flat,
        lambda texts: F.transform(
            F.col("_placed"), lambda r: F.transform(r, lambda run: F.struct(text(texts, run).alias("text"), run["n"].alias("n")))
        ),
    )
    own = F.transform(
        rows,
        lambda r: F.transform(r, lambda c: F.struct(unicode_trim(c["text"]).alias("text"), span_value(c["colspan"], max_colspan).alias("n"))),
    )
    return (
        tables.withColumn("_placed", placed).withColumn("runs", F.when(F.col("_placed").isNull(), own).otherwise(named)).drop("_placed")
    )


def run_width(runs: Column) -> Column:
    """Columns that a row fills, counted up to just above MAX_WIDTH."""
    enough = F.lit(MAX_WIDTH + 1).cast("bigint")
    return F.aggregate(runs, F.lit(0).cast("bigint"), lambda n, r: F.least(n + F.least(r["n"], enough), enough))


def spread_runs(runs: Column, width: Column | None = None) -> Column:
    """The text of every column; with ``width`` no run gives more than that many."""
    count = (lambda r: r["n"]) if width is None else (lambda r: F.least(r["n"], width.cast("bigint")))
    return F.flatten(F.transform(runs, lambda r: F.array_repeat(r["text"], count(r).cast("int"))))


def pick_header(tables: DataFrame) -> DataFrame:
    """Add ``header_row``: the first row with a ``<th>``, else the first that is not empty.

    Read off the physical rows, before spans are resolved. The first filled row has cells of its own: spans come from above.
    """
    first_th = F.array_position(F.transform("rows", lambda r: F.exists(r, lambda c: c["is_th"])), True)
    first_filled = F.array_position(F.transform("rows", lambda r: F.size(r) > 0), True)
    position = F.coalesce(F.nullif(first_th, F.lit(0)), F.nullif(first_filled, F.lit(0)))
    return tables.withColumn("header_row", (position - 1).cast("int"))


def split_header(tables: DataFrame) -> DataFrame:
    """Tables as ``headers`` and ``rows``, the latter as runs; empty rows vanish, rows above the header stay."""
    lines = F.transform("runs", lambda g, i: F.struct(i.alias("row_idx"), g.alias("runs")))
    rows = F.filter(lines, lambda r: (r["row_idx"] != F.col("header_row")) & (F.size(r["runs"]) > 0))
    header = F.get("runs", F.col("header_row"))
    reason = F.coalesce(F.col("reason"), F.when(run_width(header) > MAX_WIDTH, F.lit("too_wide")))
    good = reason.isNull()
    return tables.select(
        "page_id", "page_key", "page_cut", "table_index", "header_row",
        F.when(good, spread_runs(header)).alias("headers"), F.when(good, rows).alias("rows"), reason.alias("reason"),
    )


def judge_pages(
    pages: DataFrame,
    css_class: str | None = None,
    table_index: int = 0,
    max_bytes: int | None = None,
    max_colspan: int | None = None,
    max_rowspan: int | None = None,
) -> DataFrame:
    """One ``(page_id, page_key, page_cut, table_index, header_row, headers, rows, reason)`` per
    page; ``reason`` tells why a page gives no table and is null otherwise."""
    chosen = choose_tables(parse_pages(pages, max_bytes), css_class, table_index)
    return split_header(resolve_runs(pick_header(chosen), max_colspan, max_rowspan))


def extract_tables(pages: DataFrame, css_class: str | None = None, table_index: int = 0, **limits: int | None) -> DataFrame:
    """The tables of the pages that give one. ``limits`` as in :func:`judge_pages`, none by default."""
    return judge_pages(pages, css_class, table_index, **limits).filter(F.col("reason").isNull())


def normalise_row(cells: Column, width: Column) -> Column:
    """Pad a row with empty text, or cut it, to the header's length."""
    return F.slice(F.concat(cells, F.array_repeat(F.lit(""), F.greatest(width - F.size(cells), F.lit(0)))), F.lit(1), width)


def data_rows(tables: DataFrame, *extra: str, keep_empty: bool = False) -> DataFrame:
    """One row per data row, its cells as long as the header. ``keep_empty``: tables
    without rows give one row without cells."""
    explode = F.explode_outer if keep_empty else F.explode
    width = F.size("headers")
    rows = tables.select("page_id", "page_key", *extra, "headers", explode("rows").alias("_r"))
    return rows.select(
        "page_id", "page_key", *extra, F.col("_r.row_idx").alias("row_idx"),
        normalise_row(spread_runs(F.col("_r.runs"), width), width).alias("cells"),
    )


def data_cells(rows: DataFrame) -> DataFrame:
    """One row per data cell, cleaned."""
    return rows.select("page_id", "page_key", "row_idx", F.posexplode("cells").alias("col_idx", "_v")).select(
        "page_id", "page_key", "row_idx", "col_idx", clean_value(F.col("_v")).alias("value")
    )


def extract_rejects(parsed: DataFrame, css_class: str | None = None, table_index: int = 0) -> DataFrame:
    """Pages that give no table, with the reason."""
    return choose_tables(parsed, css_class, table_index).filter(F.col("reason").isNotNull()).select("page_id", "reason")
