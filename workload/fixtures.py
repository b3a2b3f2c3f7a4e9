"""HTML pages rendered from the given tables.

A page holds a fixed number of rows of its table, so there are more pages at a
larger scale, not larger ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from workload.base import Tables

_PREFIX = '<!DOCTYPE html><html><head><script>var t="<table><tr>"</script></head><body><!-- <table> --><p title="<table>">x'


def render(rows: DataFrame, page: str, order: list[str], row_html: str, head: str, tail: str = "'</table></body></html>'") -> DataFrame:
    """One page per value of ``page``; ``head`` and ``tail`` may refer to ``page_id``."""
    body = F.array_sort(F.collect_list(F.struct(*order, F.expr(row_html).alias("html"))))
    # The cluster's own number of partitions, kept as it is: pages are costly to parse, not large.
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("page_id", F.expr(page)).repartition(width, "page_id")
    pages = placed.groupBy("page_id").agg(body.alias("_rows"))
    text = F.array_join(F.transform("_rows", lambda r: r["html"]), "\n")
    return pages.select(
        "page_id",
        F.concat(F.lit("http://example.org/"), F.col("page_id")).alias("url"),
        F.concat(F.lit(_PREFIX), F.expr(head), text, F.expr(tail)).alias("html"),
    )


ORDER_COLUMNS = [
    ("status", "VARCHAR(512)"), ("order_", "BIGINT"), ("price", "DOUBLE"), ("price_2", "BIGINT"),
    ("placed", "DATE"), ("shipped", "DATE"), ("priority", "VARCHAR(512)"), ("note", "BIGINT"),
]


def orders_pages(t: Tables) -> DataFrame:
    """100 orders per page; one status cell spans all orders with that status."""
    page = "o_orderkey div 100"
    group = Window.partitionBy(F.expr(page), "o_orderstatus")
    rows = t.orders.withColumn("_n", F.count(F.lit(1)).over(group)).withColumn(
        "_k", F.row_number().over(group.orderBy("o_orderkey"))
    )
    row = """concat('<tr>',
        CASE WHEN _k = 1 THEN concat('<td rowspan="', _n, '">', o_orderstatus, '</td>') ELSE '' END,
        '<td>', format_number(o_orderkey, 0), '</td><td>',
        CASE WHEN o_orderkey % 17 = 0 THEN '—' ELSE concat('$', format_number(o_totalprice, 2), '[a]') END,
        '<td>', o_custkey % 100, '%<td>', date_format(o_orderdate, 'yyyy-MM-dd'), '</td><td> ',
        date_format(o_orderdate, 'MMM d, yyyy'), '&nbsp;<td><b>', o_orderpriority, '</b><td>n/a')"""
    head = """'<table class="nav"><tr><td>Home</table><table class="sortable wikitable"><caption>Orders</caption>
        <tr><th>Status<th>Order[1]<th>Price ($)<th>% Price<th>Placed<th>Shipped<th>Priority<th>Note</th></tr>'"""
    return render(rows, page, ["o_orderstatus", "o_orderkey"], row, head)


def supplier_pages(t: Tables) -> DataFrame:
    """10 suppliers per page: a menu, the data table, and on most pages a summary table."""
    row = """concat('<tr><td><b>Supplier</b>&#35;', substring(s_name, 10), '<br></td>',
        '<td>x<table><tr><td>n', s_nationkey, '</td></tr></table>&amp;y</td><td>', CAST(s_acctbal AS DECIMAL(15,2)), '</td></tr>')"""
    head = """concat('<table class="nav"><tr><td>Home</table>',
        CASE WHEN page_id % 3 = 0 THEN '<TABLE class=dataset>' ELSE '<table class="\n data  wide ">' END,
        '<tr><th>Name<th>Nation<th>Balance</tr>')"""
    tail = """concat('</table>', CASE WHEN page_id % 3 = 0 THEN '' ELSE
        '<table id=s class="data"><tr><td>Rows</td></tr><tr><td>10</td></tr></table>' END)"""
    return render(t.supplier, "s_suppkey div 10", ["s_suppkey"], row, head, tail)


def part_pages(t: Tables) -> DataFrame:
    """50 parts per page: names in one wide cell or two, short and long rows, no row spans."""
    row = """concat('<tr>', CASE WHEN p_size % 3 = 0 THEN concat('<td colspan="2">', p_name, '</td>')
        ELSE concat('<td>', split(p_name, ' ')[0], '</td><td colspan="1">', split(p_name, ' ')[1], '</td>') END,
        CASE WHEN p_size % 5 = 1 THEN '' ELSE concat('<td>', p_brand, '</td><td colspan=x>', p_size, '</td>') END,
        CASE WHEN p_size % 7 = 1 THEN '<td colspan="3px">more</td>' ELSE '' END, '</tr>')"""
    head = "'<table><tr><th colspan=2>Name</th><th>Brand</th><th>Size</th></tr>'"
    return render(t.part, "p_partkey div 50", ["p_partkey"], row, head)


def tall_pages(t: Tables) -> DataFrame:
    """50 parts per page, three rows each: the type spans two rows, the third row is empty."""
    row = """concat('<tr><td>', p_name, '<td>', p_brand, '<td rowspan="2">', p_type, '<tr><td>', p_size, '<tr>')"""
    return render(t.part, "p_partkey div 50", ["p_partkey"], row, "'<table>'")


def customer_pages(t: Tables) -> DataFrame:
    """50 customers per page; even pages have a title row above the header, odd pages no header."""
    row = "concat('<tr><td>', c_name, '</td><td>', c_mktsegment, '</td></tr>')"
    head = """CASE WHEN page_id % 2 = 0 THEN '<table><thead><tr><td colspan="2">Customers</td></tr><tr><td>Name</td><th>Segment</th></tr></thead><tbody>'
        ELSE '<table>' END"""
    return render(t.customer, "c_custkey div 50", ["c_custkey"], row, head)


def broken_pages(t: Tables) -> DataFrame:
    """One page per supplier: no table, no rows, only empty rows, or a good table."""
    html = """CASE s_suppkey % 4 WHEN 0 THEN '<p>none</p>' WHEN 1 THEN '<table></table>'
        WHEN 2 THEN '<table><tr></tr><tr></tr></table>' ELSE '<table><tr><td>x' END"""
    return t.supplier.select((-F.col("s_suppkey") - 1).alias("page_id"), F.expr(html).alias("html"))
