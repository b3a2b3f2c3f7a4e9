import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabloom.operators import extract, html_cells

SEEDED = random.Random(20)


def grid_page(rows, table_class="", header="th"):
    """A table of texts; the first row is its header."""
    lines = ["".join(f"<{header if i == 0 else 'td'}>{c}" for c in row) for i, row in enumerate(rows)]
    return f'<table class="{table_class}"><tr>' + "<tr>".join(lines) + "</table>"


def some_rows(columns, rows):
    return [[f"v{SEEDED.randrange(10**6)}" for _ in range(columns)] for _ in range(rows + 1)]


def as_found(rows):
    return rows[0], rows[1:]


FIRST, SECOND, THIRD = some_rows(1, 3), some_rows(4, 2), some_rows(2, 5)
SEVERAL = "<p>x" + grid_page(FIRST, "links") + grid_page(SECOND, "striped results") + grid_page(THIRD, "resultset")


def extracted(spark, *pages, **options):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id bigint, html string")
    rows = extract.extract_tables(df, **options).orderBy("page_id").collect()
    return [(r["headers"], [[c["text"] for c in x["runs"] for _ in range(c["n"])] for x in r["rows"]]) for r in rows]


def normalised(spark, page, **options):
    df = spark.createDataFrame([(0, page)], "page_id bigint, html string")
    rows = extract.data_rows(extract.extract_tables(df, **options)).orderBy("row_idx").collect()
    return [r["cells"] for r in rows]


def test_choice_of_table(spark):
    """The class decides where a table has it, else the position, else the first table."""
    tables = [FIRST, SECOND, THIRD]
    choices = {("results", 0): 1, ("resultset", 0): 2, ("result", 2): 2, ("RESULTS", 1): 1, (None, 0): 0, ("none", 3): 0, (None, -2): 0}
    for (css_class, index), want in choices.items():
        assert extracted(spark, SEVERAL, css_class=css_class, table_index=index) == [as_found(tables[want])]


def spanned_page(spark, placed, width, height):
    """Render rectangles (row, column, rows, columns, text) that tile a grid."""
    lines = []
    for r in range(height):
        cells = sorted((c, f'<td rowspan="{h}" colspan="{w}">{text}') for top, c, h, w, text in placed if top == r)
        lines.append("<tr>" + "".join(cell for _, cell in cells))
    return "<table><tr>" + "<th>h" * width + "".join(lines) + "</table>"


def tiling(rnd, width, height):
    """Random rectangles that cover every place once."""
    owner, placed = {}, []
    for r in range(height):
        for c in range(width):
            if (r, c) in owner:
                continue
            w = h = 1
            while c + w < width and (r, c + w) not in owner and rnd.random() < 0.4:
                w += 1
            while r + h < height and rnd.random() < 0.4:
                h += 1
            placed.append((r, c, h, w, f"t{len(placed)}"))
            owner.update({(r + i, c + j): f"t{len(placed) - 1}" for i in range(h) for j in range(w)})
    return placed, [[owner[r, c] for c in range(width)] for r in range(height)]


def test_spans_fill_their_rectangles(spark):
    rnd = random.Random(8)
    cases = [(w, h, *tiling(rnd, w, h)) for w, h in [(rnd.randint(1, 6), rnd.randint(1, 7)) for _ in range(60)]]
    pages = [spanned_page(spark, placed, w, h) for w, h, placed, _ in cases]
    assert extracted(spark, *pages) == [(["h"] * w, grid) for w, _, _, grid in cases]


def test_huge_spans_cost_no_columns(spark):
    wide = "<table><tr><th>a<th>b<tr><td colspan=9000000000000000000>x<tr><td rowspan=77777777777 colspan=1000000000>y" + "<tr>" * 5000 + "</table>"
    got = normalised(spark, wide)
    assert got[0] == ["x", "x"] and got[1:] == [["y", "y"]] * 5001
    df = spark.createDataFrame([(0, "<table><tr><th colspan=5000000>a<tr><td>1</table>")], "page_id bigint, html string")
    assert [r["reason"] for r in extract.judge_pages(df).collect()] == ["too_wide"]


def test_header_spanning_rows_leaves_data_behind(spark):
    page = "<table><tr><th rowspan=2>A<th colspan=2>B<tr><th>b1<th>b2<tr><td>1<td>2<td>3</table>"
    assert extracted(spark, page) == [(["A", "B", "B"], [["A", "b1", "b2"], ["1", "2", "3"]])]


def test_rows_above_the_header_stay(spark):
    page = "<table><tr><td>title<tr></tr><tr><td>x<th>y<tr><td>1<td>2<td>3</table>"
    assert normalised(spark, page) == [["title", ""], ["1", "2"]]


def test_rejects(spark):
    pages = ["<p>no</p>", "<table></table>", "<table><tr></tr></table>", SEVERAL, "<!-- <table> -->", "<TABLE><TD>x"]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id bigint, html string")
    got = {r["page_id"]: r["reason"] for r in extract.extract_rejects(extract.parse_pages(df)).collect()}
    assert got == {0: "no_table", 1: "no_rows", 2: "no_header", 4: "no_table"}


def scan(page):
    return [
        (c, [[(th, cs, rs, html_cells._flatten(text)) for th, cs, rs, text in row] for row in rows])
        for c, rows in html_cells.scan_tables(page)
    ]


def texts(page):
    return [[[cell[3] for cell in row] for row in rows] for _, rows in scan(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("<table><td>1<td>2<tr><td>3</table>", [[["1", "2"], ["3"]]]),
        ("<table><tr><td>a<br>b <i>c</i>&amp;&nbsp;&#65;</table>", [[["ab c&\xa0A"]]]),
        ("<table><tr><td>a<table><tr><td>in</td></tr></table>b<td>c</table>", [[["ainb", "c"]]]),
        ("<table><tr><td>a<table>X<tr><td>in</td></tr>Y</table>b</table>", [[["aXYinb"]]]),
        ("<table><tr><td>1<tr><td>2</table>text<table><tr><td>3</table>", [[["1"], ["2"]], [["3"]]]),
        ("<table><tr><table><tr><td>q</table>", [[[]], [["q"]]]),
        ("<table><caption>t<table><tr><td>in</table></caption><tr><td>out</table>", [[["in"], ["out"]]]),
        ("<table><tr><td>a</th>b</td>c<td>d</table>", [[["ab", "d"]]]),
        ("<td>loose</td><table></table>", [[]]),
        ("<table><tr><td>a<script>if (x<y) '</td>'</script>b</table>", [[["aif (x<y) '</td>'b"]]]),
        ("<table><tr><td><textarea>\n<td>&lt;</textarea><pre>\nq</pre></table>", [[["<td><q"]]]),
        ("<table><tr><td title='<td>' class=x>a<!-- <td> --><td>b</table>", [[["a", "b"]]]),
        ("<table><tr><td>1 < 2 & 3 <td cla", [[["1 < 2 & 3 "]]]),
        ("<table><thead><tr><th>h</thead><tbody><tr><td>b</tbody><tfoot><tr><td>f</table>", [[["h"], ["b"], ["f"]]]),
        ("<table><tr><td>a\r\nb\rc\x00d</table>", [[["a\nb\ncd"]]]),
        ("<table/><tr/><td/>x</table>", [[["x"]]]),
    ],
)
def test_markup(page, want):
    assert texts(page) == want


def test_attributes():
    page = """<table CLASS="a &amp; b" class=second><tr><th ColSpan=2 rowspan='3' colspan=9>x<td colspan>y</table>"""
    assert scan(page) == [("a & b", [[(True, "2", "3", "x"), (False, "", None, "y")]])]


def test_unclosed_markup_is_linear():
    page = "<table><tr><td>" + "<a b=" * 20_000 + "<td " * 20_000
    assert len(scan(page)) == 1


def test_deep_nesting():
    page = "<table><tr><td>x" * 3000
    assert texts(page) == [[["x" * 3000]]]


def columns_of(runs):
    return [cell for cell, n in runs for _ in range(n)]


def test_runs_keep_to_the_rules():
    """Cells start at the first column that no taller cell holds, and fill their rectangle unless
    a later cell is painted over it."""
    rnd = random.Random(7)
    for _ in range(2000):
        rows = [
            [(rnd.choice([1, 1, 1, 2, 3]), rnd.choice([1, 1, 1, 2, 3, 5])) for _ in range(rnd.randint(0, 4))]
            for _ in range(rnd.randint(0, 6))
        ]
        lines = [columns_of(runs) for runs in html_cells.resolve_runs(rows)]
        assert len(lines) == len(rows)
        number, height = 0, {}
        for r, row in enumerate(rows):
            for k, (cols, tall) in enumerate(row):
                height[number + k] = (r, tall)
                at = [c for c, cell in enumerate(lines[r]) if cell == number + k]
                later = set(range(number + k + 1, number + len(row)))
                assert len(at) == cols or any(cell in later for cell in lines[r])
            number += len(row)
        for r, line in enumerate(lines):
            assert all(cell == -1 or height[cell][0] <= r < height[cell][0] + height[cell][1] for cell in line)


def test_unclosed_raw_text_is_linear():
    page = "<table><tr><td>a</table><script>" + "</script " * 60_000
    assert len(scan(page)) == 1


def test_span_value(spark):
    cases = {
        "2": 2, "2px": 2, " +3": 3, "0": 1, "-1": 1, "x": 1, "": 1, "010": 8, "08": 1, "0x1F": 31, "0b11": 3, "0o17": 15, "1_0": 10,
        "1__0": 1, "99999999999999999999": 1, "5000": 5000, "1000": 1000, "\u00a07": 7, "7.9": 7, "0x" + "F" * 18: 1,
        "0" + "7" * 30: 1, "0b" + "1" * 63: 2**63 - 1, "0b" + "1" * 64: 1, "0x" + "0" * 40 + "1f": 31, "0o" + "7" * 21: 2**63 - 1,
        "0x7fffffffffffffff": 2**63 - 1, "0x8000000000000000": 1, "9223372036854775807": 2**63 - 1, "9223372036854775808": 1, "0x": 1,
    }
    df = spark.createDataFrame([(k,) for k in cases], "a string")
    got = {r["a"]: r["v"] for r in df.select("a", extract.span_value(F.col("a")).alias("v")).collect()}
    assert got == cases
    assert {r["a"]: r["v"] for r in df.select("a", extract.span_value(F.col("a"), 9).alias("v")).collect()} == {k: min(v, 9) for k, v in cases.items()}


def test_cut_pages_are_marked(spark):
    df = spark.createDataFrame([(1, SEVERAL), (2, "<p>short")], "page_id bigint, html string")
    assert {r["page_id"]: r["page_cut"] for r in extract.judge_pages(df, max_bytes=100).collect()} == {1: True, 2: False}
    assert not any(r["page_cut"] for r in extract.judge_pages(df).collect())


def test_cap_body(spark):
    df = spark.createDataFrame([("abcdef",), ("aé",), ("ab",)], "h string")
    assert [r[0] for r in df.select(extract.cap_body(F.col("h"), 2)).collect()] == ["ab", "a�", "ab"]


def test_every_page_is_accounted_for(spark):
    df = spark.createDataFrame([(1, "<p>"), (2, None), (3, SEVERAL)], "page_id bigint, html string")
    assert {r["page_id"]: len(r["tables"]) for r in extract.parse_pages(df).collect()} == {1: 0, 2: 0, 3: 3}


def test_python_stages_work_in_small_batches(spark):
    """F3-F6, F8: what a Python worker holds does not follow the pages of its task."""
    page = "<table>" + "<tr><td>x" * 20_000
    found = list(html_cells.parse_batches([pa.record_batch([pa.array(range(40)), pa.array([page] * 40)], names=["page_id", "html"])]))
    assert sum(len(b) for b in found) == 40 and max(len(b) for b in found) <= 7
    pages = spark.range(0, 200, 1, 1).select(F.lit("x" * 100_000).alias("html"))
    sizes = pages.mapInArrow(lambda batches: (pa.record_batch({"n": pa.array([b.nbytes])}) for b in batches), "n long").collect()
    assert max(r["n"] for r in sizes) < 6 << 20
