"""The one Python stage of table extraction: markup in, physical cells out.

It finds the outermost tables of a page and lists their rows and cells as they
are written. Which table is wanted, what spans mean and which row is the header
is decided afterwards by DataFrame expressions.
"""

from __future__ import annotations

import html
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Elements whose content is text, not markup. Entities count in the first two.
RAW_TEXT = "textarea|title|script|style|xmp|iframe|noembed|noframes|noscript"
ESCAPABLE = {"textarea", "title"}

_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_TOKEN = re.compile(
    rf"""<!--(?:-?>|.*?(?:--!?>|\Z))
    |<(?P<raw>{RAW_TEXT})(?=[\s/>]){_ATTRIBUTES}>(?P<body>.*?)(?:</(?P=raw)(?=[\s/>])[^>]*+(?:>|\Z)|\Z)
    |<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>{_ATTRIBUTES})>
    |<[!?/][^>]*(?:>|\Z)
    |<[a-z][^>]*\Z""",
    re.IGNORECASE | re.DOTALL | re.VERBOSE,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")

_SECTIONS = {"thead", "tbody", "tfoot"}
_STRUCTURE = _SECTIONS | {"table", "tr", "td", "th", "caption", "col", "colgroup"}

CELL_TYPE = pa.struct([("is_th", pa.bool_()), ("colspan", pa.string()), ("rowspan", pa.string()), ("text", pa.string())])
TABLES_TYPE = pa.list_(pa.struct([("table_class", pa.string()), ("rows", pa.list_(pa.list_(CELL_TYPE)))]))
TABLES_DDL = (
    "array<struct<table_class string, "
    "rows array<array<struct<is_th boolean, colspan string, rowspan string, text string>>>>>"
)


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


class _Table:
    """An open table. ``rows`` is shared by a table and those in its captions, else None."""

    __slots__ = ("rows", "text", "fostered", "cell", "in_row", "in_caption", "section")

    def __init__(self, rows: list | None, text: list | None, fostered: list | None):
        self.rows = rows
        self.text = text  # where text inside a cell or caption goes
        self.fostered = fostered  # where stray text goes: in front of the table
        self.cell: str | None = None
        self.in_row = self.in_caption = False
        self.section = ""

    def close_cell(self) -> None:
        self.cell = None
        if self.rows is not None:
            self.text = None

    def close_row(self) -> None:
        self.close_cell()
        self.in_row = self.in_caption = False

    def open_row(self) -> None:
        self.close_row()
        self.in_row = True
        self.section = self.section or "tbody"
        if self.rows is not None:
            self.rows.append([])

    def open_cell(self, tag: str, attrs: str) -> None:
        self.close_cell()
        if not self.in_row:
            self.open_row()
        self.cell = tag
        if self.rows is not None:
            self.text = []
            given = _attributes(attrs) if attrs else {}
            self.rows[-1].append((tag == "th", given.get("colspan"), given.get("rowspan"), self.text))


def _flatten(parts: list) -> str:
    """Join nested lists of text; nested tables make them deep, so no recursion."""
    try:
        return "".join(parts)
    except TypeError:  # a nested table left lists among the text
        pass
    out: list[str] = []
    stack = [iter(parts)]
    while stack:
        for part in stack[-1]:
            if isinstance(part, str):
                out.append(part)
            else:
                stack.append(iter(part))
                break
        else:
            stack.pop()
    return "".join(out)


def scan_tables(page: str) -> list[tuple[str | None, list]]:
    """``(class, rows)`` of each outermost table; a cell is (is_th, colspan, rowspan, text parts)."""
    if "\r" in page:
        page = page.replace("\r\n", "\n").replace("\r", "\n")
    page = page.replace("\x00", "")
    tables: list[tuple[str | None, list]] = []
    stack: list[_Table] = []
    at = 0
    after_pre = False

    def add_text(text: str) -> None:
        nonlocal after_pre
        if after_pre:
            text, after_pre = text.removeprefix("\n"), False
        top = stack[-1]
        if top.rows is not None or top.cell or top.in_caption or not text.strip(" \t\n\f"):
            target = top.text
        else:
            target = top.fostered
        if target is not None:
            target.append(text)

    for token in _TOKEN.finditer(page):
        start, stop = token.span()
        if start > at and stack:
            text = page[at:start]
            add_text(html.unescape(text) if "&" in text else text)
        at = stop
        raw, body, end, tag, attrs = token.groups()
        if not tag:
            if raw and stack:
                raw = raw.lower()
                if raw == "textarea":
                    body = body.removeprefix("\n")
                add_text(html.unescape(body) if raw in ESCAPABLE else body)
            continue
        tag = tag.lower()
        if tag not in _STRUCTURE:
            after_pre = not end and bool(stack) and tag in ("pre", "listing")
            continue
        after_pre = False
        top = stack[-1] if stack else None
        if end:
            if top is None:
                continue
            if tag == "table":
                stack.pop()
            elif tag == "caption":
                if not top.cell:
                    top.in_caption = False
            elif top.in_caption:
                continue
            elif tag == top.cell:
                top.close_cell()
            elif tag == "tr" or (tag in _SECTIONS and tag == top.section):
                top.close_row()
                if tag != "tr":
                    top.section = ""
        elif tag == "table":
            while stack and not (stack[-1].cell or stack[-1].in_caption):
                stack.pop()  # a table cannot sit between cells: it ends the open one
            if not stack:
                rows: list = []
                tables.append((_attributes(attrs).get("class"), rows))
                stack.append(_Table(rows, None, None))
            elif stack[-1].rows is not None and not stack[-1].cell:
                stack.append(_Table(stack[-1].rows, None, None))
            else:
                fostered: list = []
                inside: list = []
                if stack[-1].text is not None:
                    stack[-1].text += [fostered, inside]
                stack.append(_Table(None, inside, fostered))
        elif top is None:
            continue
        elif tag in ("td", "th"):
            top.open_cell(tag, attrs)
        elif tag == "tr":
            top.open_row()
        else:
            top.close_row()
            top.in_caption = tag == "caption"
            top.section = tag if tag in _SECTIONS else ""
    if stack:
        add_text(html.unescape(page[at:]))
    return tables


def _encode(pages: list[list | None]) -> pa.Array:
    """Build the nested Arrow array of a run of pages from flat columns and offsets."""
    is_th: list[bool] = []
    colspan: list[str | None] = []
    rowspan: list[str | None] = []
    text: list[str] = []
    row_ends, table_ends, page_ends = [0], [0], [0]
    classes: list[str | None] = []
    for tables in pages:
        for table_class, rows in tables or ():
            classes.append(table_class)
            for row in rows:
                for header, cols, span, parts in row:
                    is_th.append(header)
                    colspan.append(cols)
                    rowspan.append(span)
                    text.append(_flatten(parts))
                row_ends.append(len(text))
            table_ends.append(len(row_ends) - 1)
        page_ends.append(len(table_ends) - 1)
    cells = pa.StructArray.from_arrays(
        [
            pa.array(is_th, pa.bool_()),
            pa.array(colspan, pa.string()),
            pa.array(rowspan, pa.string()),
            pa.array(text, pa.string()),
        ],
        fields=list(CELL_TYPE),
    )
    rows_array = pa.ListArray.from_arrays(pa.array(row_ends, pa.int32()), cells)
    per_table = pa.ListArray.from_arrays(pa.array(table_ends, pa.int32()), rows_array)
    tables_array = pa.StructArray.from_arrays(
        [pa.array(classes, pa.string()), per_table], fields=list(TABLES_TYPE.value_type)
    )
    return pa.ListArray.from_arrays(pa.array(page_ends, pa.int32()), tables_array)


def parse_batches(batches: Iterator[pa.RecordBatch], flush_chars: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches that end in a column of pages to batches of bounded size that end in their tables."""
    for batch in batches:
        *keys, pages = batch.columns
        start, held, parsed = 0, 0, []
        for i in range(len(pages)):
            page = pages[i].as_py()
            parsed.append(None if page is None else scan_tables(page))
            held += len(page or "")
            if held >= flush_chars or i + 1 == len(pages):
                kept = [key[start : i + 1] for key in keys]
                yield pa.record_batch([*kept, _encode(parsed)], names=[*batch.schema.names[:-1], "tables"])
                start, held, parsed = i + 1, 0, []


def _paint(line: list[tuple], start: int, end: int, value: object) -> None:
    """Give columns start..end a value, in a sorted list of disjoint (start, end, value)."""
    low = bisect_right(line, start, key=lambda part: part[1])
    high = bisect_left(line, end, key=lambda part: part[0])
    new = [(start, end, value)]
    if low < high:
        first, last = line[low], line[high - 1]
        if first[0] < start:
            new.insert(0, (first[0], start, first[2]))
        if last[1] > end:
            new.append((end, last[1], last[2]))
    line[low:high] = new


def resolve_runs(rows: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """Which cell fills each column of a table, from (colspan, rowspan) pairs: per row, runs of
    (cell, columns).

    Cells are numbered through the table in document order; -1 marks a gap. A
    cell starts at the first free column. The columns it spans to the right are
    not checked, so it may cover one that a taller cell above still holds. The work
    follows the number of runs, not that of columns.
    """
    hanging: list[tuple] = []  # (start, end, (last row, cell))
    number = -1
    out = []
    for r, row in enumerate(rows):
        hanging = [part for part in hanging if part[2][0] >= r]
        line = [(start, end, cell) for start, end, (_, cell) in hanging]
        free = 0
        for colspan, rowspan in row:
            number += 1
            at = bisect_right(line, free, key=lambda part: part[1])
            while at < len(line) and line[at][0] <= free:
                free = line[at][1]
                at += 1
            _paint(line, free, free + colspan, number)
            if rowspan > 1:
                _paint(hanging, free, free + colspan, (r + rowspan - 1, number))
            free += colspan
        runs, reached = [], 0
        for start, end, cell in line:
            if start > reached:
                runs.append((-1, start - reached))
            runs.append((cell, end - start))
            reached = end
        out.append(runs)
    return out


RUN_TYPE = pa.struct([("cell", pa.int32()), ("n", pa.int64())])
_LONGEST = (1 << 63) - 1


def runs_of(colspans: pa.Array, rowspans: pa.Array) -> pa.Array:
    """Arrow form of :func:`resolve_runs`, one table at a time; NULL stays NULL. What is done is kept as
    plain numbers, so a batch takes little more than its own size."""
    cells, widths = array("i"), array("q")
    row_ends, table_ends, empty = array("i", [0]), array("i", [0]), []
    for i in range(len(colspans)):
        wide = colspans[i].as_py()
        empty.append(wide is None)
        if wide is not None:
            rows = [list(zip(*pair)) for pair in zip(wide, rowspans[i].as_py())]
            for row in resolve_runs(rows):
                for cell, n in row:
                    cells.append(cell)
                    widths.append(min(n, _LONGEST))
                row_ends.append(len(cells))
        table_ends.append(len(row_ends) - 1)
    flat = [pa.array(np.frombuffer(x, kind)) for x, kind in ((cells, np.int32), (widths, np.int64))]
    rows_array = pa.ListArray.from_arrays(pa.array(np.frombuffer(row_ends, np.int32)), pa.StructArray.from_arrays(flat, fields=list(RUN_TYPE)))
    return pa.ListArray.from_arrays(pa.array(np.frombuffer(table_ends, np.int32)), rows_array, mask=pa.array(empty, pa.bool_()))
