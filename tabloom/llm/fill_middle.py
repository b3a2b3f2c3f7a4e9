"""Fill-in-the-middle: a text is cut at two line ends and its parts are put in another order.

The places where a text may be cut (its start and the end of each line, in code points) are
a compressed set of integers: containers of 65,536 neighbouring places each, kept as a sorted
array, a bitmap or runs, whichever is smallest, with the number of places before each
container. The k-th place is found by a search over those numbers, then inside one container.

A document's own hash gives both cuts and the form, so a repeated run gives the same rows.
Null text is empty; an empty text, or one that holds a mark, stays as it is (``plain``). A
null doc_id counts as empty text in the hash. Rows that repeat a doc_id are cut each by
their own lines. Every row is handled by itself, about a mebibyte of text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.common import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
WIDTH = 1 << 16
BITMAP_BYTES = WIDTH // 8


class ArrayContainer:
    """Sorted 16-bit places."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit for each of 65,536 places, with the number of bits set before each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(WIDTH, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - self.before[word]])


class RunContainer:
    """First place and number of places of each run, with the number of places before it."""

    def __init__(self, low: np.ndarray, starts: np.ndarray):
        self.first = low[starts].astype(np.uint16)
        self.before = np.append(starts, len(low)).astype(np.int32)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container of sorted, distinct places below 65,536."""
    starts = np.concatenate([[0], np.flatnonzero(np.diff(low) != 1) + 1])
    array, runs = 2 * len(low), 4 * len(starts)
    if runs < min(array, BITMAP_BYTES):
        return RunContainer(low, starts)
    return ArrayContainer(low) if array <= BITMAP_BYTES else BitmapContainer(low)


class BoundarySet:
    """Sorted, distinct places; ``select(k)`` is the k-th, counted from 0."""

    def __init__(self, places: np.ndarray):
        high = places >> 16
        edge = np.concatenate([[0], np.flatnonzero(np.diff(high)) + 1, [len(places)]]) if len(places) else np.zeros(1, int)
        self.high = high[edge[:-1]]
        self.before = edge
        self.containers = [container(places[a:b] & (WIDTH - 1)) for a, b in zip(edge[:-1], edge[1:])]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return (int(self.high[at]) << 16) + self.containers[at].select(k - int(self.before[at]))


def cut_places(ends: np.ndarray, first: int, second: int) -> tuple[int, int]:
    """Both cuts of a text whose lines end at ``ends``, by two numbers of its hash."""
    boundaries = BoundarySet(np.concatenate([[0], ends]))
    a, b = first % len(boundaries), second % len(boundaries)
    return boundaries.select(min(a, b)), boundaries.select(max(a, b))


def _arrange(percent: int, suffix_first: int):
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def one(data: bytes, is_start: np.ndarray, ends: np.ndarray, h: list[int]) -> tuple[str, int | None, int | None, bytes]:
        if not data or h[2] % 100 >= percent or any(m in data for m in marks):
            return "plain", None, None, data
        a, b = cut_places(ends, h[0], h[1])
        at = np.append(np.flatnonzero(is_start), len(data))  # where each code point begins
        prefix, middle, suffix = data[: at[a]], data[at[a] : at[b]], data[at[b] :]
        p, s, m = marks
        if h[3] % 100 < suffix_first:
            return "spm", a, b - a, b"".join([s, suffix, p, prefix, m, middle])
        return "psm", a, b - a, b"".join([p, prefix, s, suffix, m, middle])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = list(zip(*(batch.column(k).to_pylist() for k in range(2, 6))))
            for at, end, data, offsets in slices(batch.column(1)):
                is_start = (data & 0xC0) != 0x80
                chars = np.concatenate([[0], np.cumsum(is_start)])
                feeds = np.flatnonzero(data == 10) + 1
                bounds = np.searchsorted(feeds, offsets, "right")
                n, forms, before, inside, outputs = [], [], [], [], []
                for r in range(end - at):
                    low, high = offsets[r], offsets[r + 1]
                    ends = chars[feeds[bounds[r] : bounds[r + 1]]] - chars[low]
                    if high > low and data[high - 1] != 10:
                        ends = np.append(ends, chars[high] - chars[low])
                    form, prefix, middle, output = one(data[low:high].tobytes(), is_start[low:high], ends, hashes[at + r])
                    for column, value in zip((n, forms, before, inside, outputs), (len(ends), form, prefix, middle, output)):
                        column.append(value)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(at, end - at),
                        pa.array(n, pa.int64()),
                        pa.array(forms, pa.string()),
                        pa.array(before, pa.int64()),
                        pa.array(inside, pa.int64()),
                        pa.array(outputs, pa.binary()).view(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return rows


def rearrange(documents: DataFrame, seed: int = 7, percent: int = 100, suffix_first: int = 50) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars, output: the text as a model is to see it.

    ``percent`` of the documents are cut; of these ``suffix_first`` per cent have the suffix
    first (``spm``), the others the prefix (``psm``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return documents.select("doc_id", "text", *numbers).mapInArrow(_arrange(percent, suffix_first), schema)


def restored(output: Column, form: Column) -> Column:
    """The exact text, from an output and its form alone. No mark can stand inside a part, nor
    begin in one and end in the mark that follows, so the first of each kind is the mark."""
    first = F.split(F.substring(output, len(PREFIX) + 1, F.length(output)), F.when(form == "psm", SUFFIX).otherwise(PREFIX), 2)
    second = F.split(F.get(first, F.lit(1)), MIDDLE, 2)
    ahead, behind, middle = F.get(first, F.lit(0)), F.get(second, F.lit(0)), F.get(second, F.lit(1))
    return F.when(form == "plain", output).when(form == "psm", F.concat(ahead, middle, behind)).otherwise(F.concat(behind, middle, ahead))


def rearrange_and_restore(documents: DataFrame) -> DataFrame:
    """Digests of each output and of the text rebuilt from it."""
    return rearrange(documents).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
