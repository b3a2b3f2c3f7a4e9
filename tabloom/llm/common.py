"""Array helpers for tasks that read text in Arrow batches, and tables written between jobs.

Every helper works on a slice of a batch, about a mebibyte of text at a time, so a
task's memory is bounded by its longest text and not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tabloom.session import work_dir

SLICE_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends in files
    that outlive any executor."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def binary(column: pa.Array) -> pa.Array:
    """Text or bytes with 64-bit offsets; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows of about ``limit`` bytes."""
    values = binary(column)
    rows = len(values)
    if rows == 0:
        return
    _, offset_buffer, data_buffer = values.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[values.offset : values.offset + rows + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.empty(0, np.uint8)
    at = 0
    while at < rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(rows, max(end, at + 1))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def find_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of word bytes; a run never crosses rows."""
    inside = is_word[data]
    first, last = inside.copy(), inside.copy()
    if len(inside):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = offsets[:-1] < offsets[1:]
        begins, ends = offsets[:-1][filled], offsets[1:][filled] - 1
        first[begins] = inside[begins]
        last[ends] = inside[ends]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, row


_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: int, size: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < size:
        size = max(size, SLICE_BYTES + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.multiply.accumulate(steps)
    return have


_letters = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` takes differences of them."""
    powers = _power_table("power", _MULTIPLIER, len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_letters[data] * powers[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of bytes[start:end], the same wherever the bytes stand."""
    inverse = _power_table("inverse", _INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def join_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of hashes; the order counts."""
    out = np.full(len(parts[0]), np.uint64(len(parts)), np.uint64)
    for part in parts:
        out = mix(out * np.uint64(_MULTIPLIER) + part)
    return out


def row_bounds(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each row's entries begin in a list sorted by row, with the total at the end."""
    return np.searchsorted(row, np.arange(rows + 1), "left")


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words in each row, and where each row's begin.
    A row with fewer words has its whole sequence as the one shingle."""
    count = np.diff(bounds)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    out_bounds = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(count)), n)
    at = np.arange(out_bounds[-1]) - out_bounds[row] + bounds[row]
    out = np.empty(len(at), np.uint64)
    whole = count[row] >= size
    if whole.any():
        out[whole] = join_hashes([words[at[whole] + k] for k in range(size)])
    for i in np.flatnonzero(~whole):
        r = row[i]
        out[i] = join_hashes([words[k : k + 1] for k in range(bounds[r], bounds[r + 1])])[0]
    return out, out_bounds


def signed(x: np.ndarray) -> pa.Array:
    """64-bit hashes as a column of longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def lists(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)
