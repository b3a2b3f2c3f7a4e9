"""Best-fit packing: texts become token pieces that share sequences of fixed length.

The lengths of all pieces form a histogram with at most ``capacity`` entries, whatever
the corpus holds. Over it the driver solves the configuration linear program (which
combinations of lengths fill a sequence, and how often each is used) by multiplicative
weights: lengths that lag behind their count get heavier, a knapsack dynamic program
prices the best combination, a step of it is taken. The solution is rounded down and
what remains is placed by best fit. Spark then ranks the pieces of each length and looks
up their places; no piece passes through the driver.

Nulls are empty texts (one end id), null or repeated doc_id are rows of their own,
an empty table gives no pieces, other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tabloom.llm.common import stored
from tabloom.llm.tokens import coder

CAPACITY = 1024
END_ID = 2
RANK_SLICES = 1024
ROUNDS = 600
STEP = 0.5
WEIGHT_RATE = 1.0
BULK = 1.1

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(documents: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Each text's ids with the end id, in pieces of ``capacity``; only the first may be shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded, end = coder(tokenizer), end_id.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = coded.encode(text.as_py() or "") + end
                total = len(ids) // 4
                begin, stop = 0, (total - 1) % capacity + 1
                for piece in range(-(-total // capacity)):
                    part = memoryview(ids)[4 * begin : 4 * stop]
                    rows.append((doc_id, piece, begin, stop - begin, zlib.crc32(part)))
                    begin, stop = stop, stop + capacity
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return documents.select("doc_id", "text").mapInArrow(cut, PIECES)


@dataclass
class Packing:
    """Which patterns are used how often; a pattern maps a length to how many it holds."""

    capacity: int
    uses: list[tuple[dict[int, int], int]] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(count for _, count in self.uses)

    def places(self) -> dict[str, np.ndarray]:
        """Rows (length, first rank, how many of the length a sequence holds, first
        sequence, offset in it), ordered by length and rank."""
        rows, taken, sequence = [], {}, 0
        for pattern, count in self.uses:
            offset = 0
            for length, many in pattern.items():
                rows.append((length, taken.get(length, 0), many, sequence, offset))
                taken[length] = taken.get(length, 0) + many * count
                offset += length * many
            sequence += count
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        return dict(zip(("length", "rank", "many", "sequence", "offset"), table.T))


def best_pattern(value: np.ndarray, capacity: int) -> dict[int, int]:
    """The combination of lengths of the greatest value that fits: unbounded knapsack.
    ``value[k]`` belongs to length k + 1."""
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        options = value[:room] + best[room - 1 :: -1][:room] if room <= len(value) else value + best[room - len(value) : room][::-1]
        k = int(options.argmax())
        best[room], choice[room] = options[k], k + 1 if options[k] > 0 else 0
    pattern: dict[int, int] = {}
    room = capacity
    while room > 0 and choice[room]:
        length = int(choice[room])
        pattern[length] = pattern.get(length, 0) + 1
        room -= length
    return pattern


def fractional_patterns(counts: np.ndarray, capacity: int, rounds: int) -> dict[tuple, float]:
    """Multiplicative weights for the covering program. ``counts[k]`` pieces have length k + 1."""
    lengths = np.arange(1, len(counts) + 1)
    need = counts.astype(float)
    covered = np.zeros(len(counts))
    used: dict[tuple, float] = {}
    for _ in range(rounds):
        open_ = need - covered > 1e-9
        if not open_.any():
            break
        lag = np.where(open_, 1 - covered / np.maximum(need, 1), 0)
        value = np.where(open_, (lengths / capacity) ** BULK * np.exp(WEIGHT_RATE * (lag - lag.max())), 0)
        pattern = best_pattern(value, capacity)
        at = np.array(list(pattern)) - 1
        many = np.array(list(pattern.values()))
        step = float(min((STEP * need[at] / many).min(), ((need - covered)[at] / many).min()))
        covered[at] += step * many
        key = tuple(sorted(pattern.items(), reverse=True))
        used[key] = used.get(key, 0.0) + step
    return used


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first, on a histogram: equal sequences are handled together."""
    rooms: dict[int, list[list]] = {}
    for length in range(len(left), 0, -1):
        remaining = int(left[length - 1])
        while remaining:
            room = next((r for r in range(length, capacity) if rooms.get(r)), None)
            if room is None:
                fits = capacity // length
                whole, rest = divmod(remaining, fits)
                for many, count in ((fits, whole), (rest, 1)):
                    if many and count:
                        rooms.setdefault(capacity - many * length, []).append([{length: many}, count])
                remaining = 0
                continue
            pattern, count = rooms[room].pop()
            fits = room // length
            many, filled = (fits, min(count, remaining // fits)) if remaining >= fits else (remaining, 1)
            if count > filled:
                rooms[room].append([pattern, count - filled])
            rooms.setdefault(room - many * length, []).append([{**pattern, length: many}, filled])
            remaining -= many * filled
    return [(pattern, count) for group in rooms.values() for pattern, count in group]


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> Packing:
    """Place every piece of a histogram; ``counts[k]`` pieces have length k + 1 <= capacity."""
    left = counts.astype(np.int64).copy()
    packing = Packing(capacity)
    if len(left) == capacity and left[-1]:
        packing.uses.append(({capacity: 1}, int(left[-1])))
        left[-1] = 0
    if left.any():
        for key, amount in sorted(fractional_patterns(left, capacity, rounds).items(), key=lambda x: -x[1]):
            at = np.array([length for length, _ in key]) - 1
            many = np.array([m for _, m in key])
            times = int(min(np.floor(amount + 1e-9), (left[at] // many).min()))
            if times:
                left[at] -= times * many
                packing.uses.append((dict(key), times))
        packing.uses += best_fit(left, capacity)
    return packing


def pack_documents(
    documents: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    pieces = stored(cut_pieces(documents, tokenizer, capacity, end_id), "pieces").withColumn(
        "slice", F.expr(f"pmod(xxhash64(doc_id, piece, ids_crc32), {RANK_SLICES})")
    )
    by_slice = stored(pieces.groupBy("length", "slice").agg(F.count("*").alias("n")), "piece-counts")
    counts = np.zeros(capacity, np.int64)
    for row in by_slice.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[row["length"] - 1] = row["n"]
    places = plan_packing(counts, capacity, rounds).places()

    before = by_slice.select(
        "length",
        "slice",
        (F.sum("n").over(Window.partitionBy("length").orderBy("slice")) - F.col("n")).alias("before"),
    )
    in_slice = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = pieces.join(before, ["length", "slice"]).withColumn("rank", F.col("before") + F.row_number().over(in_slice) - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = places["length"] * (1 << 40) + places["rank"]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            at = np.searchsorted(key, length * (1 << 40) + rank, "right") - 1
            inside = rank - places["rank"][at]
            sequence = places["sequence"][at] + inside // places["many"][at]
            offset = places["offset"][at] + inside % places["many"][at] * length
            columns = [*batch.columns[:5], pa.array(sequence), pa.array(offset)]
            yield pa.record_batch(columns, names=[*batch.schema.names[:5], "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked.select(*columns, "rank").mapInArrow(place, PIECES + ", sequence_id long, offset long")
