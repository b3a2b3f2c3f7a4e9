"""Document fingerprints: one-permutation MinHash with optimal densification.

A text's five-word shingles are hashed once; the top bits of a hash choose its bin, each
bin keeps its smallest hash. An empty bin copies the bin that a fixed random sequence,
its own, reaches first among the filled ones. Of every bin only the low ``BITS`` bits are
stored. Two fingerprints agree in a bin by chance with probability 2^-BITS, which
``likeness`` takes out again.

A text without words has an empty fingerprint, equal only to another such. Null text is
empty. Null or repeated doc_ids stay rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.common import (
    LOWER, SLICE_BYTES, byte_class, find_words, mix, parallelism, prefix_sums, row_bounds, shingles, span_hash,
)

SHINGLE_WORDS = 5
BINS = 256
BITS = 4
TRIES = 1024
WORD = byte_class((48, 57), (97, 122), (128, 255))


def _detours() -> np.ndarray:
    """For every bin the sequence of bins it asks when it is empty."""
    seeds = np.arange(BINS * TRIES, dtype=np.uint64).reshape(BINS, TRIES)
    return (mix(seeds + np.uint64(0x5851F42D4C957F2D)) % np.uint64(BINS)).astype(np.int64)


_DETOURS = _detours()


def densify(filled: np.ndarray, values: np.ndarray) -> None:
    """Give empty bins the value of a filled bin of their row, in place; rows have one at least."""
    row, empty = np.nonzero(~filled)
    for k in range(TRIES):
        if not len(row):
            return
        ask = _DETOURS[empty, k]
        found = filled[row, ask]
        values[row[found], empty[found]] = values[row[found], ask[found]]
        row, empty = row[~found], empty[~found]
    for r, b in zip(row, empty):
        values[r, b] = values[r, np.flatnonzero(filled[r])[b % filled[r].sum()]]


def fingerprint_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Low bits of every bin (rows x BINS), and which rows have any shingle."""
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = LOWER[np.frombuffer(b"".join(texts), np.uint8)]
    start, end, row = find_words(data, offsets, WORD)
    hashes, bounds = shingles(span_hash(prefix_sums(data), start, end), row_bounds(row, len(texts)), SHINGLE_WORDS)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    bins = (hashes >> np.uint64(56)).astype(np.int64) * BINS // 256
    values = np.full(len(texts) * BINS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(values, owner * BINS + bins, mix(hashes) >> np.uint64(1))
    values = values.reshape(-1, BINS)
    filled = values != np.iinfo(np.uint64).max
    some = filled.any(axis=1)
    dense = values[some]
    densify(filled[some], dense)
    out = np.zeros((len(texts), BINS), np.uint8)
    out[some] = (dense & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return out, some


def packed(bins: np.ndarray, some: np.ndarray) -> list[str]:
    bits = (bins[:, :, None] >> np.arange(BITS - 1, -1, -1, dtype=np.uint8)) & 1
    rows = np.packbits(bits.reshape(len(bins), -1), axis=1)
    return [r.tobytes().hex() if s else "" for r, s in zip(rows, some)]


def likeness(a: np.ndarray, a_some: np.ndarray, b: np.ndarray, b_some: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity, without the agreement that chance gives."""
    chance = 2.0**-BITS
    similar = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)
    return np.where(a_some & b_some, similar, (a_some == b_some).astype(float))


def range_of(column: Column, splits: list[int], low: int = 0) -> Column:
    """How many splits lie below the value, by halving; null is below all."""
    if not splits:
        return F.lit(low)
    middle = len(splits) // 2
    above = range_of(column, splits[middle + 1 :], low + middle + 1)
    return F.when(column > splits[middle], above).otherwise(range_of(column, splits[:middle], low))


def with_neighbours(documents: DataFrame, ranges: int) -> DataFrame:
    """doc_id, text, range, own: each range of doc_ids also holds, not its own, the last
    document of the range before it (the first range: of the last one)."""
    doc_id = F.col("doc_id")
    points = documents.select(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10_000)).first()[0]
    placed = documents.select("doc_id", "text").withColumn("range", range_of(doc_id, sorted(set(points or []))))
    last = sorted(
        (r["range"], r["last"]) for r in placed.groupBy("range").agg(F.max("doc_id").alias("last")).collect()
    )  # a row for each range
    if not last:
        return placed.withColumn("own", F.lit(True))
    following = [r for r, _ in last[1:]] + [last[0][0]]
    spark = documents.sparkSession
    edges = spark.createDataFrame(
        [(end, r, to) for (r, end), to in zip(last, following)], "edge long, range int, target int"
    )
    copies = placed.join(F.broadcast(edges), "range").where(doc_id.eqNullSafe(F.col("edge")))
    context = copies.select("doc_id", "text", F.col("target").alias("range"), F.lit(False).alias("own"))
    return placed.withColumn("own", F.lit(True)).unionByName(context)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (range, own, doc_id, text): before each own row stands the next document."""
    next_text, next_print = "", None
    for batch in batches:
        doc_ids, own = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        texts = [t or "" for t in batch.column(1).to_pylist()]
        sizes = np.cumsum([len(t) for t in texts])
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, "right")))
            part = texts[at:end]
            edited = []
            for text, following in zip(part, [next_text, *part]):
                half = len(text) // 2
                edited.append((text[: len(text) - half] + following[:half]).encode())
            bins, some = fingerprint_texts([t.encode() for t in part])
            edited_bins, edited_some = fingerprint_texts(edited)
            before, before_some = next_print if next_print else (bins[:1], some[:1])
            near_next = likeness(bins, some, np.vstack([before, bins[:-1]]), np.concatenate([before_some, some[:-1]]))
            near_edited = likeness(bins, some, edited_bins, edited_some)
            next_text, next_print = part[-1], (bins[-1:], some[-1:])
            keep = pa.array(own[at:end])
            columns = [
                pa.array(doc_ids[at:end], pa.int64()),
                pa.array([len(t) for t in part], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
                pa.array(packed(bins, some), pa.string()),
                pa.array(packed(edited_bins, edited_some), pa.string()),
                pa.array(near_edited, pa.float64()),
                pa.array(near_next, pa.float64()),
            ]
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pa.record_batch(columns, names=names).filter(keep)
            at = end


def fingerprint_documents(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text: the second half replaced by the
    beginning of the next document in descending doc_id order (ties: descending text).

    One shuffle, by ranges of doc_id; a task reads its range as a stream.
    """
    ranges = ranges or 4 * parallelism(documents.sparkSession)
    placed = with_neighbours(documents, ranges).repartition(ranges, "range")
    ordered = placed.sortWithinPartitions("range", "own", F.col("doc_id").asc_nulls_first(), "text")
    return ordered.select("doc_id", "text", "own").mapInArrow(_describe, SCHEMA)
