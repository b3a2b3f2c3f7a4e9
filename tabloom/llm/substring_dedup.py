"""Removal of byte strings that repeat: prefix doubling over a sample of positions.

Every string of ``LENGTH`` bytes that also starts earlier in the corpus is removed. Sorting
the suffixes at all positions would move the corpus many times over, so positions are
sampled by content: of the ``CORE``-byte strings inside a window of ``LENGTH`` bytes the one
with the smallest hash is the window's anchor, and equal windows have their anchors at the
same offset. About one position in 35 is an anchor.

Anchors are ranked by growing strings around them, and leave as soon as that decides:

1. by their core (hash). A core that is unique decides: none of its windows repeats;
2. by the whole context, all windows of the anchor together. Of equal contexts the
   earliest stays, every window of the others repeats;
3. by single windows, for the earliest ones of contexts that share a core.

Sorting by (core, context, document, position) does the first two steps in one shuffle and
as a stream. Cores that hold more than a fixed share of all anchors are found first; they
go another way, in which Spark takes minima before it shuffles, so that no task gets all
places of a phrase that a third of the corpus holds. Ranks are 64-bit hashes.

Null text is empty. Documents are ordered by doc_id, nulls first, equal ids by a hash of
the text; rows equal in doc_id and text are one document and have equal results.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.common import binary, parallelism, prefix_sums, signed, slices, span_hash, stored
from tabloom.session import work_dir

LENGTH = 100
CORE = 32
SEGMENT = 4 << 20
HEAVY_SHARE = 1e-5
# What one task sorts and streams with ease, whatever share of the anchors it is.
HEAVY_PLACES = 100_000
_PLACE_BITS = np.uint64(24)
_PLACE = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)

ANCHOR = "core long, context long, doc long, at int, low int, high int"
WINDOWS = "doc long, first int, last int"


def segments(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, place of the first byte in it, bytes, offsets): slices, very long rows in
    overlapping parts that have each window once."""
    for at, _, data, offsets in slices(column):
        if len(offsets) > 2 or len(data) <= SEGMENT:
            yield at, 0, data, offsets
            continue
        for begin in range(0, len(data) - LENGTH + 1, SEGMENT):
            part = data[begin : begin + SEGMENT + LENGTH - 1]
            yield at, begin, part, np.array([0, len(part)])


def find_anchors(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Row, place in the row, offsets of the windows that have the anchor, hashes of core and context."""
    size = len(data)
    names = ("row", "at", "low", "high", "core", "context")
    if size < LENGTH:
        return dict.fromkeys(names, np.empty(0, np.int64))
    sums = prefix_sums(data)
    place = np.arange(size - CORE + 1)
    # The place breaks ties: the leftmost of equal hashes is the least.
    value = (span_hash(sums, place, place + CORE) & ~_PLACE) | place.astype(np.uint64)
    least, width, cores = value, 1, LENGTH - CORE + 1
    while 2 * width <= cores:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if cores > width:
        least = np.minimum(least[: len(least) - (cores - width)], least[cores - width :])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    window = np.flatnonzero(row[: size - LENGTH + 1] == row[LENGTH - 1 :])
    anchor = (least[window] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[window[1:]] != row[window[:-1]])])) if len(window) else window
    first, last = window[new], np.concatenate([window[new[1:] - 1], window[-1:]])
    at = anchor[new]
    return {
        "row": row[first],
        "at": at - offsets[row[first]],
        "low": at - last,
        "high": at - first,
        "core": span_hash(sums, at, at + CORE),
        "context": span_hash(sums, first, last + LENGTH),
    }


def anchors(texts: DataFrame, heavy: np.ndarray, only_heavy: bool) -> DataFrame:
    """Anchors whose core is, or is not, in ``heavy`` (sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy()
            for first_row, begin, data, offsets in segments(batch.column(1)):
                found = find_anchors(data, offsets)
                keep = np.isin(found["core"], heavy) == only_heavy
                found = {k: v[keep] for k, v in found.items()}
                columns = [
                    signed(found["core"]),
                    signed(found["context"]),
                    pa.array(docs[first_row + found["row"]]),
                    *(pa.array((found[k] + shift).astype(np.int32)) for k, shift in (("at", begin), ("low", 0), ("high", 0))),
                ]
                yield pa.record_batch(columns, names=["core", "context", "doc", "at", "low", "high"])

    return texts.select("doc", "text").mapInArrow(run, ANCHOR)


def heavy_cores(texts: DataFrame) -> np.ndarray:
    """Every core with more than HEAVY_SHARE of all anchors (and HEAVY_PLACES), sorted: at
    most 2 / HEAVY_SHARE. Tasks report those with half that share of their own anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        held: dict[str, np.ndarray] = {"core": np.empty(0, np.uint64), "n": np.empty(0, np.int64)}
        total = 0

        def merge() -> None:
            core = np.concatenate([held["core"], *parts])
            weight = np.concatenate([held["n"], *(np.ones(len(p), np.int64) for p in parts)])
            held["core"], inverse = np.unique(core, return_inverse=True)
            held["n"] = np.bincount(inverse, weights=weight, minlength=len(held["core"])).astype(np.int64)
            parts.clear()

        waiting = 0
        for batch in batches:
            for _, _, data, offsets in segments(batch.column(0)):
                core = find_anchors(data, offsets)["core"].view(np.uint64)
                parts.append(core)
                total += len(core)
                waiting += len(core)
                if waiting > 1 << 20:
                    merge()
                    waiting = 0
        merge()
        keep = held["n"] >= max(2, HEAVY_SHARE / 2 * total)
        yield pa.record_batch(
            [signed(np.concatenate([held["core"][keep], [np.uint64(0)]])), pa.array(np.concatenate([held["n"][keep], [0]])), pa.array([0] * int(keep.sum()) + [total])],
            names=["core", "n", "total"],
        )

    counts = stored(
        texts.select("text").mapInArrow(run, "core long, n long, total long").groupBy("core").agg(F.sum("n").alias("n"), F.sum("total").alias("total")),
        "core-counts",
    )
    total = counts.agg(F.sum("total")).first()[0] or 0
    heavy = counts.where(F.col("n") >= max(HEAVY_PLACES, HEAVY_SHARE / 2 * total)).select("core").toArrow()
    return np.sort(heavy.column(0).to_numpy().astype(np.int64).view(np.uint64))


def first_ranks(light: DataFrame) -> DataFrame:
    """Steps 1 and 2. ``open`` false: windows first..last of doc repeat. True: (core, doc, at,
    low, high) is the earliest of its context, and other contexts share its core."""
    names = ["open", "core", "doc", "first", "last", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def decide(columns: list[np.ndarray]) -> pa.RecordBatch:
            core, context, doc, at, low, high = columns
            new_core = np.concatenate([[True], core[1:] != core[:-1]])
            new_context = new_core.copy()
            new_context[1:] |= context[1:] != context[:-1]
            number = np.cumsum(new_core) - 1
            contexts = np.bincount(number, weights=new_context)
            # Equal documents count as one place.
            earliest = np.maximum.accumulate(np.where(new_context, np.arange(len(core)), 0))
            repeated = (doc != doc[earliest]) | (at != at[earliest])
            border = new_context & (contexts[number] > 1)
            keep = np.flatnonzero(repeated | border)
            made = [border, core, doc, at - high, at - low, at]
            return pa.record_batch([pa.array(c[keep]) for c in made], names=names)

        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            if not len(columns[0]):
                continue
            # The last core may go on in the next batch.
            whole = int(np.searchsorted(columns[0], columns[0][-1], "left"))
            held = [c[whole:] for c in columns]
            if whole:
                yield decide([c[:whole] for c in columns])
        if held is not None and len(held[0]):
            yield decide(held)

    dealt = light.repartition("core").sortWithinPartitions("core", "context", "doc", "at")
    return dealt.mapInArrow(run, "open boolean, core long, doc long, first int, last int, at int")


def windows_of(texts: DataFrame, open_: DataFrame) -> DataFrame:
    """Beside each open anchor the bytes of its windows: core, doc, first, bytes."""
    places = open_.groupBy("doc").agg(F.collect_list(F.struct("core", "first", "last")).alias("places"))
    joined = texts.select("doc", "text").join(places, "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_ = binary(batch.column(1))
            lists = batch.column(2)
            values, bounds = lists.flatten(), lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            core, first, last = (values.field(i).to_numpy() for i in range(3))
            docs = batch.column(0).to_numpy()
            for low in range(0, len(row), 5000):
                part = slice(low, low + 5000)
                cut, now, text = [], -1, b""
                for r, f, e in zip(row[part].tolist(), first[part].tolist(), last[part].tolist()):
                    if r != now:
                        now, text = r, texts_[r].as_py()
                    cut.append(text[f : e + LENGTH])
                columns = [pa.array(core[part]), pa.array(docs[row[part]]), pa.array(first[part]), pa.array(cut, pa.binary())]
                yield pa.record_batch(columns, names=["core", "doc", "first", "bytes"])

    return joined.mapInArrow(run, "core long, doc long, first int, bytes binary")


def window_hashes(cut: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each window in each row of bytes; its row and place."""
    hashes, rows, places = [], [], []
    for at, _, data, offsets in slices(cut):
        many = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
        row = np.repeat(np.arange(len(many)), many)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        start = offsets[row] + inside
        hashes.append(span_hash(prefix_sums(data), start, start + LENGTH))
        rows.append(row + at)
        places.append(inside)
    empty = np.empty(0, np.int64)
    return np.concatenate(hashes or [empty.view(np.uint64)]), np.concatenate(rows or [empty]), np.concatenate(places or [empty])


def last_ranks(cut: DataFrame) -> DataFrame:
    """Step 3: windows (doc, first, last) that repeat among the open anchors of a core."""

    def decide(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, row, inside = window_hashes(batch.column(3))
        doc, first = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        order = np.lexsort((first[row] + inside, doc[row], hashes))
        again = np.zeros(len(hashes), bool)
        again[order[1:]] = hashes[order[1:]] == hashes[order[:-1]]
        # The same place of equal documents is no repetition.
        place = np.flatnonzero(again)
        edge = np.concatenate([[True], (place[1:] != place[:-1] + 1) | (row[place[1:]] != row[place[:-1]])]) if len(place) else np.empty(0, bool)
        begin = place[edge]
        end = np.concatenate([place[np.flatnonzero(edge)[1:] - 1], place[-1:]]) if len(place) else place
        columns = [doc[row[begin]], (first[row[begin]] + inside[begin]).astype(np.int32), (first[row[end]] + inside[end]).astype(np.int32)]
        return pa.record_batch([pa.array(c) for c in columns], names=["doc", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            core = batch.column(0).to_numpy()
            if held and core[0] != held[-1].column(0)[-1].as_py():
                yield decide(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held = []
            whole = int(np.searchsorted(core, core[-1], "left"))
            if whole:
                yield decide(pa.Table.from_batches([*held, batch.slice(0, whole)]).combine_chunks().to_batches()[0])
                held = []
            held.append(batch.slice(whole))
        if held:
            yield decide(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    dealt = cut.distinct().repartition("core").sortWithinPartitions("core", "doc", "first")
    return dealt.mapInArrow(run, WINDOWS)


def heavy_ranks(texts: DataFrame, heavy: np.ndarray) -> DataFrame:
    """The same steps for heavy cores, as minima: windows (doc, first, last) that repeat."""
    places = stored(anchors(texts, heavy, only_heavy=True).distinct(), "heavy-anchors")
    place = F.struct("doc", "at", "low", "high")
    earliest = stored(places.groupBy("core", "context").agg(F.min(place).alias("e")), "heavy-contexts")
    repeated = places.join(earliest, ["core", "context"]).where("doc <> e.doc OR at <> e.at")
    repeated = repeated.selectExpr("doc", "at - high AS first", "at - low AS last")
    open_ = earliest.selectExpr("core", "e.doc AS doc", "e.at - e.high AS first", "e.at - e.low AS last")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 5000):
                part = batch.slice(low, 5000)
                hashes, row, inside = window_hashes(part.column(3))
                at = part.column(2).to_numpy()[row] + inside
                columns = [signed(hashes), pa.array(part.column(1).to_numpy()[row]), pa.array(at.astype(np.int32))]
                yield pa.record_batch(columns, names=["window", "doc", "first"])

    single = stored(windows_of(texts, open_).mapInArrow(spread, "window long, doc long, first int"), "heavy-windows")
    least = single.groupBy("window").agg(F.min(F.struct("doc", "first")).alias("e"), F.count("*").alias("n")).where("n > 1")
    later = single.join(least, "window").where("doc <> e.doc OR first <> e.first")
    return repeated.unionByName(later.selectExpr("doc", "first", "first AS last"))


def keyed_texts(documents: DataFrame) -> DataFrame:
    """doc_id, doc, text, once for equal rows; ``doc`` orders them. It is the doc_id itself
    unless ids are null or repeat."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    odd = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").limit(1).count()
    if not odd:
        return rows.withColumn("doc", F.col("doc_id"))
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    order = hashed.select("doc_id", "hash").distinct().orderBy(F.col("doc_id").asc_nulls_first(), "hash")
    spark = documents.sparkSession
    numbered = order.rdd.zipWithIndex().map(lambda pair: (pair[0][0], pair[0][1], pair[1]))
    numbers = stored(spark.createDataFrame(numbered, "id long, h long, doc long"), "document-order")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h"))
    return hashed.join(numbers, same).select("doc_id", "text", "doc")


def bucketed(texts: DataFrame, buckets: int) -> DataFrame:
    """The texts as a table in ``buckets`` by doc, so that what is joined with them is moved
    and they are not."""
    spark = texts.sparkSession
    name = f"texts_{uuid.uuid4().hex}"
    dealt = texts.repartition(buckets, "doc")
    dealt.write.option("path", work_dir(spark, "texts")).option("compression", "zstd").bucketBy(buckets, "doc").saveAsTable(name)
    return spark.table(name)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    texts = bucketed(keyed_texts(documents), parallelism(documents.sparkSession))
    heavy = heavy_cores(texts)
    ranked = stored(first_ranks(anchors(texts, heavy, only_heavy=False)), "ranked-anchors")
    repeated = ranked.where("NOT open").select("doc", "first", "last")
    repeated = repeated.unionByName(last_ranks(windows_of(texts, ranked.where("open"))))
    if len(heavy):
        repeated = repeated.unionByName(heavy_ranks(texts, heavy))
    by_doc = repeated.groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("windows"))
    joined = texts.join(by_doc, "doc", "left").select("doc_id", "text", "windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            values = binary(batch.column(1))
            for doc_id, text, windows in zip(batch.column(0).to_pylist(), values, batch.column(2)):
                data = text.as_py()
                if not windows.is_valid:
                    rows.append((doc_id, len(data), 0, 0, hashlib.sha256(data).hexdigest()))
                    continue
                first, last = (windows.values.field(i).to_numpy() for i in range(2))
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, first, 1)
                np.add.at(edge, last + LENGTH, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.string()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return joined.mapInArrow(run, RESULT)
