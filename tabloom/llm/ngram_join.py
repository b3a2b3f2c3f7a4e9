"""N-gram Jaccard join by a prefix tree: near-duplicate documents and their components.

A document is the set of its distinct word n-grams, each a 64-bit hash. Ranges of hashes
cut a set into parts, more of them than two similar sets can differ in entries. So similar
sets have some parts that are wholly equal, and meet in blocks, one for each part that two
sets or more have; parts with the same sets share one. Of the parts a set may leave out as
many as there are beyond the least; it leaves out those with the fewest entries that are
not common. What sets share here and there, like frequent phrases, makes no block. A block
beyond ``block_sets`` is cut into slices, and every two slices meet in a block of their own,
so no task holds more and no pair is lost.

A set first brings only its size and the counts of its entries by hash class. Differences
of these counts bound the overlap of two sets; who has no possible partner in a block
leaves it. The texts of those that stay are brought together, and a prefix tree of their
ordered sets yields the similar pairs exactly.

Sets that blocks connect, directly or by others, usually are few; then they meet once, all
together. Larger families are joined beforehand by their smallest hashes under a few
orders, one block for each; of their blocks those are left out all of whose sets are
connected by then. Only pairs that connect what was not yet connected are emitted.

Equal sets are one node; its key is 64 bits of the set's hashes. Null texts and texts
without a word have an empty set, linked with nothing. Null doc_ids never name a
component unless all of its documents have none; rows that repeat a doc_id are judged each
by its text. ``row_key``, 64 bits of doc_id and text, tells rows apart that are not equal in
both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.llm.common import (
    LOWER, byte_class, find_words, lists, mix, prefix_sums, row_bounds, shingles, signed, slices, span_hash, stored,
)
from tabloom.llm.components import connected_components
from tabloom.llm.prefix_tree import least_overlap, linking_pairs

SIZE = 3
PERCENT = 90
BLOCK_SETS = 2048
COMMON_SETS = 64
COMMON_ENTRIES = 1_000_000
COUNTED_TOGETHER = 1 << 20
ORDERS = 2
LEAST_CLASSES = 64
ENTRIES_A_CLASS = 16
_WORD = ~byte_class((9, 13), (32, 32))


def document_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Each row's distinct n-grams, by value."""
    lowered = LOWER[data]
    start, end, row = find_words(lowered, offsets, _WORD)
    hashes, bounds = shingles(span_hash(prefix_sums(lowered), start, end), row_bounds(row, len(offsets) - 1), size)
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield np.unique(hashes[low:high])


def set_key(entries: np.ndarray) -> int:
    """64 bits that stand for the set."""
    return int((mix(entries).sum(dtype=np.uint64) ^ mix(np.uint64([len(entries)]))[0]).view(np.int64))


def row_key() -> Column:
    return F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull()).alias("row_key")


def most_apart(n: int, percent: int) -> int:
    """How many entries two similar sets of ``n`` entries together can have that the other lacks."""
    return n * (100 - percent) // (100 + percent)


def part_keys(entries: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """Keys of parts of a set: similar sets that are not equal share at least one.

    The size of the larger set, up to a power of two, fixes the parts; the smaller one may
    lie below it and has keys for both. With sizes n and m at most ``most_apart(n + m)``
    parts differ. Any order of the parts by their content alone serves: the last of the equal
    parts of two sets is left out by neither."""
    n = len(entries)
    largest = 100 * n // percent
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(entries)])
    rare = ~is_among(entries, common)
    keys = [np.empty(0, np.uint64)]
    top = 1
    while top < n:
        top *= 2
    while n and top < 2 * largest:
        differ = most_apart(n + min(top, largest), percent)
        if differ:
            most = most_apart(2 * top, percent)
            parts = most + 2 + most // 4
            part = ((entries >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            edges = np.searchsorted(part, np.arange(parts + 1))
            key = mix(sums[edges[1:]] - sums[edges[:-1]] + mix(np.arange(parts, dtype=np.uint64) + np.uint64(top << 32)))
            weight = np.minimum(np.bincount(part, weights=rare, minlength=parts), 255).astype(np.uint64)
            keys.append(key[np.argsort(weight << np.uint64(56) | key >> np.uint64(8))[-differ - 1 :]])
        top *= 2
    return np.concatenate(keys)


def is_among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def common_entries(documents: DataFrame, size: int, limit: int = COMMON_ENTRIES) -> np.ndarray:
    """Hashes that stand in many documents, sorted. At most ``limit``: what is asked of an
    entry grows with the number of entries counted. A task reports the entries it meets more
    than once among those it counts together. Any choice joins the same; this one makes blocks small."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def repeated() -> pa.RecordBatch:
            entry, n = np.unique(np.concatenate([np.empty(0, np.uint64), *held]), return_counts=True)
            return pa.record_batch([signed(entry[n > 1]), pa.array(n[n > 1])], names=["entry", "n"])

        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                sets = list(document_sets(data, offsets, size))
                held += sets
                waiting += sum(map(len, sets))
                if waiting > COUNTED_TOGETHER:
                    yield repeated()
                    held, waiting = [], 0
        yield repeated()

    counts = documents.select("text").mapInArrow(count, "entry long, n long").groupBy("entry").agg(F.sum("n").alias("n"))
    counts = stored(counts.where(F.col("n") >= COMMON_SETS), "entry-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    common = counts.where(F.col("n") >= -(-total // limit)).select("entry").toArrow()
    return np.sort(common.column(0).to_numpy().astype(np.int64).view(np.uint64))


def class_counts(entries: np.ndarray) -> bytes:
    """How many entries fall in each hash class. Large sets have more classes, in powers of
    two, so that a class holds few: only then do the counts tell sets apart."""
    classes = LEAST_CLASSES
    while classes * ENTRIES_A_CLASS < len(entries):
        classes *= 2
    counts = np.bincount((entries & np.uint64(classes - 1)).astype(np.int64), minlength=classes)
    return np.minimum(counts, 255).astype("u1").tobytes()


def fold(counts: np.ndarray, classes: int) -> np.ndarray:
    """Counts by half as many classes, and so on."""
    while len(counts) > classes:
        counts = counts[: len(counts) // 2] + counts[len(counts) // 2 :]
    return counts


def describe(documents: DataFrame, common: np.ndarray, size: int, percent: int) -> DataFrame:
    """doc_id, row_key, n, node, keys of its parts (of equal sets one of a task at least has
    them), smallest hash under each order, class counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at, end, data, offsets in slices(batch.column(1)):
                sets = list(document_sets(data, offsets, size))
                nodes, keys, least = [], [], []
                for s in sets:
                    node = set_key(s) if len(s) else None
                    nodes.append(node)
                    keys.append(np.empty(0, np.uint64) if node in seen else part_keys(s, common, percent))
                    seen.add(node)
                    least.append([mix(s ^ np.uint64(k + 1)).min() for k in range(ORDERS)] if len(s) else [])
                bounds = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
                least_bounds = np.concatenate([[0], np.cumsum([len(k) for k in least])])
                columns = [
                    batch.column(0).slice(at, end - at),
                    batch.column(2).slice(at, end - at),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(nodes, pa.int64()),
                    lists(signed(np.concatenate(keys)), bounds),
                    lists(signed(np.array(sum(least, []), np.uint64)), least_bounds),
                    pa.array([class_counts(s) for s in sets], pa.binary()),
                ]
                yield pa.record_batch(columns, names=["doc_id", "row_key", "n", "node", "keys", "least", "classes"])

    schema = "doc_id long, row_key long, n long, node long, keys array<long>, least array<long>, classes binary"
    return documents.select("doc_id", "text", row_key()).mapInArrow(run, schema)


def contents(documents: DataFrame, nodes: DataFrame, described: DataFrame) -> DataFrame:
    """node, text: the text of one document for each of ``nodes``."""
    chosen = described.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("row_key").alias("row_key"))
    rows = documents.select(row_key(), "text").join(chosen, "row_key")
    return rows.dropDuplicates(["row_key"]).select("node", "text")


def slice_blocks(members: DataFrame, most: int, every_pair: bool) -> DataFrame:
    """(block, node) with blocks of two to about ``most`` nodes. Larger blocks are cut: into
    slices that each also hold the block's smallest node, or, for ``every_pair``, so that
    every two of its nodes meet."""
    sizes = members.groupBy("block").agg(F.count("*").alias("size"), F.min("node").alias("hub")).where("size > 1")
    half = most // 2 if every_pair else most
    cut = members.join(sizes, "block").withColumn("slices", F.ceil(F.col("size") / F.when(F.col("size") <= most, most).otherwise(half)))
    cut = cut.withColumn("slice", F.pmod(F.xxhash64("node", "block"), "slices"))
    if not every_pair:
        hubs = sizes.where(F.col("size") > most).select(
            F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / half) - 1)).alias("slice"), "block", F.col("hub").alias("node")
        )
        rows = cut.select("slice", "block", "node").unionByName(hubs)
        return rows.select(F.xxhash64("block", "slice").alias("block"), "node").distinct()
    whole = cut.where("slices = 1").select("block", "node")
    other = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1), lambda k: k != F.col("slice")))
    met = cut.where("slices > 1").select("block", "node", "slice", other.alias("other"))
    met = met.select(F.xxhash64("block", F.least("slice", "other"), F.greatest("slice", "other")).alias("block"), "node")
    return whole.unionByName(met)


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block, from batches sorted by their first column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        block = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for low, high in zip(edges[:-1], edges[1:]):
            if high == low:
                continue
            if held and held[-1].column(0)[0].as_py() != block[low]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


def possible_members(blocks: DataFrame, facts: DataFrame, percent: int, groups: DataFrame | None = None) -> DataFrame:
    """(block, node) of nodes that sizes and class counts leave a partner in the block, one of
    another component where ``groups`` (node, component) tells. ``facts``: node, n, classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_block(batches):
            n = rows.column("n").to_numpy()
            order = np.argsort(n, kind="stable")
            n = n[order]
            group = rows.column("component").to_numpy()[order]
            counts = [np.frombuffer(c.as_py(), "u1").astype(np.int32) for c in rows.column("classes").take(pa.array(order))]
            width = np.array([len(c) for c in counts])
            partner = np.zeros(len(n), bool)
            # Sizes ascend, and widths with them: k meets sets of its width or larger ones, folded.
            for classes in np.unique(width).tolist():
                begin, own = (int(np.searchsorted(width, classes, side)) for side in ("left", "right"))
                stop = int(np.searchsorted(n, 100 * n[own - 1] // percent, "right"))
                table = np.stack([fold(c, classes) for c in counts[begin:stop]])
                for k in range(begin, own):
                    end = min(int(np.searchsorted(n, 100 * n[k] // percent, "right")), stop)
                    if end <= k + 1:
                        continue
                    room = n[k] + n[k + 1 : end] - 2 * least_overlap(n[k], n[k + 1 : end], percent)
                    other = np.flatnonzero(group[k + 1 : end] != group[k])
                    if not len(other):
                        continue
                    close = np.zeros(end - k - 1, bool)
                    close[other] = np.abs(table[k + 1 - begin + other] - table[k - begin]).sum(axis=1) <= room[other]
                    if close.any():
                        partner[k] = True
                        partner[k + 1 : end] |= close
            kept = pa.array(order[partner])
            yield pa.record_batch([rows.column(i).take(kept).combine_chunks() for i in range(2)], names=["block", "node"])

    rows = blocks.join(facts, "node")
    rows = rows.join(groups, "node", "left") if groups is not None else rows.withColumn("component", F.col("node"))
    rows = rows.select("block", "node", "n", F.coalesce("component", "node").alias("component"), "classes")
    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(run, "block long, node long")


def links(blocks: DataFrame, texts: DataFrame, groups: DataFrame | None, size: int, percent: int) -> DataFrame:
    """u, v: similar pairs that connect the nodes of each block beyond ``groups`` (node, component)."""
    rows = blocks.join(groups, "node", "left") if groups is not None else blocks.withColumn("component", F.col("node"))
    rows = rows.select("block", "node", F.coalesce("component", "node").alias("component")).join(texts, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_block(batches):
            nodes = rows.column("node").to_numpy()
            sets = [s for _, _, data, offsets in slices(rows.column("text")) for s in document_sets(data, offsets, size)]
            own = [k for k, s in enumerate(sets) if set_key(s) == nodes[k]]
            group = rows.column("component").to_numpy()[own]
            found = linking_pairs([sets[k] for k in own], group, percent) if len(own) > 1 else []
            pairs = np.array([(nodes[own[i]], nodes[own[j]]) for i, j in found], np.int64).reshape(-1, 2)
            yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    dealt = rows.select("block", "node", "component", "text").repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, "u long, v long").distinct()


def same_members(members: DataFrame) -> DataFrame:
    """(block, node), one block for entries that have the same nodes; blocks have two at least."""
    of_entry = members.groupBy("entry").agg(
        F.count("*").alias("sets"),
        F.bit_xor(F.xxhash64("node")).alias("mark"),
        F.sum(F.col("node") % (1 << 40)).alias("sum"),
    )
    chosen = of_entry.where("sets > 1").groupBy("sets", "mark", "sum").agg(F.min("entry").alias("entry")).select("entry")
    return members.join(chosen, "entry", "left_semi").select(F.col("entry").alias("block"), "node")


def label_documents(documents: DataFrame, size: int, percent: int, block_sets: int = BLOCK_SETS) -> DataFrame:
    """doc_id, row_key, n_shingles, component: a node of the component, null without shingles."""
    common = common_entries(documents, size)
    described = stored(describe(documents, common, size, percent), "sets")
    entries = described.select(F.explode("keys").alias("entry"), "node")
    of_entry = Window.partitionBy("entry")
    shared = entries.withColumns({"low": F.min("node").over(of_entry), "high": F.max("node").over(of_entry)}).where("low <> high")
    members = stored(shared.select("entry", "node").distinct(), "entry-sets")
    meeting = members.select("node").distinct()
    facts = described.join(meeting, "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("classes").alias("classes"))
    facts = stored(facts, "set-facts")
    blocks = slice_blocks(same_members(members), block_sets, every_pair=True)
    close = stored(possible_members(blocks, facts, percent), "possible-members")
    nodes = stored(close.select("node").distinct(), "possible-nodes")
    texts = stored(contents(documents, nodes, described), "set-texts")

    # Nodes that blocks connect, directly or not, are brought together once where they are few.
    hubs = close.groupBy("block").agg(F.min("node").alias("hub"))
    reach = stored(connected_components(close.join(hubs, "block").select(F.col("node").alias("u"), F.col("hub").alias("v"))), "reach")
    sizes = reach.groupBy("component").agg(F.count("*").alias("size"))
    small = reach.join(sizes.where(F.col("size") <= block_sets), "component").select(F.col("component").alias("block"), "node")
    large = stored(reach.join(sizes.where(F.col("size") > block_sets), "component").select("node"), "large-reach")

    by_least = described.join(large, "node", "left_semi").select(F.posexplode("least").alias("order", "least"), "node").distinct()
    early = slice_blocks(by_least.select(F.xxhash64("order", "least").alias("block"), "node"), block_sets, every_pair=False)
    first_links = stored(links(small.unionByName(early), texts, None, size, percent), "links")
    groups = stored(connected_components(first_links), "groups")

    grouped = close.join(large, "node", "left_semi").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = grouped.groupBy("block").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    open_ = close.join(mixed.select("block"), "block", "left_semi").withColumnRenamed("block", "entry")
    # Most partners are connected by now: texts meet only where one of another component is possible.
    apart = stored(possible_members(same_members(open_), facts, percent, groups), "apart")
    more_links = stored(links(apart, texts, groups, size, percent), "links")
    components = connected_components(first_links.unionByName(more_links))

    return described.join(components, "node", "left").select(
        "doc_id", "row_key", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component")
    )


def join_documents(
    documents: DataFrame, size: int = SIZE, percent: int = PERCENT, block_sets: int = BLOCK_SETS
) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable by links."""
    labelled = label_documents(documents, size, percent, block_sets).drop("row_key")
    linked = labelled.where("n_shingles > 0")
    smallest = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return (
        linked.join(smallest, "component")
        .select("doc_id", "n_shingles", "component_id")
        .unionByName(labelled.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    )


def one_of_each(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows, with all their columns, of one document of every component: one row of its
    smallest doc_id, of a null one only if all are null. Of several such rows the smallest
    row_key decides, then the hash of all columns. Rows without words all stay."""
    labelled = stored(label_documents(documents, size, percent).select("doc_id", "row_key", "n_shingles", "component"), "labelled")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")
    chosen = labelled.where("n_shingles > 0").groupBy("component").agg(F.min(order).alias("least")).select("least.row_key")
    copies = labelled.groupBy("row_key").agg(F.count("*").alias("copies"), F.max("n_shingles").alias("n_shingles"))
    kept = chosen.join(copies, "row_key").select("row_key", (F.col("copies") > 1).alias("repeated"))
    kept = stored(kept.unionByName(copies.where("n_shingles = 0").select("row_key", F.lit(False).alias("repeated"))), "kept")
    rows = documents.select(row_key(), F.struct(*documents.columns).alias("row")).join(kept, "row_key")
    # Rows are joined, not aggregated; only those equal in doc_id and text are compared as a whole.
    least = rows.where("repeated").groupBy("row_key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return rows.where("NOT repeated").select("row.*").unionByName(least.select("row.*"))
