"""Benchmark decontamination by spaced seeds, in DataFrame operations alone.

A mask chooses some of the words of a window and ignores the others. Windows of documents
and of benchmark items that agree in the chosen words share a key; so copies in which
words were exchanged still meet, at places where the exchanged ones fall between. Every
place where keys meet fixes an alignment of the document with an item; along it words are
compared, and the document is contaminated if some ``WINDOW`` words of the item (all, if
it is shorter) have ``PERCENT`` per cent equal.

No such copy is missed: the masks of an item are chosen so that, wherever the words lie
that the rule lets differ, one mask reads equal words only (a test goes through all
patterns). Short items, with fewer words to spare, have masks of their own. Items of fewer
than ``LEAST_WORDS`` are too short to search for. Null and empty texts have no words and
contain nothing. Rows that repeat a doc_id are judged each by its text, equal rows alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 16
PERCENT = 75
LEAST_WORDS = 5
# Word positions that each mask reads, for items of so many words or more. They belong to
# WINDOW and PERCENT: 4 of 16 words may differ, 3 of 12 to 15, 2 of 8 to 11, 1 of 5 to 7.
MASKS = {
    15: [[0, 1, 3, 4, 5], [0, 1, 3, 8, 9], [0, 2, 11, 12, 13]],
    12: [[0, 2, 3, 4], [0, 3, 6, 8]],
    8: [[0, 1, 3, 4], [0, 1, 6, 7], [0, 2, 3, 5]],
    LEAST_WORDS: [[0, 1, 2, 3], [0, 1, 3, 4], [0, 1, 2, 4], [0, 2, 3, 4]],
}
# Words before and behind the start of a mask that a passing run around it can reach.
REACH = WINDOW - 1
# Places of a text that are handled together, so that no row holds a whole long text.
PIECE = 64
# An item's key stands beside 31 hashes, so this many take about 60 MB when broadcast.
BROADCAST_KEYS = 200_000


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.xxhash64(w))


def mask_group(n: int) -> int:
    """The key in ``MASKS`` for items of ``n`` words."""
    return max(least for least in MASKS if least <= n)


def window_keys(words: Column, place: Column, group: int) -> list[Column]:
    """A key for each mask of the window that begins at ``place``; null where it does not fit."""
    keys = []
    for mask in MASKS[group]:
        read = [F.get(words, place + F.lit(offset)) for offset in mask]
        keys.append(F.when(read[-1].isNotNull(), F.xxhash64(F.lit(group), *map(F.lit, mask), *read)))
    return keys


def keyed(rows: DataFrame, groups: list[int]) -> DataFrame:
    """Every (row, place, key) by the masks of ``groups``. ``n_words`` is the length of the text;
    of its ``words`` those of one piece stay, from ``base`` on, and ``REACH`` on either side."""
    least = min((len(mask) for group in groups for mask in MASKS[group]), default=LEAST_WORDS)
    n_words, first, base = F.col("n_words"), F.col("first"), F.col("base")
    pieces = rows.withColumn("n_words", F.size("words")).where(n_words >= least)
    pieces = pieces.withColumn("first", F.explode(F.sequence(F.lit(0), n_words - 1, F.lit(PIECE))))
    pieces = pieces.withColumn("base", F.greatest(first - REACH, F.lit(0)))
    pieces = pieces.withColumn("words", F.slice("words", base + 1, F.lit(PIECE + 2 * REACH)))
    places = pieces.withColumn("place", F.explode(F.sequence(first, F.least(first + PIECE, n_words) - 1)))
    keys = [key for group in groups for key in window_keys(F.col("words"), F.col("place") - base, group)]
    return places.withColumn("key", F.explode(F.array(*keys).cast("array<bigint>"))).where("key IS NOT NULL")


def around(unrolled: bool) -> Column:
    """The words a run through ``place`` can reach, null beyond the ends of the text. Unrolled it
    is compiled, for every place of a table; as a loop it leaves the code around it compiled."""
    word = lambda k: F.get("words", F.col("place") - F.col("base") + k)
    return F.array(*map(word, range(-REACH, REACH + 1))) if unrolled else F.transform(F.sequence(F.lit(-REACH), F.lit(REACH)), word)


def agreement(mine: Column, theirs: Column) -> Column:
    """Bit k tells whether the k-th words of two lists of ``around`` are equal."""
    bits = [F.when(F.get(mine, F.lit(k)) == F.get(theirs, F.lit(k)), F.lit(1 << k)).otherwise(F.lit(0)) for k in range(2 * REACH + 1)]
    return reduce(Column.__add__, bits)


def find_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, first_word, end_word: where documents follow an item.

    Every passing run of words has a place where keys meet, and all of it lies within
    ``REACH`` words of that place. So the words around a meeting are compared on the spot,
    into one number: texts that share a phrase with many items, many times over, make many
    meetings but few rows that outlive the join. While the keys of the items are few, places
    without any are left out first and the items are broadcast. Beyond ``BROADCAST_KEYS`` both sides are
    shuffled by key, each place with the words around it only; a key that stands for much of
    the data is split by adaptive execution.
    """
    items = benchmark.where("item_id IS NOT NULL").select("item_id", word_hashes(F.col("text")).alias("words")).distinct()
    items = items.where(F.size("words") >= LEAST_WORDS)
    # At most WINDOW lengths.
    lengths = items.select(F.least(F.size("words"), F.lit(WINDOW)).alias("n")).distinct().collect()
    groups = sorted({mask_group(r["n"]) for r in lengths})
    theirs = [F.col("n_words").alias("item_words"), F.col("place").alias("item_place"), around(unrolled=True).alias("theirs")]
    item_keys = keyed(items.limit(0), [LEAST_WORDS]).select("key", "item_id", *theirs)
    for group in groups:
        above = min((least for least in MASKS if least > group), default=None)
        of_group = items.where(F.size("words") >= group) if above is None else items.where(F.size("words").between(group, above - 1))
        item_keys = item_keys.unionByName(keyed(of_group, [group]).select("key", "item_id", *theirs))
    item_keys = item_keys.distinct()

    words = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), word_hashes(F.col("text")).alias("words"))
    places = keyed(words, groups)
    small = item_keys.count() <= BROADCAST_KEYS
    if small:
        places = places.join(F.broadcast(item_keys.select("key").distinct()), "key", "left_semi")
    slim = places.select("key", "doc_id", "text_hash", "place", "n_words", around(unrolled=not small).alias("mine"))
    hits = slim.join(F.broadcast(item_keys), "key") if small else slim.hint("merge").join(item_keys, "key")
    run = F.least(F.lit(WINDOW), F.col("item_words"))
    shift = F.col("place") - F.col("item_place")
    likely = hits.withColumn("same", agreement(F.col("mine"), F.col("theirs"))).where(F.bit_count("same") * 100 >= PERCENT * run).select(
        "doc_id", "text_hash", "item_id", run.alias("run"), F.greatest(F.lit(0), shift).alias("first_word"),
        F.least(shift + F.col("item_words"), F.col("n_words")).alias("end_word"), "same",
    )
    windows = [F.bit_count(F.col("same").bitwiseAND(F.lit(((1 << WINDOW) - 1) << k))) for k in range(REACH + 1)]
    best = likely.groupBy("doc_id", "text_hash", "item_id", "run", "first_word", "end_word").agg(F.max(F.greatest(*windows)).alias("equal"))
    return best.where(F.col("equal") * 100 >= PERCENT * F.col("run")).select("doc_id", "text_hash", "item_id", "first_word", "end_word")


def mark_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each row of ``documents`` with all its columns in ``row``, and what it shares with items."""
    leaks = find_leaks(documents, benchmark).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("item_id", "first_word", "end_word"))).alias("found")
    )
    rows = documents.select(F.struct(*documents.columns).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    return rows.join(leaks, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left").select("row", "found")


def report_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, items (sorted item_id list) and spans (item:first word:end word)."""
    found = mark_leaks(documents.select("doc_id", "text"), benchmark)
    items = F.array_distinct(F.transform("found", lambda s: s["item_id"]))
    spans = F.transform("found", lambda s: F.concat_ws(":", s["item_id"], s["first_word"], s["end_word"]))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("found").isNotNull().alias("contaminated"),
        F.coalesce(F.size(items), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join(items, ","), F.lit("")).alias("items"),
        F.coalesce(F.array_join(spans, ","), F.lit("")).alias("spans"),
    )


def drop_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, that share nothing with an item."""
    leaks = find_leaks(documents, benchmark).select("doc_id", "text_hash").distinct()
    hashed = documents.select(F.struct(*documents.columns).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("row.text") == F.col("text_hash"))
    return hashed.join(leaks, same, "left_anti").select("row.*")
