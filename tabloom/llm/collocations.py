"""Phrase collocations: the best-bound phrases are grown first, until the best ones are settled.

Texts are cut at ``. , ; : ! ?`` and line ends into pieces, pieces at spaces and tabs into words
(A-Z in lower case). A phrase of 2 to 4 words that occurs ``a`` >= ``least`` times in a language
is a candidate. Cut after k words it has parts that occur l and r times and the score
floor(2000000 a / (l + r)); its lowest cut counts. It is dropped if a longer candidate that
contains it occurs at least ``absorbed`` per cent as often. Each language keeps its ``top``
candidates by score, occurrences and text.

Phrases grow as a tree of prefixes. With P a prefix and x its first word, no phrase that begins
with P scores more than floor(2000000 f(P) / (f(x) + f(P))): its first cut has l = f(x), and
neither a nor a greater r can do better. Words and pairs are counted in full; from then on
a round takes the open prefixes with the highest bounds, at most ``frontier`` of them, and counts
in one pass over the texts what follows and what precedes them, which tells both how
they grow and whether they are absorbed. The score of the ``top``-th phrase known to stay is
a floor that only rises; prefixes bounded below it are never opened. When no open prefix of
a language reaches its floor, every phrase at or above the floor, ties included, is known.

Counts are combined in tasks and shuffled by phrase, so frequent words and languages meet nowhere
whole. Tasks are sent the frontier and a bitmap of 2^23 bits of frequent words, both of fixed
size. Words are told apart by 64-bit hashes of language and text. Every stage's rows are tables
in the shared folder. Null text is empty, null language is ``und``; repeated rows count each;
an empty table gives no rows. Arithmetic is in decimals and exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.llm.common import LOWER, byte_class, find_words, mix, parallelism, prefix_sums, signed, slices, span_hash, stored

WORD = byte_class((0, 8), (14, 31), (33, 255))
BREAK = byte_class((10, 13))
for _sign in b".,;:!?":
    WORD[_sign], BREAK[_sign] = False, True

# Phrases held back to be combined, and bytes of text read at a time: what a task needs beside its batch.
FLUSH = 1 << 19
READ_BYTES = 1 << 18
FRONTIER = 200_000
WORD_BITS = 1 << 23
KEY_BITS = 1 << 22
SCALE = 2_000_000
BOUND_STEP = 1000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def joined_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _MULTIPLIER + right)


def _language_key(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little") | 1


class Tokens:
    """Words of a slice of texts: keys of (language, word), and which follow the one before in their piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, language: np.ndarray):
        low = LOWER[data]
        self.data = low
        self.start, self.end, self.row = find_words(low, offsets, WORD)
        hashes = span_hash(prefix_sums(low), self.start, self.end)
        self.keys = mix(hashes ^ language[self.row])
        breaks = np.concatenate([[0], np.cumsum(BREAK[low])])
        self.follows = np.zeros(len(self.keys), bool)
        same_row = self.row[1:] == self.row[:-1]
        self.follows[1:] = same_row & (breaks[self.start[1:]] == breaks[self.end[:-1]])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Tokens, np.ndarray, pa.Array]]:
    """Tokens, language number of each row and the languages, slice by slice."""
    for batch in batches:
        coded = batch.column(1).dictionary_encode()
        names, numbers = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        keys = np.array([_language_key(n) for n in names.to_pylist()], np.uint64)
        for at, end, data, offsets in slices(batch.column(0), READ_BYTES):
            yield Tokens(data, offsets, keys[numbers[at:end]]), numbers[at:end], names


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where one entry of each distinct key stands, and how many there are."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, int)
    return order[first], np.diff(np.append(first, len(keys)))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct word of a slice with its occurrences; a null word for all words of a language."""
    for tokens, numbers, names in _read(batches):
        at, n = _groups(tokens.keys)
        offsets = np.concatenate([[0], np.cumsum(tokens.end[at] - tokens.start[at])])
        letters = np.repeat(tokens.start[at] - offsets[:-1], np.diff(offsets)) + np.arange(offsets[-1])
        text = pa.StringArray.from_buffers(
            len(at), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(tokens.data[letters].tobytes())
        )
        lang = names.take(pa.array(numbers[tokens.row[at]]))
        yield pa.record_batch([signed(tokens.keys[at]), lang, text, pa.array(n, pa.int64())], names=["key", "lang", "word", "n"])
        every = np.bincount(numbers[tokens.row], minlength=len(names))
        none = pa.nulls(len(names))
        yield pa.record_batch([none.cast(pa.int64()), names, none.cast(pa.string()), pa.array(every, pa.int64())], names=["key", "lang", "word", "n"])


class Grams:
    """Phrases found in a task, combined before they leave it."""

    def __init__(self, size: int):
        self.size, self.held, self.parts = size, 0, []

    def add(self, keys: np.ndarray, words: list[np.ndarray], at: np.ndarray) -> None:
        self.parts.append((keys, [w[at] for w in words]))
        self.held += len(at)

    def flush(self) -> pa.RecordBatch:
        keys = np.concatenate([p[0] for p in self.parts])
        at, n = _groups(keys)
        columns = [signed(np.concatenate([p[1][k] for p in self.parts])[at]) for k in range(self.size)]
        columns += [pa.nulls(len(at), pa.int64())] * (4 - self.size)
        self.parts, self.held = [], 0
        return pa.record_batch([*columns, pa.array(n, pa.int64())], names=["w1", "w2", "w3", "w4", "n"])


GRAMS = "w1 long, w2 long, w3 long, w4 long, n long"


def _shifted(words: np.ndarray, size: int) -> list[np.ndarray]:
    """The words at the places of a phrase that begins at 0, 1, ..."""
    last = len(words) - size + 1
    return [words[k : k + last] for k in range(size)]


class Member:
    """Which keys are in a set of keys."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        self.bits = np.zeros(KEY_BITS, bool)
        self.bits[keys & np.uint64(KEY_BITS - 1)] = True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = self.bits[keys & np.uint64(KEY_BITS - 1)]
        at = np.flatnonzero(out)
        if len(at):
            place = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
            out[at] = self.keys[place] == keys[at]
        return out


def _count_grams(frequent: np.ndarray, pairs: np.ndarray | None, triples: np.ndarray) -> Callable:
    """Occurrences of pairs (``pairs`` is None), or of three and four words that begin or end with
    one of ``pairs`` or ``triples`` (keys). All their words must be in the bitmap ``frequent``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.unpackbits(frequent, bitorder="little").view(bool)
        member = {2: Member(pairs), 3: Member(triples)} if pairs is not None else {}
        found = {size: Grams(size) for size in (2, 3, 4)}
        for tokens, _, _ in _read(batches):
            words = tokens.keys
            known = often[words & np.uint64(WORD_BITS - 1)]
            key, joined = words, known
            for size in (2, 3, 4):
                if len(words) < size or (size > 2 and not member):
                    break
                last = len(words) - size + 1
                before, key = key, joined_key(key[:last], words[size - 1 :])
                whole = joined[:last] & tokens.follows[size - 1 :] & known[size - 1 :]
                if not member:
                    take = whole
                elif size == 2:
                    joined, inside = whole, whole & member[2](key)
                    continue
                else:
                    take = whole & (inside[:last] | inside[1 : last + 1])
                    inside = whole & member[3](key) if size == 3 else None
                at = np.flatnonzero(take)
                found[size].add(key[at], _shifted(words, size), at)
                joined = whole
            for grams in found.values():
                if grams.held > FLUSH:
                    yield grams.flush()
        for grams in found.values():
            if grams.held:
                yield grams.flush()

    return count


def ratio(a: Column, total: Column) -> Column:
    """floor(2000000 a / total), exact for all longs."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", wide(a) * F.lit(SCALE).cast("decimal(7,0)"), total)


def plus(x: Column, y: Column) -> Column:
    return x.cast("decimal(19,0)") + y.cast("decimal(19,0)")


def lowest_cut(a: Column, cuts: list[tuple[Column, Column]]) -> Column:
    """(score, k, l, r) of the cut with the lowest score, the first of equal ones."""
    one = [F.struct(ratio(a, plus(x, y)).alias("score"), F.lit(k).alias("k"), x.alias("l"), y.alias("r")) for k, (x, y) in enumerate(cuts)]
    return F.array_min(F.array(*one))


def _frequent_bits(words: DataFrame) -> np.ndarray:
    """The bitmap of word keys: WORD_BITS bits, whatever the number of words."""
    masks = words.groupBy(F.expr(f"cast(pmod(key, {WORD_BITS}) div 64 as int)").alias("at"))
    rows = masks.agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(pmod(key, {WORD_BITS}), 64) as int))")).alias("mask")).toArrow()
    bits = np.zeros(WORD_BITS // 64, np.int64)
    bits[rows["at"].to_numpy()] = rows["mask"].to_numpy()
    return bits.view(np.uint8)


class Mining:
    """The tree of prefixes as tables, grown round by round."""

    def __init__(self, documents: DataFrame, top: int, least: int, absorbed: int, frontier: int):
        self.top, self.least, self.absorbed, self.frontier = top, least, absorbed, frontier
        lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
        self.texts = documents.select("text", lang.alias("lang"))
        counted = self.texts.mapInArrow(_count_words, "key long, lang string, word string, n long")
        counted = counted.groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))
        kept = stored(counted.where(F.col("word").isNull() | (F.col("n") >= least)), "words")
        self.totals = kept.where("word IS NULL").select("lang", "n")
        self.words = kept.where("word IS NOT NULL")
        self.bits = _frequent_bits(self.words)
        f = lambda k: self.words.select(F.col("key").alias(f"w{k}"), F.col("n").alias(f"f{k}"), *(["lang"] if k == 1 else []))
        pairs = self.pass_over(None, np.zeros(0, np.uint64)).select("w1", "w2", F.col("n").alias("a"))
        pairs = pairs.join(f(1), "w1").join(f(2), "w2")
        cut = lowest_cut(F.col("a"), [(F.col("f1"), F.col("f2"))])
        self.pairs = stored(pairs.withColumn("cut", cut).withColumn("bound", self.bound()), "pairs")
        self.spark = documents.sparkSession
        self.counted = self.spark.createDataFrame([], GRAMS)
        self.opened = {2: self.spark.createDataFrame([], "w1 long, w2 long"), 3: self.spark.createDataFrame([], "w1 long, w2 long, w3 long")}

    @staticmethod
    def bound() -> Column:
        return ratio(F.col("a"), plus(F.col("f1"), F.col("a")))

    def pass_over(self, pairs: np.ndarray | None, triples: np.ndarray) -> DataFrame:
        found = self.texts.mapInArrow(_count_grams(self.bits, pairs, triples), GRAMS)
        return found.groupBy("w1", "w2", "w3", "w4").agg(F.sum("n").alias("n")).where(F.col("n") >= self.least)

    def triples(self) -> DataFrame:
        """Phrases of three words counted so far; both their pairs are known."""
        found = self.counted.where("w4 IS NULL").select("w1", "w2", "w3", F.col("n").alias("a")).distinct()
        head = self.pairs.select("w1", "w2", "f1", "lang", F.col("a").alias("n12"))
        tail = self.pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f2").alias("f3"), F.col("a").alias("n23"))
        made = found.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"])
        cut = lowest_cut(F.col("a"), [(F.col("f1"), F.col("n23")), (F.col("n12"), F.col("f3"))])
        return made.withColumn("cut", cut).withColumn("bound", self.bound())

    def fours(self, triples: DataFrame) -> DataFrame:
        """Phrases of four words counted so far; both their triples were counted with them."""
        found = self.counted.where("w4 IS NOT NULL").select("w1", "w2", "w3", "w4", F.col("n").alias("a")).distinct()
        head = triples.select("w1", "w2", "w3", "f1", "lang", "n12", F.col("a").alias("n123"))
        tail = triples.select(*(F.col(f"w{k}").alias(f"w{k + 1}") for k in (1, 2, 3)), F.col("n23").alias("n34"), F.col("f3").alias("f4"), F.col("a").alias("n234"))
        made = found.join(head, ["w1", "w2", "w3"]).join(tail, ["w2", "w3", "w4"])
        cuts = [(F.col("f1"), F.col("n234")), (F.col("n12"), F.col("n34")), (F.col("n123"), F.col("f4"))]
        return made.withColumn("cut", lowest_cut(F.col("a"), cuts))

    def settled(self, pairs: DataFrame, shorter: DataFrame, longer: DataFrame, size: int) -> DataFrame:
        """Opened phrases of ``size`` words that no phrase of one word more absorbs. A phrase two
        words longer that absorbs one implies the phrase between them, which does so too."""
        names = [f"w{k}" for k in range(1, size + 1)]
        around = longer.select(*names, F.col("a").alias("around"))
        behind = longer.select(*(F.col(f"w{k + 1}").alias(f"w{k}") for k in range(1, size + 1)), F.col("a").alias("around"))
        most = around.unionByName(behind).groupBy(*names).agg(F.max("around").alias("around"))
        joined = shorter.join(self.opened[size], names, "left_semi").join(most, names, "left")
        wide = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(19,0)")
        return joined.where(wide("around") * 100 < wide("a") * self.absorbed)

    def survivors(self) -> DataFrame:
        """lang, words, a, cut of phrases that are known to stay."""
        shape = lambda df, size: df.select("lang", F.array(*(f"w{k}" for k in range(1, size + 1))).alias("words"), "a", "cut")
        return (
            shape(self.settled(self.pairs, self.pairs, self.three, 2), 2)
            .unionByName(shape(self.settled(self.pairs, self.three, self.four, 3), 3))
            .unionByName(shape(self.four, 4))
        )

    def floors(self, rows: DataFrame, column: Column, top: int) -> DataFrame:
        """lang, floor: the value that ``top`` rows of the language reach. Distinct values are few."""
        counts = rows.groupBy("lang", column.alias("value")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("value")))
        return counts.withColumn("upto", upto).where(F.col("upto") >= top).groupBy("lang").agg(F.max("value").alias("floor"))

    def open_prefixes(self) -> DataFrame:
        """Prefixes worth opening: those that reach their language's floor; the best ones while there is none."""
        three = self.three.select("lang", "w1", "w2", "w3", "bound").join(self.opened[3], ["w1", "w2", "w3"], "left_anti")
        two = self.pairs.select("lang", "w1", "w2", F.lit(None).cast("long").alias("w3"), "bound")
        two = two.join(self.opened[2], ["w1", "w2"], "left_anti")
        open_ = two.unionByName(three).join(self.limits, "lang", "left")
        first = self.floors(open_.where("floor IS NULL"), F.col("bound"), 4 * self.top).withColumnRenamed("floor", "first")
        return open_.join(first, "lang", "left").where("bound >= coalesce(floor, first, 0)").select("w1", "w2", "w3", "bound")

    def frontier_of(self, wanted: DataFrame) -> DataFrame:
        """The open prefixes with the highest bounds, about ``frontier`` at most."""
        steps = wanted.groupBy((F.col("bound") / BOUND_STEP).cast("int").alias("step")).count().orderBy(F.desc("step")).collect()
        held, lowest = 0, None
        for step, n in steps:  # at most 1001 rows
            if held and held + n > self.frontier:
                break
            held, lowest = held + n, step
        best = wanted.where(F.col("bound") >= (lowest or 0) * BOUND_STEP)
        if held > self.frontier:  # ties: one slice of them now, the others in later rounds
            slice_ = F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(2 * held // self.frontier))
            filled = best.groupBy(slice_.alias("slice")).count().agg(F.min("slice")).first()[0]
            best = best.where(slice_ == filled)
        return best

    def grow(self) -> bool:
        """One round: open the frontier. False when no prefix is left to open."""
        self.three = stored(self.triples(), "triples")
        self.four = stored(self.fours(self.three), "fours")
        self.kept = stored(self.survivors(), "survivors")
        self.limits = stored(self.floors(self.kept, F.col("cut.score"), self.top), "floors")
        wanted = stored(self.open_prefixes(), "open")
        frontier = stored(self.frontier_of(wanted).select("w1", "w2", "w3"), "frontier")
        triples = frontier.where("w3 IS NOT NULL")
        inner = triples.select("w1", "w2").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2")))
        inner = inner.join(self.opened[2], ["w1", "w2"], "left_anti")
        pairs = stored(frontier.where("w3 IS NULL").select("w1", "w2").unionByName(inner).distinct(), "opened")
        rows2, rows3 = pairs.toArrow(), triples.toArrow()
        if not rows2.num_rows and not rows3.num_rows:
            return False
        words = lambda rows, k: rows[f"w{k}"].to_numpy().view(np.uint64)
        keys2 = joined_key(words(rows2, 1), words(rows2, 2))
        keys3 = joined_key(joined_key(words(rows3, 1), words(rows3, 2)), words(rows3, 3))
        self.counted = self.counted.unionByName(stored(self.pass_over(keys2, keys3), "grams"))
        self.opened = {2: self.opened[2].unionByName(pairs), 3: self.opened[3].unionByName(triples)}
        return True

    def best(self) -> DataFrame:
        """lang, rank, phrase, a, l, r, n, score of the first ``top`` of each language."""
        kept = self.kept.join(self.limits, "lang", "left").where("cut.score >= coalesce(floor, 0)").withColumn("id", F.xxhash64("words"))
        texts = (
            kept.select("id", F.posexplode("words").alias("at", "key"))
            .join(self.words.select("key", "word"), "key")
            .groupBy("id")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ").alias("phrase"))
        )
        rows = kept.join(texts, "id").select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        salt = F.pmod(F.xxhash64("phrase"), F.lit(parallelism(self.spark)))
        among = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
        rows = rows.withColumn("salt", salt).withColumn("among", among).where(F.col("among") <= self.top)
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
        rows = rows.withColumn("rank", rank).where(F.col("rank") <= self.top).join(self.totals, "lang")
        return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine_collocations(documents: DataFrame, top: int = 2000, least: int = 30, absorbed: int = 80, frontier: int = FRONTIER) -> DataFrame:
    mining = Mining(documents, top, least, absorbed, frontier)
    while mining.grow():
        pass
    return mining.best()
