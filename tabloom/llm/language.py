"""Language identification as a mixture: every text is a blend of learned languages.

Letters are read as hashed byte trigrams. The model is a table of ``BUCKETS`` trigram
probabilities for each language, learned by counting. For a text,
expectation-maximisation finds the proportions under which its trigrams are likeliest;
languages are then dropped one at a time, smallest share first, while the likelihood
penalised by ``PENALTY`` * log(trigrams) for each language does not fall. The language
with the largest share is predicted, the share is its score.

Null texts, empty ones and texts without a letter are ``und`` with score 0; so is every
text when nothing was learned. Equal shares go to the name that sorts first. Null or
repeated doc_ids stay rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.common import LOWER, slices

BUCKETS = 1 << 13
ROWS_AT_ONCE = 256
STEPS = 8
PENALTY = 2.0
SMOOTHING = 0.5
UNKNOWN = "und"

# Every mark that is no letter counts as a space.
_LETTERS = LOWER.copy()
_LETTERS[:97] = np.where((_LETTERS[:97] >= 97) & (_LETTERS[:97] <= 122), _LETTERS[:97], 32)
_LETTERS[123:128] = 32


def trigram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed trigrams (rows x BUCKETS); a text has a space on either side, runs of
    spaces count nothing."""
    rows = len(offsets) - 1
    codes = np.full(len(data) + 2 * rows, 32, np.uint32)
    codes[np.arange(len(data)) + 2 * np.repeat(np.arange(rows), np.diff(offsets)) + 1] = _LETTERS[data]
    if len(codes) < 3:
        return np.zeros((rows, BUCKETS))
    code = codes[:-2] | codes[1:-1] << np.uint32(8) | codes[2:] << np.uint32(16)
    row = np.repeat(np.arange(rows), np.diff(offsets) + 2)
    keep = (row[:-2] == row[2:]) & ((codes[:-2] != 32) | (codes[1:-1] != 32)) & ((codes[1:-1] != 32) | (codes[2:] != 32))
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 13)
    cells = row[:-2][keep] * BUCKETS + bucket[keep].astype(np.int64)
    return np.bincount(cells, minlength=rows * BUCKETS).reshape(rows, BUCKETS)


def row_groups(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``slices``, of at most ROWS_AT_ONCE rows."""
    for at, end, data, offsets in slices(column):
        for low in range(0, end - at, ROWS_AT_ONCE):
            high = min(low + ROWS_AT_ONCE, end - at)
            yield at + low, at + high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]


def learn(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order of name, and log probabilities (languages x BUCKETS), from all rows
    of (text, lang). What reaches the driver is the table: BUCKETS numbers for each language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), object)
            for at, end, data, offsets in row_groups(batch.column(0)):
                counts = trigram_counts(data, offsets)
                part = names[at:end]
                for name in set(part):
                    totals[name] = totals.get(name, 0) + counts[part == name].sum(axis=0)
        for name, total in totals.items():
            at = np.flatnonzero(total)
            columns = [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))]
            yield pa.record_batch(columns, names=["lang", "bucket", "n"])

    known = labelled.where(F.col("lang").isNotNull()).select("text", "lang")
    rows = known.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(rows.column("lang").to_pylist(), object)
    languages = sorted(set(names))
    table = np.full((len(languages), BUCKETS), SMOOTHING)
    for k, name in enumerate(languages):
        mine = names == name
        table[k, rows.column("bucket").to_numpy()[mine]] += rows.column("n").to_numpy()[mine]
    return languages, np.log(table / table.sum(axis=1, keepdims=True)) if languages else table


class Mixture:
    """Entries (row, bucket, count) of a group of texts, ready for the steps of expectation-maximisation."""

    def __init__(self, counts: np.ndarray, log_table: np.ndarray):
        row, bucket = np.nonzero(counts)
        self.count = counts[row, bucket].astype(float)
        self.rows, self.row = len(counts), row
        self.size = counts.sum(axis=1).astype(float)
        logs = log_table[:, bucket].T
        self.top = logs.max(axis=1, initial=-1e300)
        self.odds = np.exp(logs - self.top[:, None])
        self.begin = np.searchsorted(row, np.arange(self.rows))
        self.filled = self.size > 0

    def _by_row(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros((self.rows, *values.shape[1:]))
        if len(values):
            out[self.filled] = np.add.reduceat(values, self.begin[self.filled], axis=0)
        return out

    def fit(self, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares (rows x languages) among the allowed ones, and log likelihoods."""
        share = allowed / allowed.sum(axis=1, keepdims=True)
        for _ in range(STEPS):
            weighted = self.odds * share[self.row]
            weighted *= (self.count / np.maximum(weighted.sum(axis=1), 1e-300))[:, None]
            share = self._by_row(weighted) / np.maximum(self.size, 1)[:, None]
            share = np.where(self.filled[:, None], share, allowed / allowed.sum(axis=1, keepdims=True))
        mixed = (self.odds * share[self.row]).sum(axis=1)
        return share, self._by_row(self.count * (np.log(np.maximum(mixed, 1e-300)) + self.top))

    def select(self) -> np.ndarray:
        """Shares under the language set of the best penalised likelihood."""
        languages = self.odds.shape[1]
        allowed = np.ones((self.rows, languages), bool)
        share, fit = self.fit(allowed)
        price = PENALTY * np.log(np.maximum(self.size, 2))
        open_ = self.filled.copy()  # without trigrams all languages stay, with equal shares
        for kept in range(languages - 1, 0, -1):
            trial = allowed.copy()
            trial[np.arange(self.rows), np.where(allowed, share, 2).argmin(axis=1)] = False
            new_share, new_fit = self.fit(trial)
            open_ &= new_fit + price >= fit
            if not open_.any():
                break
            allowed[open_], share[open_], fit[open_] = trial[open_], new_share[open_], new_fit[open_]
        return share


def identify(documents: DataFrame, languages: list[str], log_table: np.ndarray) -> DataFrame:
    """doc_id, lang_pred, score, and ``lang_shares`` as name:share of the selected set."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for at, end, data, offsets in row_groups(texts):
                part = texts.slice(at, end - at).to_pylist()
                lettered = np.array([bool(languages) and any(map(str.isalpha, t or "")) for t in part])
                share = np.zeros((end - at, max(1, len(languages))))
                if lettered.any():
                    share = Mixture(trigram_counts(data, offsets), log_table).select()
                best = share.argmax(axis=1)
                shares = [
                    ",".join(f"{languages[k]}:{s[k]:.3f}" for k in np.flatnonzero(s > 0.0005)) if ok else None
                    for s, ok in zip(share, lettered)
                ]
                columns = [
                    batch.column(0).slice(at, end - at),
                    pa.array([languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)], pa.string()),
                    pa.array(np.where(lettered, np.clip(share.max(axis=1), 0, 1), 0.0)),
                    pa.array(shares, pa.string()),
                ]
                yield pa.record_batch(columns, names=["doc_id", "lang_pred", "score", "lang_shares"])

    return documents.select("doc_id", "text").mapInArrow(predict, "doc_id long, lang_pred string, score double, lang_shares string")


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_held_out(documents: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, predict all."""
    languages, log_table = learn(documents.where(~held_out(F.col("doc_id"))))
    found = identify(documents, languages, log_table)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "lang_shares")
