"""Best-first phrase growth against counting every phrase."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import SCHEMA, frame
from tests.oracle import connect, difference

from tabloom.llm import collocations, queries
from tabloom.llm.collocations import Member, Mining, lowest_cut, mine_collocations


def plain(rows, top, least, absorbed=80):
    """rows of (text, lang)."""
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3, 4):
                counts[lang].update(zip(*(words[i:] for i in range(k))))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = collections.Counter()
        for p, a in candidates.items():
            for s in range(len(p)):
                for e in range(s + 2, len(p) + 1):
                    if e - s < len(p):
                        around[p[s:e]] = max(around[p[s:e]], a)
        ranked = []
        for p, a in candidates.items():
            if 100 * around[p] < absorbed * a:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        ranked.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(ranked[:top])]
    return out


def corpus(seed, documents=60):
    """Sentences over few words with frequent phrases, odd signs, repeated rows, null and empty cells."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(25)] + ["The", "the", "É", "é", "\x00b", "don't", "日本", "\xa0"]
    phrases = ["the w1 w2 w3", "w4 w5", "w6 w7 w8", "New York city hall", "a a a a a"]
    rows = []
    for _ in range(documents):
        text = "".join(
            (r.choice(phrases) if r.random() < 0.5 else r.choice(words)) + r.choice([" ", "  ", "\t", " \t", ", ", "\n", "?", "! ", "\x0b", "\x1f"] + [" "] * 12)
            for _ in range(r.randint(0, 60))
        )
        rows.append((text, r.choice(["en", "en", "en", "fr", None, ""])))
    return rows + rows[:9] + [(None, "en"), (None, None), ("", "de"), (" \t\n", "de"), ("one", "xx"), ("the w1 w2 w3 " * 4000, "fr"), (".,;", "yy")]


def as_table(spark, rows):
    made = [(k, t, lang, "s", None, "w", 1, "r", 2, 3, "f") for k, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(made, SCHEMA).repartition(5)


@pytest.mark.parametrize("seed, top, least, frontier", [(1, 2000, 3, 200_000), (2, 5, 2, 200_000), (3, 15, 2, 150)])
def test_rows_equal_plain_counts(spark, seed, top, least, frontier):
    rows = corpus(seed)
    got = [tuple(r) for r in mine_collocations(as_table(spark, rows), top=top, least=least, frontier=frontier).collect()]
    assert sorted(got) == sorted(plain(rows, top, least))
    assert got


def test_most_prefixes_stay_closed(spark):
    """The floor spares prefixes: a small top opens fewer than there are, and ties are still whole."""
    r = random.Random(8)
    rows = [(" ".join(r.choice([f"w{int(r.expovariate(0.1))}", "big deal", "so so far"]) for _ in range(400)), "en") for _ in range(30)]
    mining = Mining(as_table(spark, rows), top=2, least=2, absorbed=80, frontier=200_000)
    while mining.grow():
        pass
    assert sorted(tuple(x) for x in mining.best().collect()) == sorted(plain(rows, 2, 2))
    assert mining.opened[2].count() < mining.pairs.count() / 2


def test_counts_are_combined_in_parts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FLUSH", 50)
    rows = corpus(6)
    got = mine_collocations(as_table(spark, rows), top=30, least=4).collect()
    assert sorted(map(tuple, got)) == sorted(plain(rows, 30, 4))


def test_empty_table_and_odd_rows(spark, odd_rows, none):
    assert mine_collocations(none).collect() == []
    got = mine_collocations(frame(spark, odd_rows), least=5).collect()
    assert sorted(map(tuple, got)) == sorted(plain([(t, "en") for _, t in odd_rows], 2000, 5))


def test_scores_pass_64_bits(spark):
    big = 9 * 10**18
    row = spark.range(1).select(lowest_cut(F.lit(big - 5), [(F.lit(big), F.lit(big - 1)), (F.lit(big - 1), F.lit(big))]).alias("c")).first()["c"]
    assert tuple(row) == (2000000 * (big - 5) // (2 * big - 1), 0, big, big - 1)


def test_member_tells_keys_with_equal_low_bits():
    keys = np.array([5, 5 + (1 << 40), 77], np.uint64)
    member = Member(keys[:1])
    assert member(keys).tolist() == [True, False, False]
    assert Member(keys[:0])(keys).tolist() == [False] * 3


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    name = "op12_collocations"
    assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) is None
