"""Operators that read each text by itself, against plain versions."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import frame, prose
from tokenizers import Tokenizer

from tabloom.llm import language, licences, packing, quality, token_files
from tabloom.llm.fingerprints import fingerprint_documents, fingerprint_texts, likeness
from tabloom.llm.tokens import TokenCoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_do_not_change_ids(plain, odd_rows):
    coder = TokenCoder(PATH, cache=50)
    odd = ["  a  b \n\n c", "日本語 x's it'll  ", "a <|endoftext|> b", "\t x\r\n  y ١٢ ok", "don't we'RE 12a3 É é", "a \n b", "a  b", " "]
    for text in [*odd, *(t or "" for _, t in odd_rows)]:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == plain(text)


def test_token_files_round_trip(odd, odd_rows, plain):
    got = sorted(map(tuple, token_files.encode_and_read_back(odd).collect()), key=lambda r: r[1])
    mark = {r[0]: r[1] for r in odd.select("text", F.xxhash64("text")).distinct().collect()}
    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, mark[r[1]]))
    at = 0
    assert len(got) == len(rows)
    for (doc_id, text), row in zip(rows, got):
        ids = np.array([*plain(text), 0], "<u4")
        assert row == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


@pytest.mark.parametrize("ids", [[5], [7] * 9, list(range(70000, 71000)), [0, 2**32 - 1, 3] * 50, [2**31, 1]])
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    for percentile in (0, 50, 90, 100):
        assert (token_files.unpack_block(token_files.pack_block(ids, percentile)) == ids).all()


def test_packing_is_whole_and_tight(odd, odd_rows, plain):
    rows = packing.pack_documents(odd, capacity=256, rounds=50).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    want = sorted(
        zlib.crc32(np.array(ids[max(0, e - 256) if e % 256 == len(ids) % 256 else e - 256 : e], "<u4").tobytes())
        for ids in ([*plain(t), 2] for _, t in odd_rows)
        for e in range((len(ids) - 1) % 256 + 1, len(ids) + 1, 256)
    )
    assert sorted(r["ids_crc32"] for r in rows) == want
    assert all(r["length"] == 256 for r in rows if r["piece"] > 0)
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= -(-total // 256) + 3


def test_plan_packs_every_histogram():
    rng = np.random.default_rng(3)
    for n in (0, 1, 50, 5000):
        counts = np.bincount(rng.integers(1, 101, n), minlength=101)[1:]
        plan = packing.plan_packing(counts, 100, 80)
        held = np.zeros(100, int)
        for pattern, times in plan.uses:
            assert sum(length * many for length, many in pattern.items()) <= 100
            for length, many in pattern.items():
                held[length - 1] += many * times
        assert (held == counts).all()
        least = -(-(counts * np.arange(1, 101)).sum() // 100)
        assert plan.sequences <= 1.05 * least + 2


def test_fingerprints(odd, odd_rows):
    got = fingerprint_documents(odd, ranges=4).collect()
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))[::-1]
    want = []
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        want.append((doc_id, len(text), hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=key) == sorted(want, key=key)
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (20, 21)}) == 1
    assert {r["fingerprint"] for r in got if r["doc_id"] in (30, 31, 32)} == {""}
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))


def test_likeness_is_unbiased():
    off = []
    for k in range(60):
        words = prose(k, 300, 5000).split()
        a, b = " ".join(words[:220]), " ".join(words[60:])
        five = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}
        bins, some = fingerprint_texts([a.encode(), b.encode()])
        off.append(likeness(bins[:1], some[:1], bins[1:], some[1:])[0] - len(five(a) & five(b)) / len(five(a) | five(b)))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.06


def test_licences_base(spark, odd_rows):
    rows = odd_rows + [(60, "MIT License. mit license"), (61, "x-General_Public/license"), (62, "apache\n\tLICENSE é apache"), (63, "mit licenses")]
    for r in licences.scan_licences(frame(spark, rows)).where("doc_id >= 30 AND doc_id < 50 OR doc_id >= 60").collect():
        text = dict((k, v) for k, v in rows if k is not None)[r["doc_id"]] or ""
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        places = [(p, label) for name, label in licences.PHRASES.items() for p in range(len(words)) if words[p : p + len(name.split())] == name.split()]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == (min((p for p, _ in places), default=None), max((p for p, _ in places), default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))


def test_licences_templates(spark):
    mit, gpl = licences.TEMPLATES["mit"][0], licences.TEMPLATES["gpl"][0]
    cut = " ".join(mit.split()[:50] + ["changed"] + mit.split()[51:])
    rows = [(1, f"a b {cut} c"), (2, gpl), (3, " ".join(mit.split()[:20])), (4, prose(5, 100)), (5, None)]
    got = {r["doc_id"]: r for r in licences.scan_licences(frame(spark, rows)).collect()}
    assert got[1]["labels"] == "mit" and got[1]["spans"].startswith("mit:2:") and 0.9 < got[1]["score"] <= 1
    assert got[2]["labels"] == "gpl" and got[2]["base_labels"] == "gpl" and got[2]["score"] == 1
    assert [got[k]["labels"] for k in (3, 4, 5)] == ["", "", ""] and got[5]["n_words"] == 0


def test_licence_names(spark):
    """Short references, families and versions; base labels stay beside the variant's."""
    gpl = licences.TEMPLATES["gpl"][0]
    cases = {
        "Licensed under CC BY-NC 4.0.": "cc-by-nc:4:9",
        "cc-by-nc-sa": "cc-by-nc-sa:2:6",
        "licensed under CC BY-SA, 3.0": "cc-by-sa:4:9",
        "licensed under CC BY": "cc-by:2:6",
        "CC BY-ND and CC BY 2.0 here": "cc-by-nd:2:5,cc-by:6:10",
        "https://creativecommons.org/licenses/by-nc-nd/4.0/": "cc-by-nc-nd:3:11",
        "LGPLv2.1, AGPL-3.0": "lgpl:2:4,agpl:4:5",
        "sent cc by mail": "",
    }
    rows = [(k, f"one two {text}") for k, text in enumerate(cases)]
    rows += [(50, "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License")]
    rows += [(51, licences.TEMPLATES["cc-by"][0]), (52, gpl.replace("GNU General", "GNU Lesser General")), (53, gpl), (54, "licensed under CC"), (55, "BY-NC 4.0")]
    got = {r["doc_id"]: r for r in licences.scan_licences(frame(spark, rows)).collect()}
    for k, spans in enumerate(cases.values()):
        assert got[k]["spans"] == spans and got[k]["score"] == (licences.NAMED_SCORE if spans else 0)
        assert got[k]["labels"] == ",".join(sorted({s.split(":")[0] for s in spans.split(",") if s}))
    assert [got[k]["labels"] for k in range(50, 56)] == ["cc-by-nc", "cc-by", "gpl,lgpl", "gpl", "", ""]
    assert got[52]["base_labels"] == "gpl" and got[51]["score"] == got[53]["score"] == 1


def test_automaton_gives_matching_statistics():
    rng = np.random.default_rng(2)
    for _ in range(40):
        texts = [rng.integers(0, 4, rng.integers(1, 30)).tolist() for _ in range(3)]
        query = rng.integers(0, 5, 40).tolist()
        runs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        want = []
        for end in range(1, len(query) + 1):
            length = next((n for n in range(end, 0, -1) if tuple(query[end - n : end]) in runs), 0)
            longer = end < len(query) and length and tuple(query[end - length : end + 1]) in runs
            if length >= 2 and not longer:
                want.append((end, length))
        got = [(end, length) for end, length, _ in licences.SuffixAutomaton(texts).matches(query, 2)]
        assert got == want


def test_language_mixture(spark):
    words = {"aa": "ta re mi so lu", "bb": "vor kli stu pfe nax", "cc": "ção é ñu çi ü"}
    rng = np.random.default_rng(0)
    say = lambda lang, n: " ".join("".join(rng.choice(words[lang].split(), 2)) for _ in range(n))
    rows = [(k, say(lang, 30), lang, "s", 0) for k, lang in enumerate(["aa", "bb", "cc"] * 20)]
    rows += [(100, None, None, "s", 0), (101, " 12 !", "aa", "s", 0), (102, say("aa", 30) + " " + say("bb", 10), None, "s", 0), (None, say("bb", 9), "bb", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in language.identify_held_out(docs).collect()}
    assert all(got[k]["lang_pred"] == rows[k][2] for k in range(60))
    assert all(got[k]["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k in range(60))
    assert [(got[k]["lang_pred"], got[k]["score"]) for k in (100, 101)] == [("und", 0.0)] * 2
    assert got[102]["lang_pred"] == "aa" and 0.55 < got[102]["score"] < 0.95 and "bb:" in got[102]["lang_shares"]
    assert got[None]["lang_pred"] == "bb" and not got[None]["held_out"]
    short = [(k, t, None, "s", 0) for k, t in enumerate(["ta", "vor", "ñu", "日", "ok?"])]
    table, names = language.learn(docs)[::-1]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(short, docs.schema), names, table).collect()}
    assert [got[k]["lang_pred"] for k in range(3)] == ["aa", "bb", "cc"]
    assert all(0 < r["score"] <= 1 for r in got.values())
    share = language.Mixture(np.zeros((1, language.BUCKETS)), table).select()
    assert share.tolist() == [[1 / 3] * 3]
    unlearned = language.identify_held_out(docs.where("lang IS NULL")).collect()
    assert {r["lang_pred"] for r in unlearned} == {"und"}


def test_quality_orders_grades(spark):
    text = {0: "vile awful nasty", 1: "dull plain meh", 2: "fine clear good"}
    rows, labels = [], []
    for k in range(240):
        grade = k % 3
        rows.append((k, prose(k, 30) + " " + text[grade].split()[k % 3 if k % 2 else 0] + " " + prose(k + 999, 30)))
        if k < 200:
            labels.append((k, int(grade != 1), int(grade == 0)))
    labels += [(None, 1, 1), (5, None, 1), (9999, 1, 0)]
    ratings = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = frame(spark, rows + [(500, None), (501, "")])
    model = quality.fit_to_labels(docs, ratings)
    got = {r["doc_id"]: r for r in quality.grade_documents(docs, model, tail=2).collect()}
    assert len(got) == 242
    late = [(k % 3, got[k]) for k in range(200, 240)]
    assert sum(r["keep"] == (g == 2) for g, r in late) >= 36
    mean = [np.mean([r["expected_grade"] for g, r in late if g == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2]
    kept = quality.keep_documents(docs, model, tail=2)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {k for k, r in got.items() if r["keep"]}
    unrated = quality.fit_to_labels(docs, ratings.where("doc_id < 0"))
    assert quality.keep_documents(docs, unrated, tail=2).count() == 242


def test_ordinal_gradient():
    rng = np.random.default_rng(1)
    grade, feature = rng.integers(0, 3, 30), rng.integers(0, 6, 60)
    row = np.sort(rng.integers(0, 30, 60))
    weights, edges = rng.normal(size=6), np.array([-0.4, 0.9])

    def loss(w, t):
        above = quality.OrdinalModel(w, t).above(np.bincount(row, weights=w[feature], minlength=30))
        edge = np.hstack([np.zeros((30, 1)), 1 - above, np.ones((30, 1))])
        return -np.log(edge[np.arange(30), grade + 1] - edge[np.arange(30), grade]).sum()

    by_weight, by_threshold = quality.gradient(quality.OrdinalModel(weights, edges), grade, row, feature)
    for k in range(6):
        step = np.eye(6)[k] * 1e-6
        assert abs((loss(weights + step, edges) - loss(weights - step, edges)) / 2e-6 - by_weight[k]) < 1e-4
    for k in range(2):
        step = np.eye(2)[k] * 1e-6
        assert abs((loss(weights, edges + step) - loss(weights, edges - step)) / 2e-6 - by_threshold[k]) < 1e-4


def test_empty_tables(none):
    labels = none.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    assert packing.pack_documents(none).count() == 0
    assert token_files.encode_and_read_back(none).count() == 0
    assert fingerprint_documents(none).count() == 0
    assert licences.scan_licences(none).count() == 0
    assert language.identify_held_out(none).count() == 0
    assert quality.keep_documents(none, quality.fit_to_labels(none, labels), tail=2).count() == 0
