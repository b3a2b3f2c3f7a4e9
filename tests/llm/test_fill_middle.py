"""Line cuts and the compressed set of their places, against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from tests.llm.conftest import frame
from tests.oracle import connect, difference

from tabloom.llm import fill_middle, queries
from tabloom.llm.fill_middle import ArrayContainer, BitmapContainer, BoundarySet, RunContainer


@pytest.mark.parametrize(
    "places, kind",
    [
        ([7], ArrayContainer),
        (sorted(random.Random(1).sample(range(65536), 4000)), ArrayContainer),
        (sorted(random.Random(2).sample(range(65536), 30000)), BitmapContainer),
        (list(range(100, 60000)), RunContainer),
        ([0, 65535], ArrayContainer),
    ],
)
def test_containers_select_every_place(places, kind):
    made = fill_middle.container(np.array(places))
    assert type(made) is kind
    assert [made.select(k) for k in range(len(places))] == places


def test_set_selects_across_containers():
    r = random.Random(3)
    dense = set(range(70_000, 200_000)) | set(r.sample(range(300_000, 365_536), 40_000)) | {5, 10**6, 5 * 10**9}
    places = sorted(dense)
    made = BoundarySet(np.array(places))
    assert {type(c) for c in made.containers} == {ArrayContainer, BitmapContainer, RunContainer}
    assert len(made) == len(places)
    at = [0, len(places) - 1, *r.sample(range(len(places)), 3000)]
    assert [made.select(k) for k in at] == [places[k] for k in at]
    for k in (-1, len(places)):
        with pytest.raises(IndexError):
            made.select(k)


def plain(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < 50:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def odd_lines():
    r = random.Random(5)
    rows = [(k, "".join(r.choice(["é\n", "a b", "日本\r\n", "\n", "<", "S>x", "𝄞"]) for _ in range(k))) for k in range(40)]
    rows += [(50, "a<P>b\nc"), (51, "<M>"), (52, "\n"), (53, "\n\n\n"), (54, "x"), (55, "x\n" * 70_000), (56, "é" * 300_000 + "\nend")]
    rows += [(57, "<S\n>\n<\nP>\n"), (None, "no id\nat all\n"), (None, None), (58, ""), (1, "again\n1"), (1, "again\n1")]
    return rows


def test_rows_equal_plain_version(spark, odd_rows):
    rows = odd_rows + odd_lines()
    got = [tuple(r) for r in fill_middle.rearrange(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted((plain(*row) for row in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_texts_come_back(spark, odd_rows):
    rows = odd_rows + odd_lines()
    got = fill_middle.rearrange_and_restore(frame(spark, rows)).collect()
    digest = lambda text: hashlib.sha256((text or "").encode()).hexdigest()
    want = sorted(((d, digest(plain(d, t)[-1]), digest(t)) for d, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["output_sha256"], r["restored_sha256"]) for r in got), key=repr) == want


def test_share_of_cut_documents(spark, none):
    rows = [(k, "a\nb\nc\n") for k in range(400)]
    forms = [r["form"] for r in fill_middle.rearrange(frame(spark, rows), percent=25, suffix_first=100).collect()]
    assert 60 < forms.count("spm") < 140 and forms.count("psm") == 0 and len(forms) == 400
    assert fill_middle.rearrange_and_restore(none).collect() == []


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    name = "op11_fill_middle"
    assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) is None
