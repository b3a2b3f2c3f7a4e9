import random

import pytest

EXTRA = "words string, node long, row string, core int, length long, found string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def frame(spark, rows):
    """Rows of (doc_id, text) with columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(d, t, "en", "s", None if t is None else len(t), "w", 1, "r", 2, 3, "f") for d, t in rows], SCHEMA
    ).repartition(5)


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    made = ["".join(r.choice(["ta", "re", "mi", "so", "lu", "né", "ko"]) for _ in range(r.randint(1, 4))) for _ in range(vocabulary)]
    return " ".join(made[min(int(r.expovariate(1 / 60)), vocabulary - 1)] for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, near and exact copies."""
    base = prose(1, 120)
    near = base.replace(base.split()[60], "zzz", 1)
    rows = [(k, prose(k + 10, 40 + 5 * k)) for k in range(12)]
    rows += [(20, base), (21, base), (22, near), (23, "pre " + base[40:400] + " post"), (24, base.upper())]
    rows += [(30, None), (31, ""), (32, "   \n"), (33, "12 34"), (34, "é" * 150), (35, "ab" * 300), (36, "one two")]
    rows += [(40, prose(3, 6000)), (41, prose(3, 6000)[5000:30000])]
    rows += [(50, prose(77, 50)), (50, prose(77, 50)), (51, prose(78, 60)), (51, prose(79, 60))]
    rows += [(None, prose(80, 70)), (None, base)]
    return rows


@pytest.fixture
def odd(spark, odd_rows):
    return frame(spark, odd_rows)


@pytest.fixture
def none(spark):
    return frame(spark, [(0, "x")]).where("doc_id = 1")
