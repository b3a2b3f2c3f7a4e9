import json
import random

import pytest
from pyspark.sql import functions as F

from tabloom.functions.names import sanitise_name
from tabloom.operators import ddl, infer
from tabloom.plans import growing, publish

LADDER = ["BIGINT", "DOUBLE", "TIMESTAMP", "DATE"]
SAMPLES = {
    "I": ["5", "€70,812", "0" * 600], "F": ["1.5", "81.25%", "." + "1" * 600], "T": ["1987-11-03 21:04:59"],
    "A": ["1987-11-03", "June 9, 2031"], "S": ["word", "long " * 120], "": ["", "—", "[1]"],
}


def kind(value):
    return next(k for k, vs in SAMPLES.items() if value in vs)


def walk(values):
    """The rule applied value by value."""
    accepts = {"I": {0, 1}, "F": {1}, "T": {2}, "A": {3}, "S": set()}
    at = 0
    text = None
    for v in values:
        k = kind(v)
        if not k:
            continue
        steps = [] if text else [i for i in range(at, 4) if i in accepts[k]]
        if steps:
            at = steps[0]
        else:
            text = "TEXT" if len(v.encode()) > 512 else "VARCHAR(512)"
    return text or LADDER[at]


@pytest.mark.parametrize("across_pages", [False, True])
def test_inference_is_the_ordered_walk(spark, across_pages):
    rnd = random.Random(11)
    rows, want = [], {}
    for key in range(1500):
        kinds = rnd.choice(["I", "IF", "IFT", "TA", "ITA", "IFTA", "IFTAS", "S", ""])
        values = [rnd.choice(SAMPLES[rnd.choice(list(kinds) + [""])]) for _ in range(rnd.randint(1, 7))]
        want[key] = walk(values)
        rows += [(key, i // 3, i % 3, v) for i, v in enumerate(values)]
    rnd.shuffle(rows)
    from tabloom.functions.text import clean_value

    cells = spark.createDataFrame(rows, "k int, page bigint, row int, value string").withColumn("value", clean_value(F.col("value")))
    if across_pages:
        types = infer.infer_types(cells, ["k"], "row", "page")
    else:
        types = infer.infer_types(cells.withColumn("row", F.col("page") * 3 + F.col("row")), ["k"], "row")
    assert {r["k"]: r["type"] for r in types.collect()} == want


def page(headers, *rows):
    cells = "".join(f"<th>{h}</th>" for h in headers)
    return f"<table><tr>{cells}</tr>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


def schemas(spark, *pages):
    from tabloom.operators.extract import extract_tables

    df = spark.createDataFrame(list(enumerate(pages)), "page_id bigint, html string")
    found = publish.infer_schemas(publish.place_by_page(extract_tables(df))).orderBy("page_id").collect()
    return [[(c["name"], c["type"]) for c in r["columns"]] for r in found]


MADE = {
    "BIGINT": lambda r: f"{r.randrange(10**6):,}", "DOUBLE": lambda r: f"{r.random() * 90 + 1:.3f}", "DATE": lambda r: f"20{r.randrange(10, 30)}-0{r.randrange(1, 9)}-1{r.randrange(9)}",
    "TIMESTAMP": lambda r: f"1999-12-0{r.randrange(1, 9)} 0{r.randrange(9)}:30:00", "VARCHAR(512)": lambda r: f"w{r.randrange(99)} q", "TEXT": lambda r: "q" * r.randrange(513, 700),
}


def test_schemas(spark):
    """Columns of generated values get the type they were generated for, page by page."""
    rnd = random.Random(31)
    pages, want = [], []
    for _ in range(25):
        types = [rnd.choice(list(MADE)) for _ in range(rnd.randint(1, 6))]
        headers = [f"Col{rnd.randrange(5)}" for _ in types]
        rows = [[MADE[t](rnd) if rnd.random() < 0.8 else "" for t in types] for _ in range(6)] + [[MADE[t](rnd) for t in types]]
        pages.append(page(headers, *rows))
        counts: dict = {}
        names = []
        for h in headers:
            counts[h] = counts.get(h, 0) + 1
            names.append(h.lower() + (f"_{counts[h]}" if counts[h] > 1 else ""))
        want.append(list(zip(names, types)))
    assert schemas(spark, *pages) == want


def test_any_page_id(spark):
    """Null, repeated and text ids: every page has its own schema and all its rows."""
    made = page(["k", "k"], ["1", "two"])
    df = spark.createDataFrame([("u1", made), ("u1", made), (None, made), ("u1", page(["z"], ["9"])), (None, "<p>")], "page_id string, html string")
    got = publish.messages_and_rejects(df, "T", css_class=None).collect()
    values = sorted(json.dumps(json.loads(r["value"])["record"]) for r in got if r["value"])
    assert values == sorted([json.dumps({"k": "1", "k_2": "two"})] * 3 + [json.dumps({"z": "9"})])
    assert [(r["page_id"], r["reason"]) for r in got if r["reason"]] == [(None, "no_table")]


def test_ddl(spark):
    columns = F.expr("array(named_struct('name','order_','type','DOUBLE'), named_struct('name','day','type','DATE'))")
    row = spark.range(1).select(
        ddl.create_table_sql(sanitise_name(F.lit("My Table")), columns, "mysql"), ddl.create_table_sql(F.lit('a"b'), columns, "postgres")
    ).first()
    assert row[0] == (
        "CREATE TABLE IF NOT EXISTS `my_table` (\n  `_id` BIGINT AUTO_INCREMENT PRIMARY KEY,\n"
        "  `_row_hash` VARCHAR(64) NOT NULL UNIQUE,\n  `order_` DOUBLE,\n  `day` DATE\n)"
    )
    assert row[1] == (
        'CREATE TABLE IF NOT EXISTS "a""b" (\n  "_id" BIGSERIAL PRIMARY KEY,\n'
        '  "_row_hash" VARCHAR(64) NOT NULL UNIQUE,\n  "order_" DOUBLE PRECISION,\n  "day" DATE\n)'
    )


def test_messages_parse_pages_once(spark, tmp_path):
    """Types, names and rows of a page come from one extraction and one exchange."""
    pages = [(i, page(["a", "b"], [str(i), "x"], ["2", "y"])) for i in range(20)]
    spark.createDataFrame(pages, "page_id bigint, html string").write.parquet(str(tmp_path / "pages"))
    messages = publish.build_messages(spark.read.parquet(str(tmp_path / "pages")), "T", css_class=None)
    assert messages.count() == 40
    assert plan_of(messages.select("value"), "MapInArrow", "ReusedExchange") == [1, 2]


def plan_of(df, *operators):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [plan.count(o) for o in operators]


def test_schemas_parse_pages_once(spark, tmp_path):
    from tabloom.operators.extract import extract_tables

    pages = [(i, page(["a", "b"], [str(i), "x"], ["2", "y"])) for i in range(20)]
    spark.createDataFrame(pages, "page_id bigint, html string").write.parquet(str(tmp_path / "pages"))
    tables = extract_tables(spark.read.parquet(str(tmp_path / "pages")))
    assert plan_of(publish.infer_schemas(publish.place_by_page(tables)), "MapInArrow", "ReusedExchange") == [1, 1]


@pytest.mark.parametrize("seed", [1, 2])
def test_types_of_pages_in_batches(spark, tmp_path, seed):
    """Pages in any order and any batches, one batch repeated, columns that come late or stay empty."""
    r = random.Random(seed)
    rows = [
        (k, page, row, r.choice(SAMPLES[r.choice(["", *kinds])]))
        for k in range(60) for kinds in [r.sample("IFTAS", r.randint(0, 2))] for page in range(k % 5, 9) for row in range(3)
    ]
    cells = spark.createDataFrame(rows, "k int, page int, row int, value string")
    batch_of = {page: r.randrange(4) for page in range(9)}
    for batch in (0, 1, 1, 2, 3):
        mine = cells.filter(F.col("page").isin([p for p, b in batch_of.items() if b == batch]))
        types = growing.absorb_pages(mine, str(tmp_path), batch, ["k"], "row", "page")
        seen = cells.filter(F.col("page").isin([p for p, b in batch_of.items() if b <= batch]))
        if batch in (1, 3):
            assert sorted(types.collect()) == sorted(infer.infer_types(seen, ["k"], "row", "page").collect())
