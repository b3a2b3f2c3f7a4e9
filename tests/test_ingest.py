import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tabloom.operators import dedupe, envelope, load
from tabloom.plans import ingest
from tabloom.sources import jdbc, topic
from tabloom.sources.tables import BUCKETS, TableStore, bucket
from tabloom.streaming.ingest import running_totals, start_ingest


def message(table, record, columns=(("a", "BIGINT"), ("b", "DATE"))):
    named = [{"name": n, "type": t} for n, t in columns]
    return json.dumps({"schema": {"table_name": table, "columns": named}, "record": record})


def frame(spark, values):
    return spark.createDataFrame([(v, i % 3, i) for i, v in enumerate(values)], topic.POSITIONED_DDL)


GOOD = message("t", {"a": "1"})
MALFORMED = {
    "": "not_json", "nope": "not_json", GOOD + "x": "not_json", GOOD + "]": "not_json", f"{GOOD},{GOOD}": "not_json",
    GOOD + "] }": "not_json", GOOD[:-1]: "not_json", "null": "no_table_name", "[]": "no_table_name", "5": "no_table_name",
    '{"record":{}}': "no_table_name", '{"schema":{"table_name":7,"columns":[]},"record":{}}': "no_table_name",
    '{"schema":{"table_name":"t"},"record":{}}': "bad_schema", '{"schema":{"table_name":"t","columns":[]},"record":{}}': "bad_schema",
    '{"schema":{"table_name":"t","columns":[{"name":"a","type":5}]},"record":{}}': "bad_schema",
    GOOD.split(', "record"')[0] + "}": "no_record", message("t", {"a": 1}): "non_string_value", message("t", {"a": {}}): "non_string_value",
    message("t", {"a": True}): "non_string_value",
}


def test_decode(spark):
    values = [GOOD, GOOD + " \n", message("t", {"a": None, "z": "é"}), *MALFORMED]
    rows = envelope.decode_messages(frame(spark, values)).orderBy("offset").collect()
    assert {r["value"]: r["reason"] for r in rows[3:]} == MALFORMED
    assert [r["reason"] for r in rows[:3]] == [None] * 3
    assert rows[0]["record"] == {"a": "1"} and rows[2]["record"] == {"a": "", "z": "é"}
    assert rows[0]["schema"]["columns"][1] == ("b", "DATE")


def test_filters_do_not_decode_again(spark):
    good = envelope.well_formed(envelope.decode_messages(frame(spark, [GOOD])))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("static_invoke(VariantExpressionEvalUtils.parseJson") <= 1 and plan.count("parse_json") <= 2


def test_judge_rows(spark):
    records = [{"a": "1,000", "b": "05/06/2024"}, {"a": "x"}, {"b": "2024-01-01 10:00:00", "z": "kept out"}, {"a": "", "b": "soon"}]
    df = spark.createDataFrame([(r,) for r in records], "record map<string,string>").withColumn(
        "columns", F.expr("array(named_struct('name','a','type','BIGINT'))")
    )
    rows = load.judge_rows(df, [("a", "BIGINT"), ("b", "DATE")]).collect()
    assert [r["reason"] for r in rows] == [None, "bad_value", None, "bad_value"]
    assert rows[0]["typed"]["a"] == 1000 and str(rows[0]["typed"]["b"]) == "2024-05-06" and str(rows[2]["typed"]["b"]) == "2024-01-01"
    assert json.loads(rows[3]["detail"]) == [{"column": "b", "value": "soon"}]
    long = spark.createDataFrame([({"s": "é" * 513},)], "record map<string,string>").withColumn("columns", F.expr("array(named_struct('name','s','type','TEXT'))"))
    assert load.judge_rows(long, [("s", "VARCHAR(512)")]).first()["reason"] is None
    assert load.judge_rows(long, [("s", "VARCHAR(512)")], enforce_length=True).first()["reason"] == "bad_value"


@pytest.mark.parametrize("known", [True, False])
def test_skip_existing(spark, known):
    batch = spark.createDataFrame([("t", str(i)) for i in range(50)], "table_name string, _row_hash string")
    target = batch.filter("cast(_row_hash as int) % 2 = 0").union(spark.createDataFrame([("u", "1")], batch.schema))
    fresh = dedupe.skip_existing(batch, target, ["table_name", "_row_hash"], 50 if known else None)
    assert sorted(int(r[1]) for r in fresh.collect()) == list(range(1, 50, 2))


def test_ids_are_dense_and_ordered_under_skew(spark):
    """One table holds most rows; slices keep any single task small, ranks stay exact."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 8, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("table_name"),
        F.sha2(F.col("id").cast("string"), 256).alias("_row_hash"),
    )
    got = dedupe.assign_ids(rows, ["table_name"], 5).collect()
    by_table = {}
    for r in sorted(got, key=lambda r: r["_row_hash"]):
        by_table.setdefault(r["table_name"], []).append(r["_id"])
    assert len(got) == 20_000 and all(ids == list(range(6, 6 + len(ids))) for ids in by_table.values())


def test_ingest_and_rerun(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    wide = (("a", "BIGINT"), ("b", "DATE"), ("c", "TEXT"))
    values = [
        *[message("t/1", {"a": str(i % 4), "b": "2024-01-0" + str(1 + i % 2)}) for i in range(12)],
        message("t/1", {"a": "one"}), message("t/1", {"a": "9", "c": "new"}, wide), message("u", {"x": "é"}, (("x", "TEXT"),)), "junk",
    ]
    for run in (0, 1):
        ingest.ingest_batch(frame(spark, values), run, store, str(tmp_path / f"stage{run}"))
    t = store.read("t/1").orderBy("_id").collect()
    assert len({r["_id"] for r in t}) == 4 and {(r["a"], r["b"].day) for r in t} == {(i, 1 + i % 2) for i in range(4)}
    assert store.columns("t/1") == [("a", "BIGINT"), ("b", "DATE")] and store.columns("u") == [("x", "TEXT")]
    assert store.columns("none") is None
    metrics = {(r["batch_id"], r["table_name"]): (r["received"], r["inserted"], r["rejected"]) for r in store.metrics().collect()}
    assert metrics == {(0, "t/1"): (14, 4, 2), (0, "u"): (1, 1, 0), (1, "t/1"): (14, 0, 2), (1, "u"): (1, 0, 0)}
    reasons = sorted(r["reason"] for r in store.rejects().filter("batch_id = 0").collect())
    assert reasons == ["bad_value", "not_json", "unknown_column"]


def test_a_bad_copy_does_not_take_a_good_one_along(spark, tmp_path):
    """The same record first arrives under a schema the table does not know."""
    store = TableStore(spark, str(tmp_path / "store"))
    store.ensure("t", [("a", "BIGINT")])
    values = [message("t", {"a": "1"}, (("a", "BIGINT"), ("z", "TEXT"))), message("t", {"a": "1"}, (("a", "BIGINT"),))]
    ingest.ingest_batch(frame(spark, values), 0, store, str(tmp_path / "stage"))
    assert [r["a"] for r in store.read("t").collect()] == [1]


@pytest.mark.parametrize("fails_in", ["tables", "keys", "rejects", "metrics", "commits"])
def test_failed_batch_is_replayed(spark, tmp_path, monkeypatch, fails_in):
    """A crash after any write loses nothing, doubles nothing and leaves true metrics."""
    store = TableStore(spark, str(tmp_path / "store"))
    columns = [(("a", "BIGINT"),), (("a", "BIGINT"),), (("a", "BIGINT"), ("c", "TEXT"))]
    values = [message(f"t{i % 3}", {"a": str(i)}, columns[i % 3]) for i in range(30)] + [message("t0", {"a": "bad"}, columns[0])]
    topic.publish(frame(spark, values), "parquet", partitions=1, path=str(tmp_path / "topic"))

    def run():
        stream = topic.stream_topic(spark, "parquet", topic.POSITIONED_DDL, path=str(tmp_path / "topic"))
        start_ingest(stream, store, str(tmp_path / "progress"), interval=None).awaitTermination()

    real, real_append, calls = TableStore.write, TableStore.append, []

    def append(self, *given):
        calls.append(given)
        if fails_in == "tables" and len(calls) == 1:
            raise RuntimeError("lost")
        real_append(self, *given)

    def write(self, part, *given):
        if part == fails_in:
            raise RuntimeError("lost")
        real(self, part, *given)

    monkeypatch.setattr(TableStore, "append", append)
    monkeypatch.setattr(TableStore, "write", write)
    with pytest.raises(Exception):
        run()
    monkeypatch.setattr(TableStore, "append", real_append)
    monkeypatch.setattr(TableStore, "write", real)
    run()
    run()
    assert {n: store.read(n).count() for n in store.names()} == {"t0": 10, "t1": 10, "t2": 10}
    assert all(store.read(n).select("_id").distinct().count() == 10 for n in store.names())
    metrics = {r["table_name"]: (r["received"], r["inserted"], r["rejected"]) for r in store.metrics().collect()}
    assert metrics == {"t0": (11, 10, 1), "t1": (10, 10, 0), "t2": (10, 10, 0)}
    assert [r["reason"] for r in store.rejects().collect()] == ["bad_value"]


def test_runs_keep_their_rejects(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    for run in ("one", "two"):
        ingest.ingest_batch(frame(spark, [GOOD, run]), 0, store, str(tmp_path / run), run)
    assert sorted(r["payload"] for r in store.rejects().collect()) == ["one", "two"]
    assert sorted(r["inserted"] for r in store.metrics().collect()) == [0, 1]


def test_jobs_follow_neither_tables_nor_schemas(spark, tmp_path):
    def jobs(label, messages):
        spark.sparkContext.setJobGroup(label, label)
        store = TableStore(spark, str(tmp_path / label))
        ingest.ingest_batch(frame(spark, messages), 0, store, str(tmp_path / f"{label}-stage"))
        spark.sparkContext.setJobGroup("other", "other")
        assert len(store.names()) == len(messages)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(label))

    few = jobs("few", [message(f"t{i}", {"a": "1"}) for i in range(3)])
    assert jobs("tables", [message(f"t{i}", {"a": "1"}) for i in range(150)]) <= few + 3
    assert jobs("schemas", [message(f"t{i}", {f"a{i}": "1"}, ((f"a{i}", "BIGINT"), ("b", "TEXT"))) for i in range(150)]) <= few + 3


def test_tables_of_any_schema_share_files(spark, tmp_path):
    """Every type, wide headers and names with odd signs come back under their own names and types."""
    kinds = ["BIGINT", "DOUBLE", "TIMESTAMP", "DATE", "VARCHAR(512)", "TEXT", "POINT"]
    texts = {"BIGINT": "1,000", "DOUBLE": "50%", "TIMESTAMP": "2023-04-05 06:07:08", "DATE": "2023-04-05"}
    tables = {f"t {k}/é": [(f"c{k} {i}", kinds[(i * (k + 1)) % 7]) for i in range(1 + 7 * k)] for k in range(8)}
    tables["wide"] = [(f"w{i}", "TEXT") for i in range(300)]
    values = [message(name, {n: texts.get(t, n) for n, t in columns}, columns) for name, columns in tables.items()]
    values += [message("wide", {"w299": "last"}, tables["wide"]), message("wide", {}, tables["wide"])]
    store = TableStore(spark, str(tmp_path / "store"))
    ingest.ingest_batch(frame(spark, values), 0, store, str(tmp_path / "stage"))
    want = {"BIGINT": 1000, "DOUBLE": 50.0, "TIMESTAMP": "2023-04-05 06:07:08", "DATE": "2023-04-05"}
    for name, columns in tables.items():
        rows = store.read(name)
        assert rows.columns == ["_id", "_row_hash", *(n for n, _ in columns)]
        assert [f.metadata["declared"] for f in rows.schema.fields[2:]] == [t for _, t in columns]
        full = [r for r in rows.collect() if r[2] is not None][0]
        assert [str(v) if t in ("TIMESTAMP", "DATE") else v for v, (_, t) in zip(full[2:], columns)] == [want.get(t, n) for n, t in columns]
    assert store.read("wide").count() == 3 and store.read("wide").filter("w299 = 'last'").count() == 1
    assert store.read_all(tables["wide"]).select("table_name").distinct().collect() == [("wide",)]
    cells = store.cells().filter("value is not null").groupBy("table_name").count().collect()
    assert dict(cells) == {name: len(columns) + (name == "wide") for name, columns in tables.items()}
    files = [f for f in (tmp_path / "store" / "tables").rglob("*.parquet")]
    assert {f.parent.parent.name for f in files} == {f"_width={2**k}" for k in (3, 4, 5, 6, 9)}


def test_many_tables_make_few_files(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    ingest.ingest_batch(frame(spark, [message(f"t{i}", {"a": "1"}) for i in range(2000)]), 0, store, str(tmp_path / "stage"))
    assert len(list((tmp_path / "store" / "tables").rglob("*.parquet"))) <= BUCKETS
    assert store.read("t1999").count() == 1


def test_readers_see_committed_batches_only(spark, tmp_path):
    seen = []

    class Watched(TableStore):
        def commit(self, batch):
            seen.append((self.names(), self.metrics().count(), self.rejects().count(), self.read("t").count() if self.names() else 0))
            super().commit(batch)

    store = Watched(spark, str(tmp_path / "store"))
    for k in range(2):
        ingest.ingest_batch(frame(spark, [message("t", {"a": str(k)}), message(f"u{k}", {"a": "1"}), "junk"]), k, store, str(tmp_path / "stage"))
    assert seen == [([], 0, 0, 0), (["t", "u0"], 2, 1, 1)]
    assert store.names() == ["t", "u0", "u1"] and store.read("t").count() == 2 and store.rejects().count() == 2


def test_a_committed_batch_is_not_loaded_again(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "store"))
    ingest.ingest_batch(frame(spark, [GOOD]), 0, store, str(tmp_path / "stage"))
    monkeypatch.setattr(TableStore, "write", lambda *given: pytest.fail("written again"))
    ingest.ingest_batch(frame(spark, [GOOD]), 0, store, str(tmp_path / "stage"))
    assert store.read("t").count() == 1


def test_only_folders_of_known_tables_are_read(spark, tmp_path, monkeypatch):
    """10,000 keys of five tables meet under 5 per cent of the index; keys of new tables meet none."""
    store = TableStore(spark, str(tmp_path / "store"))
    rows = spark.range(30_000).select(
        F.concat(F.lit("t"), F.col("id") % 1500).alias("table_name"), F.sha2(F.col("id").cast("string"), 256).alias("_row_hash"),
        F.col("id").alias("_id"),
    ).withColumn("_bucket", bucket(F.col("table_name")))
    store.write("keys", "old-0", rows.repartition("_bucket"), "_bucket")
    store.write("registry", "old-0", rows.select("table_name", F.expr("array(named_struct('name', 'a', 'type', 'TEXT')) columns")).distinct())
    store.commit("old-0")
    asked, keys = [], TableStore.keys

    def watched(self, buckets):
        found = keys(self, buckets)
        asked.append(len(found.inputFiles()) if not buckets else len({b for b in buckets}))
        return found

    monkeypatch.setattr(TableStore, "keys", watched)
    batch = spark.range(10_000).select(F.concat(F.lit("t"), F.col("id") % 5).alias("table_name"), F.sha2(F.col("id").cast("string"), 256).alias("_row_hash"))
    batch = batch.withColumn("_bucket", bucket(F.col("table_name")))
    fresh = ingest.skip_stored(batch, store)
    scans = fresh._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in scans and 0 < asked[-1] <= 0.05 * BUCKETS
    held = {(r["table_name"], r["_row_hash"]) for r in rows.collect()}
    want = {(r["table_name"], r["_row_hash"]) for r in batch.collect()} - held
    assert {(r["table_name"], r["_row_hash"]) for r in fresh.collect()} == want and len(want) < 10_000
    files = fresh._jdf.queryExecution().executedPlan()
    assert "PartitionFilters" in files.toString()
    new = batch.withColumn("table_name", F.concat(F.lit("new"), "table_name"))
    count = len(asked)
    assert ingest.skip_stored(new, store).count() == 10_000 and len(asked) == count


UNUSABLE = {
    message("", {"a": "1"}): "bad_table_name", message(" ", {"a": "1"}): "bad_table_name", message("n" * 300, {"a": "1"}): "bad_table_name",
    message("t", {"a": "1"}, (("a", "TEXT"), ("A", "TEXT"))): "bad_schema", message("t", {"a": "1"}, (("_ID", "TEXT"),)): "bad_schema",
    message("t", {"a": "1"}, (("_row_hash", "TEXT"),)): "bad_schema", message("t", {"a": "1"}, (("", "TEXT"),)): "bad_schema",
}


def test_unusable_names_are_set_aside(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    ingest.ingest_batch(frame(spark, [*UNUSABLE, GOOD]), 0, store, str(tmp_path / "stage"))
    assert {r["payload"]: r["reason"] for r in store.rejects().collect()} == UNUSABLE
    assert store.names() == ["t"] and store.read("t").count() == 1


def test_text_topic_without_offsets(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    topic.publish(frame(spark, [GOOD, GOOD, "x"]).select("value"), "text", path=str(tmp_path / "topic"), batch_size=1)
    stream = topic.stream_topic(spark, "text", path=str(tmp_path / "topic"))
    start_ingest(stream, store, str(tmp_path / "progress"), interval=None).awaitTermination()
    assert store.read("t").count() == 1 and store.rejects().count() == 1


def test_jdbc_column_types():
    assert jdbc.column_types([("order_", "DOUBLE"), ("s", "VARCHAR(512)"), ("x", "TEXT")]) == (
        "`_id` BIGINT, `_row_hash` VARCHAR(64), `order_` DOUBLE, `s` VARCHAR(512), `x` STRING"
    )


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_running_totals_in_blocks(spark, block):
    rows = [(batch, f"t{k}", 5, batch + k, 1) for batch in (0, 1, 2, 4, 7, 8, 9) for k in range(2)]
    metrics = spark.createDataFrame(rows, "batch_id long, table_name string, received long, inserted long, rejected long")
    got = {x["batch_id"]: (x["received"], x["inserted"], x["rejected"], x["total_inserted"]) for x in running_totals(metrics, block).collect()}
    assert got == {b: (10, 2 * b + 1, 2, sum(2 * c + 1 for c in got if c <= b)) for b in (0, 1, 2, 4, 7, 8, 9)}
    assert running_totals(metrics.limit(0), block).count() == 0


def test_bounded_files_are_full(spark, tmp_path):
    """seven tasks of unequal size leave one file that is not full, not one each."""
    values = [(GOOD, i % 2, i // 2) for i in range(1050)]
    uneven = spark.createDataFrame(values, topic.POSITIONED_DDL).repartition(7, F.expr("offset % 9"))
    topic.publish(uneven, "parquet", batch_size=100, path=str(tmp_path / "topic"))
    written = spark.read.parquet(str(tmp_path / "topic"))
    sizes = [r["count"] for r in written.groupBy(F.input_file_name()).count().collect()]
    assert sorted(sizes) == [50] + [100] * 10
    assert sorted(map(tuple, written.collect())) == sorted(values)


def test_stream_count_bound_counts_its_batches(spark, tmp_path):
    """1,003 messages in batches of 500 are three; the last holds malformed ones or good ones, as it comes."""
    import duckdb
    from tests.oracle import difference
    from workload import loading  # noqa: F401
    from workload.base import ORACLES, QUERIES

    spark.range(1003).selectExpr("id AS event_id", "id % 7 AS user_id", "if(id % 2 = 0, 'view', 'click') AS event_type").write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert "n_batches" in ORACLES["stream_count_bound"]
    assert difference(QUERIES["stream_count_bound"](spark, str(tmp_path)), con, ORACLES["stream_count_bound"]) is None


def test_few_large_files_are_spread(spark, tmp_path, monkeypatch):
    """a batch of one file is decoded by all cores, at the positions it had."""
    seen = []
    decode = ingest.decode_messages
    monkeypatch.setattr(ingest, "decode_messages", lambda df: seen.append(df.rdd.getNumPartitions()) or decode(df))
    spark.createDataFrame([(message("t", {"a": str(i)}),) for i in range(50)] + [("nope",)], "value string").coalesce(1).write.text(str(tmp_path / "topic"))
    store = TableStore(spark, str(tmp_path / "lake"))
    ingest.ingest_batch(topic.read_topic(spark, "text", path=str(tmp_path / "topic")), 0, store, str(tmp_path / "stage"))
    assert seen == [spark.sparkContext.defaultParallelism]
    assert store.read("t").count() == 50 and store.rejects().first()["key"] == "0/50"


def test_small_batches_take_few_jobs(spark, tmp_path):
    """F1 (r04): what a batch of a stream starts is bounded, and what it looks up does not come from every earlier one."""
    columns = (("a", "BIGINT"),)
    for i in range(10):  # every record of a batch but two comes again in the next ones
        values = [message("t", {"a": str(k)}, columns) for k in range(2 * i, 2 * i + 4)] + [message(f"u{i // 5}", {"a": "1"}, columns), "junk"]
        spark.createDataFrame([(v, 0, 10 * i + k) for k, v in enumerate(values)], topic.POSITIONED_DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "topic"))
    store = TableStore(spark, str(tmp_path / "store"))
    stream = topic.stream_topic(spark, "parquet", topic.POSITIONED_DDL, batch_size=1, path=str(tmp_path / "topic"))
    running = start_ingest(stream, store, str(tmp_path / "progress"), interval=None)
    running.awaitTermination()
    assert store.commits().count() == 10
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(running.runId))) <= 10 * 16
    rows = store.read("t").collect()
    assert sorted(r["a"] for r in rows) == list(range(22)) and sorted(r["_id"] for r in rows) == list(range(1, 23))
    assert store.read("u0").count() == store.read("u1").count() == 1
    assert store.metrics().agg(F.sum("received"), F.sum("inserted"), F.sum("rejected")).first() == (50, 24, 0)
    assert store.rejects().count() == 10
    rolled, single = store._folders("keys")
    assert len(rolled) == 1 and len(single) == 2
    held = lambda df: {(r["table_name"], r["_row_hash"]) for r in df.collect()}
    assert held(store.state("keys")) == held(store.visible("keys", "table_name string, _row_hash string, _batch string, _bucket int"))
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true" and spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_a_batch_leaves_no_steps_behind(spark, tmp_path):
    """F2 (r04): of a large batch nothing but the store stays on disk, and its hashes are the text they were."""
    store = TableStore(spark, str(tmp_path / "store"))
    values = [message(f"t{i % 5}", {f"a{i % 5}": str(i)}, ((f"a{i % 5}", "BIGINT"),)) for i in range(60)]
    values += [message("t0", {"a0": "one"}, (("a0", "BIGINT"),)), message("t0", {"z": "2"}, (("z", "TEXT"),)), "junk"]
    for run in (0, 1):
        ingest.ingest_batch(frame(spark, values), run, store, str(tmp_path / "stage"))
    assert not list((tmp_path / "stage").rglob("*.parquet"))
    want = {(f"t{i % 5}", hashlib.sha256(f'{{"a{i % 5}":"{i}"}}'.encode()).hexdigest()) for i in range(60)}
    rows = [(f"t{k}", r) for k in range(5) for r in store.read(f"t{k}").collect()]
    assert {(t, r["_row_hash"]) for t, r in rows} == want and len(rows) == 60
    assert {(r["table_name"], r["_row_hash"], r["_id"]) for r in store.state("keys").collect()} == {(t, r["_row_hash"], r["_id"]) for t, r in rows}
    assert sorted(r["reason"] for r in store.rejects().filter("batch_id = 1").collect()) == ["bad_value", "not_json", "unknown_column"]


def test_large_and_small_tables_are_numbered_alike(spark, tmp_path, monkeypatch):
    """F2 (r04): ids go on from the last ones, whichever way rows are ranked, and strange rows leave no gap."""
    ids = []
    for most in (10**6, 3):
        monkeypatch.setattr(ingest, "RANK_IN_ONE_TASK", most)
        store = TableStore(spark, str(tmp_path / f"store{most}"))
        for run, some in enumerate((range(20), range(10, 40))):
            values = [message("t", {"a": str(i)}, (("a", "BIGINT"),)) for i in some] + [message("t", {"b": str(i)}, (("b", "TEXT"),)) for i in some]
            ingest.ingest_batch(frame(spark, values), run, store, str(tmp_path / "stage"))
        ids.append({r["a"]: r["_id"] for r in store.read("t").collect()})
    assert ids[0] == ids[1] and sorted(ids[0]) == list(range(40)) and sorted(ids[0].values()) == list(range(1, 41))
