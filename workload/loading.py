"""Typed loads, de-duplication, table sinks and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tabloom.functions import literals
from tabloom.operators import dedupe, envelope, load
from tabloom.operators.extract import extract_tables
from tabloom.operators.slots import cast_records
from tabloom.plans.ingest import hashed_records, ingest_batch
from tabloom.plans.publish import records_with_schema
from tabloom.session import work_dir
from tabloom.sources import topic
from tabloom.sources.tables import TableStore
from tabloom.streaming.ingest import running_totals, start_ingest
from workload import fixtures
from workload.base import (
    LINEITEM_VALUES, Tables, choose, lineitem_values, query, sql_date, sql_int, sql_is_float, sql_number_text, sql_timestamp,
)
from workload.fixtures import ORDER_COLUMNS
from workload.messages import GOOD_EVENTS, event_messages

# ---- typed loads ----

_NUMBERED = f"(SELECT *, {sql_number_text('value')} AS n FROM {LINEITEM_VALUES})"
_FINITE = "regexp_matches(n, '[0-9]')"


@query(
    "typed_load",
    f"SELECT l_orderkey, l_linenumber, value, {sql_int('n')} AS as_bigint, "
    f"CASE WHEN {sql_is_float('n')} AND {_FINITE} THEN TRY_CAST(replace(n, '_', '') AS DOUBLE) END AS as_double, "
    f"strftime(coalesce({sql_timestamp('value')}, CAST({sql_date('value')} AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S.%f') AS as_timestamp, "
    f"coalesce({sql_date('value')}, CAST({sql_timestamp('value')} AS DATE)) AS as_date FROM {_NUMBERED}",
)
def typed_load(t: Tables) -> DataFrame:
    v = F.col("value")
    number = literals.load_value(v, "DOUBLE")
    return lineitem_values(t).withColumns(
        {
            "as_bigint": literals.load_value(v, "BIGINT"),
            "as_double": F.when(F.abs(number) < float("inf"), number),
            "as_timestamp": F.date_format(literals.load_value(v, "TIMESTAMP"), "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            "as_date": literals.load_value(v, "DATE"),
        }
    )


_MOMENT = f"(({sql_timestamp('value')}) IS NOT NULL OR ({sql_date('value')}) IS NOT NULL)"


@query(
    "quarantine_bad_rows",
    f"SELECT l_orderkey, l_linenumber, column_name, value FROM (SELECT *, CASE column_name "
    f"WHEN 'a' THEN ({sql_int('n')}) IS NOT NULL WHEN 'b' THEN {sql_is_float('n')} ELSE {_MOMENT} END AS ok "
    f"FROM {_NUMBERED}, (VALUES ('a'), ('b'), ('c')) x(column_name)) WHERE NOT ok",
)
def quarantine_bad_rows(t: Tables) -> DataFrame:
    v = F.col("value")
    record = F.create_map(*[x for n in "abcd" for x in (F.lit(n), v)])
    columns = F.expr(
        "array(named_struct('name','a','type','BIGINT'), named_struct('name','b','type','DOUBLE'), "
        "named_struct('name','c','type',if(l_linenumber % 2 = 0, 'DATE', 'TIMESTAMP')), named_struct('name','d','type','TEXT'))"
    )
    values = lineitem_values(t).select("l_orderkey", "l_linenumber", record.alias("record"), columns.alias("stored"))
    return cast_records(values, "stored").select("l_orderkey", "l_linenumber", F.explode("bad").alias("b")).select(
        "l_orderkey", "l_linenumber", F.col("b.column").alias("column_name"), "b.value"
    )


TYPED_ORDERS_SQL = """SELECT o_orderkey // 100 AS page_id, o_orderstatus AS status, o_orderkey AS order_,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS price, o_custkey % 100 AS price_2,
    CAST(o_orderdate AS DATE) AS placed, CAST(o_orderdate AS DATE) AS shipped, o_orderpriority AS priority,
    CAST(NULL AS BIGINT) AS note FROM orders"""


@query("typed_table", TYPED_ORDERS_SQL)
def typed_table(t: Tables) -> DataFrame:
    """Pages to typed rows: extraction, inference, naming, records and a load by the inferred types."""
    path = work_dir(t.spark, "records")
    records_with_schema(extract_tables(fixtures.orders_pages(t), "wikitable")).select("page_id", "schema.columns", "record").write.parquet(path)
    records = t.spark.read.parquet(path)
    parts = []
    for row in records.select("columns").distinct().collect():  # a row for each distinct schema
        columns = [(c["name"], c["type"]) for c in row["columns"]]
        types = F.transform("columns", lambda c: F.concat_ws(" ", c["name"], c["type"]))
        mine = records.filter(types == F.array(*[F.lit(f"{n} {d}") for n, d in columns]))
        parts.append(mine.select("page_id", *load.typed_columns(F.col("record"), columns)))
    return reduce(DataFrame.unionByName, parts)


# ---- de-duplication ----

_RECORD_JSON = (
    "'{\"kind\":\"' || event_type || '\"' || CASE WHEN event_id % 10 = 3 THEN ',\"late\":\"\"' ELSE '' END "
    "|| ',\"user_id\":\"' || user_id || '\"}'"
)
_HASHED = f"(SELECT event_type AS table_name, sha256({_RECORD_JSON}) AS row_hash, event_id, part FROM {GOOD_EVENTS})"


def hashed_events(t: Tables) -> DataFrame:
    good = envelope.well_formed(envelope.decode_messages(event_messages(t)))
    return hashed_records(good)


@query("dedupe_batch", f"SELECT DISTINCT table_name, row_hash FROM {_HASHED}")
def dedupe_batch(t: Tables) -> DataFrame:
    distinct = dedupe.dedupe_batch(hashed_events(t), ["table_name", "_row_hash"])
    return distinct.select("table_name", F.col("_row_hash").alias("row_hash"))


def _append(t: Tables, known_size: bool) -> DataFrame:
    keys = ["table_name", "_row_hash"]
    # Decoded once into the shared folder; the batch and the target both read it there.
    path = work_dir(t.spark, "hashed")
    hashed_events(t).select(*keys, "partition").write.parquet(path)
    hashed = t.spark.read.parquet(path)
    target = dedupe.dedupe_batch(hashed.filter("partition < 4"), keys)
    batch = dedupe.dedupe_batch(hashed, keys)
    rows = batch.count() if known_size else None
    return dedupe.skip_existing(batch, target, keys, rows).select("table_name", F.col("_row_hash").alias("row_hash"))


# The earliest copy decides which delivery a record belongs to; partitions come first.
_FRESH = f"SELECT table_name, row_hash FROM {_HASHED} GROUP BY 1, 2 HAVING min(part) >= 4"


@query("idempotent_append", _FRESH)
def idempotent_append(t: Tables) -> DataFrame:
    return _append(t, known_size=True)


@query("idempotent_append_large_batch", _FRESH)
def idempotent_append_large_batch(t: Tables) -> DataFrame:
    """The way taken when the batch is too large to broadcast, or of unknown size."""
    return _append(t, known_size=False)


@query(
    "assign_ids",
    f"SELECT table_name, row_hash, row_number() OVER (PARTITION BY table_name ORDER BY row_hash) + "
    f"CASE WHEN table_name = 'click' THEN 1000 ELSE 0 END AS id FROM (SELECT DISTINCT table_name, row_hash FROM {_HASHED})",
)
def assign_ids(t: Tables) -> DataFrame:
    rows = dedupe.dedupe_batch(hashed_events(t), ["table_name", "_row_hash"]).select("table_name", "_row_hash")
    start = t.spark.createDataFrame([("click", 1000)], "table_name string, max_id bigint")
    return dedupe.assign_ids(rows, ["table_name"], start).select(
        "table_name", F.col("_row_hash").alias("row_hash"), F.col("_id").alias("id")
    )


# ---- sinks and streams: events without schema changes ----


def plain_messages(t: Tables) -> DataFrame:
    late = ',{"name":"late","type":"DATE"}'
    return event_messages(t).withColumn("value", F.replace("value", F.lit(late), F.lit("")))


def loaded(store: TableStore) -> DataFrame:
    """All tables of a store, one below the other."""
    tables = [store.read(n).select(F.lit(n).alias("table_name"), "*") for n in store.names()]
    return reduce(DataFrame.unionByName, tables)


def new_store(t: Tables, label: str) -> TableStore:
    return TableStore(t.spark, work_dir(t.spark, label))


_COLUMN_VALUES = ", ".join(f"({i}, '{n}', '{d}')" for i, (n, d) in enumerate(ORDER_COLUMNS))


@query(
    "ensure_table",
    f"SELECT table_name, c.pos, c.name, c.type FROM (SELECT DISTINCT event_type AS table_name FROM events), (VALUES {_COLUMN_VALUES}) c(pos, name, type)",
)
def ensure_table(t: Tables) -> DataFrame:
    """Create all tables, then again with another schema: the first one stays."""
    store = new_store(t, "ensure")
    names = t.events.select(F.col("event_type").alias("table_name")).distinct()
    for batch, columns in enumerate((ORDER_COLUMNS, [("other", "TEXT")])):
        listed = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(d).alias("type")) for n, d in columns])
        store.ensure_all(names.withColumn("columns", listed), f"ensure-{batch}")
        store.commit(f"ensure-{batch}")
    return store.registry().select("table_name", F.posexplode("columns").alias("pos", "c")).select("table_name", "pos", "c.name", "c.type")


@query("sink_append", f"SELECT DISTINCT table_name, row_hash FROM {_HASHED}")
def sink_append(t: Tables) -> DataFrame:
    store = new_store(t, "append")
    ingest_batch(plain_messages(t), 0, store, f"{store.root}/stage")
    return loaded(store).select("table_name", F.col("_row_hash").alias("row_hash"))


@query(
    "rerun_idempotent",
    f"SELECT table_name, run, CASE run WHEN 0 THEN count(DISTINCT row_hash) ELSE 0 END AS inserted, count(*) AS received "
    f"FROM {_HASHED}, (VALUES (0), (1)) r(run) GROUP BY 1, 2",
)
def rerun_idempotent(t: Tables) -> DataFrame:
    store = new_store(t, "rerun")
    for run in (0, 1):
        ingest_batch(plain_messages(t), run, store, f"{store.root}/stage-{run}")
    return store.metrics().select("table_name", F.col("batch_id").cast("int").alias("run"), "inserted", "received")


@query(
    "load_metrics",
    f"WITH firsts AS (SELECT table_name, row_hash, min(CASE WHEN part < 4 THEN 0 ELSE 1 END) AS batch FROM {_HASHED} GROUP BY 1, 2), "
    f"got AS (SELECT CASE WHEN part < 4 THEN 0 ELSE 1 END AS batch, count(*) AS received FROM {_HASHED} GROUP BY 1) "
    "SELECT got.batch AS batch_id, received, inserted, CAST(sum(inserted) OVER (ORDER BY got.batch) AS BIGINT) AS total_inserted "
    "FROM got JOIN (SELECT batch, count(*) AS inserted FROM firsts GROUP BY 1) i ON got.batch = i.batch",
)
def load_metrics(t: Tables) -> DataFrame:
    store = new_store(t, "metrics")
    for batch, part in enumerate(("partition < 4", "partition >= 4")):
        ingest_batch(plain_messages(t).filter(part), batch, store, f"{store.root}/stage-{batch}")
    return running_totals(store.metrics()).select(
        F.col("batch_id").cast("int").alias("batch_id"), "received", "inserted", "total_inserted"
    )


def _drain(t: Tables, store: TableStore, source: str, checkpoint: str) -> None:
    stream = topic.stream_topic(t.spark, "parquet", topic.POSITIONED_DDL, path=source)
    start_ingest(stream, store, checkpoint, interval=None).awaitTermination()


@query(
    "stream_ingest",
    f"SELECT DISTINCT event_type AS table_name, user_id, event_type AS kind FROM {GOOD_EVENTS} WHERE event_id % 10 <> 3 "
    f"UNION ALL SELECT DISTINCT event_type, user_id, event_type FROM {GOOD_EVENTS} WHERE event_id % 10 = 3",
)
def stream_ingest(t: Tables) -> DataFrame:
    """Rows with and without an empty ``late`` differ in their hash, so both are kept."""
    store = new_store(t, "stream")
    topic.publish(plain_messages(t), "parquet", partitions=2, path=f"{store.root}-topic")
    _drain(t, store, f"{store.root}-topic", f"{store.root}-progress")
    return loaded(store).select("table_name", "user_id", "kind")


@query(
    "stream_replay",
    f"SELECT table_name, count(DISTINCT row_hash) AS n_rows, count(DISTINCT row_hash) AS max_id, count(*) * 2 AS received FROM {_HASHED} GROUP BY 1",
)
def stream_replay(t: Tables) -> DataFrame:
    """The whole topic arrives twice, with a stop in between: the second pass adds nothing."""
    store = new_store(t, "replay")
    for _ in range(2):
        topic.publish(plain_messages(t), "parquet", partitions=2, path=f"{store.root}-topic")
        _drain(t, store, f"{store.root}-topic", f"{store.root}-progress")
    sizes = loaded(store).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"), F.max("_id").alias("max_id"))
    received = store.metrics().groupBy("table_name").agg(F.sum("received").alias("received"))
    return sizes.join(received, "table_name")


# A table and a schema of its own for every thousandth event.
_ROOM = "CAST(event_id % 1000 AS STRING)"
_ROOM_KINDS = ["BIGINT", "DOUBLE", "DATE", "VARCHAR(512)"]


def room_messages(t: Tables) -> DataFrame:
    kind = choose("event_id % 4", _ROOM_KINDS, "'TEXT'")
    value = "CASE event_id % 4 WHEN 2 THEN '2024-02-' || (10 + user_id % 19) ELSE CAST(user_id AS STRING) END"
    text = (
        f"""concat('{{"schema":{{"table_name":"room_', {_ROOM}, '","columns":[{{"name":"v', {_ROOM}, '","type":"', {kind}, '"}},"""
        f"""{{"name":"kind","type":"TEXT"}}]}},"record":{{"v', {_ROOM}, '":"', {value}, '","kind":"', event_type, '"}}}}')"""
    )
    return t.events.select(F.expr(text).alias("value"), (F.col("event_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"))


@query(
    "stream_fanout",
    "WITH e AS (SELECT DISTINCT event_id % 1000 AS room, event_type, CASE event_id % 4 WHEN 2 THEN user_id % 19 ELSE user_id END AS v FROM events) "
    "SELECT 'room_' || room AS table_name, 'v' || room AS name, count(*) AS n_rows, "
    "CAST(sum(CASE room % 4 WHEN 2 THEN 10 + v ELSE v END) AS BIGINT) AS total FROM e GROUP BY room "
    "UNION ALL SELECT 'room_' || room, 'kind', count(*), CAST(sum(length(event_type)) AS BIGINT) FROM e GROUP BY room",
)
def stream_fanout(t: Tables) -> DataFrame:
    """Two deliveries feed a thousand tables, each created on first sight with columns of its own."""
    store = new_store(t, "fanout")
    for part in ("offset % 3 = 0", "offset % 3 > 0"):
        topic.publish(room_messages(t).filter(part), "parquet", path=f"{store.root}-topic")
        _drain(t, store, f"{store.root}-topic", f"{store.root}-progress")
    number = F.when(F.col("column") == "kind", F.length("value")).when(F.col("type") == "DATE", F.day(F.col("value").cast("date")))
    total = F.sum(F.coalesce(number, F.col("value").cast("double")).cast("long")).alias("total")
    return store.cells().groupBy("table_name", F.col("column").alias("name")).agg(F.count("*").alias("n_rows"), total)


_PART_VALUE = (
    "CASE l_partkey % 4 WHEN 0 THEN CASE WHEN l_linenumber = 6 THEN 'n/a' ELSE CAST(l_orderkey AS STRING) || ',000' END "
    "WHEN 1 THEN '$' || CAST(l_linenumber AS STRING) || '.5' WHEN 2 THEN CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 09:30:00' "
    "ELSE l_returnflag || l_linestatus END"
)
_PART_KINDS = ["BIGINT", "DOUBLE", "TIMESTAMP"]


@query(
    "ingest_many_schemas",
    f"WITH v AS (SELECT DISTINCT l_partkey, {_PART_VALUE} AS value, l_linenumber AS line FROM lineitem), "
    "k AS (SELECT 'part_' || l_partkey AS table_name, 'v' || l_partkey AS name, CASE l_partkey % 4 WHEN 0 THEN replace(value, ',', '') "
    "WHEN 1 THEN replace(value, '$', '') ELSE value END AS value, line FROM v WHERE value <> 'n/a') "
    "SELECT table_name, name, count(*) AS n_rows, min(value) AS low, max(value) AS high FROM k GROUP BY 1, 2 "
    "UNION ALL SELECT table_name, 'line', count(*), CAST(min(line) AS VARCHAR), CAST(max(line) AS VARCHAR) FROM k GROUP BY 1 "
    "UNION ALL SELECT 'part_' || l_partkey, 'aside', count(*), NULL, NULL FROM v WHERE value = 'n/a' GROUP BY 1",
)
def ingest_many_schemas(t: Tables) -> DataFrame:
    """Line items into a table for each part, no two with the same columns, in one batch."""
    kind = choose("l_partkey % 4", _PART_KINDS, "'TEXT'")
    text = (
        """concat('{"schema":{"table_name":"part_', l_partkey, '","columns":[{"name":"v', l_partkey, '","type":"', """ + kind
        + """, '"},{"name":"line","type":"BIGINT"}]},"record":{"v', l_partkey, '":"', """ + _PART_VALUE + """, '","line":"', l_linenumber, '"}}')"""
    )
    store = new_store(t, "schemas")
    ingest_batch(t.lineitem.select(F.expr(text).alias("value")), 0, store, f"{store.root}/stage")
    kept = store.cells().groupBy("table_name", F.col("column").alias("name"))
    kept = kept.agg(F.count("*").alias("n_rows"), F.min("value").alias("low"), F.max("value").alias("high"))
    aside = store.rejects().groupBy(F.split_part("key", F.lit("/"), F.lit(1)).alias("table_name"), F.lit("aside").alias("name"))
    none = F.lit(None).cast("string")
    return kept.unionByName(aside.agg(F.count("*").alias("n_rows")).withColumns({"low": none, "high": none}))


class _Watched(TableStore):
    """A store that looks at itself, as a reader does, just before each batch is committed."""

    def commit(self, batch: str) -> None:
        path = f"{self.root}-seen/{batch}"
        self.counts(batch).write.parquet(path)
        super().commit(batch)

    def counts(self, moment: str) -> DataFrame:
        rows = loaded(self) if self.names() else self.spark.createDataFrame([], "table_name string")
        stored = rows.agg(F.count("*").alias("n_rows"), F.count_distinct("table_name").alias("n_tables"))
        received = self.metrics().agg(F.coalesce(F.sum("received"), F.lit(0)).cast("long").alias("received"))
        return stored.join(received).withColumn("moment", F.lit(moment))


@query(
    "read_during_batch",
    f"WITH m(moment, below) AS (VALUES ('run-0', 0), ('run-1', 4), ('after', 100)) "
    "SELECT moment, count(DISTINCT (table_name, row_hash)) FILTER (part < below) AS n_rows, count(DISTINCT table_name) FILTER (part < below) AS n_tables, "
    f"count(*) FILTER (part < below) AS received FROM m, {_HASHED} GROUP BY 1",
)
def read_during_batch(t: Tables) -> DataFrame:
    """What a reader sees when all of a batch is written but not committed: nothing of it."""
    store = _Watched(t.spark, work_dir(t.spark, "watched"))
    for batch, part in enumerate(("partition < 4", "partition >= 4")):
        ingest_batch(plain_messages(t).filter(part), batch, store, f"{store.root}/stage-{batch}")
    after = store.counts("after")
    return t.spark.read.schema(after.schema).parquet(f"{store.root}-seen/*").unionByName(after)


_BOUND = 500


@query(
    "stream_count_bound",
    f"SELECT CAST(ceil(count(*) / {_BOUND}.0) AS BIGINT) AS n_batches, (SELECT count(*) FROM {GOOD_EVENTS}) AS received, true AS bounded FROM events",
)
def stream_count_bound(t: Tables) -> DataFrame:
    """Micro-batches of a bounded number of messages: files of so many, one file a batch, written by all partitions."""
    store = new_store(t, "bound")
    topic.publish(plain_messages(t), "parquet", batch_size=_BOUND, path=f"{store.root}-topic")
    stream = topic.stream_topic(t.spark, "parquet", topic.POSITIONED_DDL, batch_size=1, path=f"{store.root}-topic")
    start_ingest(stream, store, f"{store.root}-progress", interval=None).awaitTermination()
    batches = store.metrics().groupBy("batch_id").agg(F.sum("received").alias("received"))
    whole = batches.agg(F.sum("received").alias("received"), (F.max("received") <= _BOUND).alias("bounded"))
    # Commits, not metrics: a batch of malformed messages only counts too.
    return store.commits().agg(F.count("*").alias("n_batches")).crossJoin(whole)


@query(
    "stream_timed_stop",
    f"SELECT table_name, count(DISTINCT row_hash) AS n_rows, count(*) AS received FROM {_HASHED} GROUP BY 1",
)
def stream_timed_stop(t: Tables) -> DataFrame:
    """A timed trigger, stopped by hand after the first half and started again for the second."""
    store = new_store(t, "timed")
    for part in ("offset % 2 = 0", "offset % 2 = 1"):
        topic.publish(plain_messages(t).filter(part), "parquet", path=f"{store.root}-topic")
        stream = topic.stream_topic(t.spark, "parquet", topic.POSITIONED_DDL, path=f"{store.root}-topic")
        running = start_ingest(stream, store, f"{store.root}-progress", interval="1 second")
        running.processAllAvailable()
        running.stop()
    sizes = loaded(store).groupBy("table_name").agg(F.count("*").alias("n_rows"))
    return sizes.join(store.metrics().groupBy("table_name").agg(F.sum("received").alias("received")), "table_name")


_BAD_NAME = "CASE user_id % 5 WHEN 0 THEN '' WHEN 1 THEN repeat('n', 300) ELSE event_type END"
_BAD_COLUMN = "CASE user_id % 7 WHEN 0 THEN 'Kind' WHEN 1 THEN '_id' WHEN 2 THEN '_row_hash' ELSE 'more' END"


@query(
    "ingest_bad_schemas",
    "SELECT outcome, aside, CASE WHEN aside THEN count(*) ELSE count(DISTINCT (event_type, user_id)) END AS n_rows FROM "
    "(SELECT *, outcome <> 'stored' AS aside FROM (SELECT event_type, user_id, CASE WHEN user_id % 5 < 2 THEN 'bad_table_name' "
    "WHEN user_id % 7 < 3 THEN 'bad_schema' ELSE 'stored' END AS outcome FROM events)) GROUP BY 1, 2",
)
def ingest_bad_schemas(t: Tables) -> DataFrame:
    """Names and columns no table can have are set aside; good tables of the same batch load."""
    text = (
        """concat('{"schema":{"table_name":"', """ + _BAD_NAME + """, '","columns":[{"name":"kind","type":"TEXT"},{"name":"', """ + _BAD_COLUMN
        + """, '","type":"TEXT"}]},"record":{"kind":"', event_type, '","more":"', user_id, '"}}')"""
    )
    store = new_store(t, "bad-schemas")
    ingest_batch(t.events.select(F.expr(text).alias("value")), 0, store, f"{store.root}/stage")
    aside = store.rejects().groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("n_rows"))
    kept = loaded(store).agg(F.lit("stored").alias("outcome"), F.count("*").alias("n_rows"))
    return aside.withColumn("aside", F.lit(True)).unionByName(kept.withColumn("aside", F.lit(False)))


_VALUE = "CASE WHEN event_id % 11 = 0 THEN 'x' || (event_id % 30) ELSE CAST(event_id % 50 AS STRING) END"


@query(
    "ingest_bad_values",
    "SELECT table_name, outcome, count(DISTINCT value) AS n_rows FROM (SELECT event_type AS table_name, "
    f"CASE WHEN event_id % 11 = 0 THEN 'bad_value' ELSE 'stored' END AS outcome, {_VALUE.replace('STRING', 'VARCHAR')} AS value FROM events) GROUP BY 1, 2",
)
def ingest_bad_values(t: Tables) -> DataFrame:
    """Values their column cannot take are set aside by the loader; the rest of the batch is stored."""
    text = (
        """concat('{"schema":{"table_name":"', event_type, '","columns":[{"name":"n","type":"BIGINT"}]},"record":{"n":"', """ + _VALUE + """, '"}}')"""
    )
    store = new_store(t, "bad-values")
    ingest_batch(t.events.select(F.expr(text).alias("value")), 0, store, f"{store.root}/stage")
    aside = store.rejects().groupBy(F.split_part("key", F.lit("/"), F.lit(1)).alias("table_name"), F.col("reason").alias("outcome"))
    kept = loaded(store).groupBy("table_name", F.lit("stored").alias("outcome"))
    return aside.agg(F.count("*").alias("n_rows")).unionByName(kept.agg(F.count("n").alias("n_rows")))


@query(
    "ingest_many_tables",
    "SELECT 'user_' || user_id AS table_name, count(DISTINCT event_type) AS n_rows, count(DISTINCT event_type) AS last_id, "
    "count(*) * 2 AS received FROM events GROUP BY 1",
)
def ingest_many_tables(t: Tables) -> DataFrame:
    """A table for each user, loaded twice: jobs follow schemas, not tables."""
    text = """concat('{"schema":{"table_name":"user_', user_id, '","columns":[{"name":"kind","type":"TEXT"}]},"record":{"kind":"', event_type, '"}}')"""
    store = new_store(t, "many")
    for batch in (0, 1):
        ingest_batch(t.events.select(F.expr(text).alias("value")), batch, store, f"{store.root}/stage-{batch}")
    return store.metrics().groupBy("table_name").agg(
        F.sum("inserted").alias("n_rows"), F.max("last_id").alias("last_id"), F.sum("received").alias("received")
    )


@query(
    "schema_drift",
    f"SELECT event_type AS table_name, 'unknown_column' AS reason, count(DISTINCT (user_id, event_id % 10 = 3)) AS n_rows "
    f"FROM {GOOD_EVENTS} WHERE event_id > 5000 GROUP BY 1 UNION ALL "
    f"SELECT event_type, 'stored', count(DISTINCT (user_id, event_id % 10 = 3)) FROM {GOOD_EVENTS} WHERE event_id <= 5000 GROUP BY 1",
)
def schema_drift(t: Tables) -> DataFrame:
    """Later messages name a column the stored tables lack: they are set aside, the tables keep their schema."""
    store = new_store(t, "drift")
    for part in ("offset <= 5000", "offset > 5000"):
        topic.publish(event_messages(t).filter(part), "parquet", path=f"{store.root}-topic")
        _drain(t, store, f"{store.root}-topic", f"{store.root}-progress")
    aside = store.rejects().filter("stage = 'load'").groupBy(
        F.split_part("key", F.lit("/"), F.lit(1)).alias("table_name"), "reason"
    ).agg(F.count(F.lit(1)).alias("n_rows"))
    kept = loaded(store).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return aside.unionByName(kept.select("table_name", F.lit("stored").alias("reason"), "n_rows"))
