"""From messages to destination tables.

A batch is decoded once into a stage folder. All its tables are then handled together:
schemas, conflicts, casts, ids and metrics are joins, expressions and aggregates over rows that
bring their table's schema along, so the number of Spark jobs grows neither with the tables
of a batch nor with its schemas.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.functions.canonical import hash_text, row_hash
from tabloom.operators.dedupe import RANK_IN_ONE_TASK, assign_ids, dedupe_batch
from tabloom.operators.envelope import decode_messages, first_schemas, malformed, well_formed
from tabloom.operators.once import built_once
from tabloom.operators.slots import cast_records
from tabloom.sources.tables import TableStore, bucket, remove
from tabloom.sources.topic import with_positions

# A batch of so many messages and bytes is worked on by one task, its steps held in memory: most of its time is
# planning and starting jobs, not work.
SMALL_BATCH = 20_000
SMALL_BYTES = 16 << 20
SMALL_SETTINGS = {
    "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "1", "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
    # A batch has more pieces of code than Spark keeps compiled (100), so each would compile them all again.
    "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
    "spark.sql.lightweightPlanChangeValidation": "false",
}
# Shuffle files go when their query ends; else they stay until the driver collects its garbage.
LARGE_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def _settings(spark: SparkSession, some: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in some}
    for k, v in some.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hashed_records(decoded: DataFrame, digest: bool = False) -> DataFrame:
    """One row per distinct (table, record, schema) with hash, earliest position and number of copies.

    The schema is part of the key because a copy that names unknown columns is
    turned away without taking a good copy of the same record with it. With ``digest`` the hash is
    its 32 bytes, half of what its text takes on the way.
    """
    columns, first = _hashing(digest)
    return (
        decoded.select(*columns)
        .groupBy("table_name", "_row_hash", "columns")
        .agg(first.alias("_first"), F.count(F.lit(1)).alias("copies"))
        .select("table_name", "_row_hash", "columns", "_first.*", "copies")
    )


@built_once
def _hashing(digest: bool) -> tuple[list[Column], Column]:
    text = row_hash(F.col("record"))
    columns = [
        F.col("schema.table_name").alias("table_name"), (F.unhex(text) if digest else text).alias("_row_hash"),
        F.col("schema.columns").alias("columns"), F.col("record"), F.col("partition"), F.col("offset"),
    ]
    return columns, F.min_by(F.struct("record", "partition", "offset"), F.struct("partition", "offset"))


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dealt(messages: DataFrame) -> DataFrame:
    """Messages over all cores. Few, large files would be decoded and sorted by as many tasks; counting splits
    does not tell, as a file of one row group is cut into splits of which one has all rows. Rows that are spread
    already stay where they are: their text is the widest form they have."""
    cores = messages.sparkSession.sparkContext.defaultParallelism
    splits = messages.rdd.getNumPartitions()
    if splits >= cores:
        sizes = sorted((r["count"] for r in messages.groupBy(F.spark_partition_id()).count().collect()), reverse=True)
        if len(sizes) >= cores and sizes[0] <= 2 * sum(sizes) / len(sizes):
            return messages
    return messages.repartition(max(cores, splits), "partition", "offset", "value")


def is_small(messages: DataFrame) -> bool:
    size = messages.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("bytes")).first()
    return size["n"] <= SMALL_BATCH and (size["bytes"] or 0) <= SMALL_BYTES


def skip_stored(records: DataFrame, store: TableStore, buckets: list[int] | None = None) -> DataFrame:
    """Records (table_name, _row_hash, ``_bucket``) that no earlier batch has stored. Only tables that existed before the
    batch can hold one, and of the key index only their folders (``buckets``, if known) are read."""
    if buckets is None:
        old = records.join(store.state("registry").select("table_name").distinct(), "table_name", "left_semi")
        buckets = [r["_bucket"] for r in old.select("_bucket").distinct().collect()]  # at most BUCKETS
    if not buckets:
        return records
    held = store.keys(buckets).select("table_name", "_row_hash")
    if "_strange" in records.columns:  # rows that will be turned away are not looked up
        return records.join(held.withColumn("_strange", F.lit(False)), ["table_name", "_row_hash", "_strange"], "left_anti")
    return records.join(held, ["table_name", "_row_hash"], "left_anti")


def _reject_rows(judged: DataFrame, batch_id: int) -> DataFrame:
    return judged.filter(F.col("reason").isNotNull()).select(
        F.lit("load").alias("stage"),
        F.concat_ws("/", "table_name", "partition", "offset").alias("key"),
        "reason",
        F.concat(F.lit('{"detail":'), "detail", F.lit(',"record":'), F.to_json("record"), F.lit("}")).alias("payload"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def judge_records(records: DataFrame, schema: str = "stored") -> DataFrame:
    """Add ``cells``, ``width``, ``reason`` and ``detail`` to records of any tables: each is cast under the schema
    of its own table, all in one pass. ``columns`` is the schema the message brought."""
    extra, outcome = _judging(schema)
    cast = cast_records(records, schema).withColumn("extra", extra)
    return cast.withColumns(outcome).drop("extra", "bad")


@built_once
def _strange(schema: str) -> Column:
    """The names in a message's ``columns`` that the table's ``schema`` lacks."""
    names = lambda c: F.transform(c, lambda x: x["name"])
    return F.array_except(names(F.col("columns")), names(F.col(schema)))


@built_once
def _judging(schema: str) -> tuple[Column, dict[str, Column]]:
    return _strange(schema), {
        "reason": F.when(F.size("extra") > 0, F.lit("unknown_column")).when(F.size("bad") > 0, F.lit("bad_value")),
        "detail": F.when(F.size("extra") > 0, F.to_json("extra")).when(F.size("bad") > 0, F.to_json("bad")),
    }


def ingest_batch(messages: DataFrame, batch_id: int, store: TableStore, stage_path: str, run: str = "run", small: bool = False) -> None:
    """Load one batch of messages. ``run`` names the consumer: batches of different runs keep
    their rejects and metrics apart. Safe to repeat: a second attempt writes the same again,
    and a batch that is committed is not loaded once more. A ``small`` one (``is_small``) is one task's work.

    The stored schema of a table decides. Records that name unknown columns or hold values
    their column cannot take are rejected with the reason; the rest proceed. Conflicts and
    ids only need the hash and are settled before any value is parsed; a rejected record
    leaves a gap in the ids.
    """
    batch = f"{run}-{batch_id}"
    if store.committed(batch):
        return
    messages = with_positions(messages)
    store = store.for_batch(messages.sparkSession, small)
    steps = _InMemory() if small else _InFolders(stage_path)
    with _settings(store.spark, SMALL_SETTINGS if small else LARGE_SETTINGS):
        try:
            _load(messages.coalesce(1) if small else _dealt(messages), batch_id, batch, store, steps)
            if small:
                store.roll_up(run, batch_id)
        finally:
            steps.drop()


class _InFolders:
    """The steps of a batch below its stage folder, each until the next ones are written."""

    def __init__(self, path: str):
        self.path = path
        self.kept: dict[str, DataFrame] = {}

    def hold(self, df: DataFrame, step: str) -> DataFrame:
        self.kept[step] = _staged(df, f"{self.path}/{step}")
        return self.kept[step]

    def drop(self, *steps: str) -> None:
        for step in steps or list(self.kept):
            remove(self.kept.pop(step).sparkSession, f"{self.path}/{step}")


class _InMemory:
    def __init__(self) -> None:
        self.kept: list[DataFrame] = []

    def hold(self, df: DataFrame, step: str) -> DataFrame:
        self.kept.append(df.persist())
        return self.kept[-1]

    def drop(self, *steps: str) -> None:
        for df in [] if steps else self.kept:
            df.unpersist()


def _load(messages: DataFrame, batch_id: int, batch: str, store: TableStore, steps: _InFolders | _InMemory) -> None:
    decoded = decode_messages(messages)
    decoded = decoded.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))
    staged = steps.hold(decoded.select("value", "partition", "offset", "schema", "record", "reason"), "decoded")
    records = steps.hold(hashed_records(well_formed(staged), digest=True).withColumn("_bucket", bucket(F.col("table_name"))), "records")
    unread = malformed(staged).select(
        F.lit("decode").alias("stage"),
        F.concat_ws("/", F.col("partition"), F.col("offset")).alias("key"),
        "reason",
        F.col("value").alias("payload"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )
    if not store.one_task:
        unread = steps.hold(unread, "unread")
    steps.drop("decoded")

    known = store.state("registry").select("table_name", F.col("columns").alias("_known"))
    first = first_schemas(records.select(F.struct("table_name", "columns").alias("schema"), "partition", "offset"))
    received = records.groupBy("table_name").agg(F.sum("copies").cast("bigint").alias("received"), F.count(F.lit(1)).alias("_rows"))
    schemas = first.select("table_name", "columns").join(received, "table_name").join(known, "table_name", "left").join(store.last_ids(), "table_name", "left")
    stored = F.coalesce("_known", "columns").alias("stored")
    schemas = steps.hold(schemas.select("table_name", F.col("_known").isNull().alias("new"), stored, "max_id", "received", "_rows"), "schemas")
    seen = schemas.groupBy("new", bucket(F.col("table_name")).alias("_bucket")).agg(F.max("_rows").alias("rows")).collect()  # at most 2 * BUCKETS
    few = max((r["rows"] for r in seen), default=0)

    old = [r["_bucket"] for r in seen if not r["new"]]
    # Where no table is large, rows move once, by table, for the join, the distinct rows and their ranks.
    by_table = schemas.select("table_name", "stored", "max_id")
    by_table = by_table.hint("merge") if few <= RANK_IN_ONE_TASK else by_table
    stored = records.join(by_table, "table_name").withColumn("_row_hash", hash_text(F.col("_row_hash")))
    judged = stored.withColumn("_strange", F.size(_strange("stored")) > 0)
    keyed = skip_stored(judged, store, old).withColumn("_other", F.when(F.col("_strange"), F.col("columns")))
    fresh = dedupe_batch(keyed, ["table_name", "_row_hash", "_other"]).drop("_other")
    if few > RANK_IN_ONE_TASK:
        fresh = steps.hold(fresh, "fresh")
        steps.drop("records")
    # Strange rows are numbered apart, so that they leave no gaps.
    ranked = assign_ids(fresh, ["table_name", "_strange"], known_rows=few)
    later = F.when(~F.col("_strange"), F.col("_id") + F.coalesce("max_id", F.lit(0)))
    candidates = ranked.withColumn("_id", later).drop("_strange", "max_id")
    candidates = candidates.coalesce(1) if store.one_task else candidates
    every = steps.hold(judge_records(candidates).drop("stored", "columns", "copies"), "judged")
    steps.drop("fresh" if few > RANK_IN_ONE_TASK else "records")
    stays = every.filter(F.col("reason").isNull())
    outcome = every.groupBy("table_name").agg(
        F.count(F.when(F.col("reason").isNull(), 1)).alias("inserted"),
        F.count("reason").alias("rejected"),
        F.max(F.when(F.col("reason").isNull(), F.col("_id"))).alias("_last"),
    )
    counted = schemas.join(outcome, "table_name", "left").select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        "table_name",
        "received",
        F.coalesce("inserted", F.lit(0)).alias("inserted"),
        F.coalesce("rejected", F.lit(0)).alias("rejected"),
        F.coalesce("_last", "max_id", F.lit(0)).cast("bigint").alias("last_id"),
    )

    def append() -> None:
        store.append(batch, stays)
        steps.drop("judged")

    def keys() -> None:
        """A large batch has them in order in its tables already."""
        rows = stays if store.one_task else store.appended(batch)
        store.write("keys", batch, rows.select("table_name", "_row_hash", "_id", "_bucket"), "_bucket")

    writes = [
        lambda: store.write("rejects", batch, unread.unionByName(_reject_rows(every, batch_id))),
        lambda: store.write("metrics", batch, counted),
        append,
        keys,
    ]
    if any(r["new"] for r in seen):
        writes.append(lambda: store.ensure_all(schemas.filter("new").select("table_name", F.col("stored").alias("columns")), batch))
    # Those of a small batch take their time to be planned, not to be done.
    with ThreadPoolExecutor(len(writes) if store.one_task else 1) as pool:
        for done in [pool.submit(inheritable_thread_target(store.spark)(w)) for w in writes]:
            done.result()
    store.commit(batch)
