"""The envelope: records, messages, decoding and what happens to malformed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.functions import canonical
from tabloom.operators import envelope
from tabloom.operators.extract import extract_tables
from tabloom.plans import publish as publishing
from tabloom.session import work_dir
from tabloom.sources import topic
from workload import fixtures
from workload.base import Tables, query, sql_json
from workload.fixtures import ORDER_COLUMNS

# ---- messages made from events: the table is the event type, some messages are malformed ----

_NAMED = '{"schema":{"table_name":"'
_COLUMNS = '"columns":[{"name":"user_id","type":"BIGINT"},{"name":"kind","type":"VARCHAR(512)"}'
_GOOD = (
    f"""'{_NAMED}' || event_type || '",{_COLUMNS}' || CASE WHEN event_id > 5000 THEN ',{{"name":"late","type":"DATE"}}' ELSE '' END || """
    """']},"record":{"kind":"' || event_type || '","user_id":"' || CAST(user_id AS STRING) || '"' || """
    """CASE WHEN event_id % 10 = 3 THEN ',"late":null' ELSE '' END || '}}'"""
)
_BROKEN = {
    0: ("not_json", f"substring({_GOOD}, 1, 60)"),
    1: ("non_string_value", f"""replace({_GOOD}, '"user_id":"' || CAST(user_id AS STRING) || '"', '"user_id":' || CAST(user_id AS STRING))"""),
    2: ("not_json", f"{_GOOD} || ' tail'"),
    3: ("no_table_name", "'{\"record\":{\"a\":\"1\"}}'"),
    4: ("bad_schema", """'{"schema":{"table_name":"' || event_type || '","columns":[{"name":"a"}]},"record":{}}'"""),
    5: ("no_record", f"""regexp_replace({_GOOD}, ',"record":.*', '}}')"""),
    6: ("not_json", f"{_GOOD} || ',' || {_GOOD}"),
}
MESSAGE_SQL = "CASE event_id % 97 " + " ".join(f"WHEN {i} THEN {x}" for i, (_, x) in _BROKEN.items()) + f" ELSE {_GOOD} END"
REASON_SQL = "CASE event_id % 97 " + " ".join(f"WHEN {i} THEN '{r}'" for i, (r, _) in _BROKEN.items()) + " END"
PARTITION_SQL = "CAST(event_id % 8 AS INT)"
GOOD_EVENTS = f"(SELECT *, {PARTITION_SQL} AS part FROM events WHERE event_id % 97 >= {len(_BROKEN)})"


def event_messages(t: Tables) -> DataFrame:
    return t.events.select(
        F.expr(MESSAGE_SQL).alias("value"), F.expr(PARTITION_SQL).alias("partition"), F.col("event_id").alias("offset")
    )


@query(
    "decode_messages",
    f"SELECT event_id AS offset, event_type AS table_name, CASE WHEN event_id > 5000 THEN 3 ELSE 2 END AS n_columns, "
    f"event_type AS kind, CAST(user_id AS VARCHAR) AS user_id, CASE WHEN event_id % 10 = 3 THEN '' END AS late FROM {GOOD_EVENTS}",
)
def decode_messages(t: Tables) -> DataFrame:
    good = envelope.well_formed(envelope.decode_messages(event_messages(t)))
    item = {k: F.try_element_at("record", F.lit(k)).alias(k) for k in ("kind", "user_id", "late")}
    return good.select(
        "offset", F.col("schema.table_name").alias("table_name"), F.size("schema.columns").alias("n_columns"), *item.values()
    )


@query(
    "quarantine_malformed",
    f"SELECT event_id AS offset, {REASON_SQL} AS reason FROM events WHERE event_id % 97 < {len(_BROKEN)}",
)
def quarantine_malformed(t: Tables) -> DataFrame:
    return envelope.malformed(envelope.decode_messages(event_messages(t))).select("offset", "reason")


@query(
    "project_by_schema",
    f"SELECT event_id AS offset, CAST(user_id AS VARCHAR) AS c0, event_type AS c1, CAST(NULL AS VARCHAR) AS c2 FROM {GOOD_EVENTS}",
)
def project_by_schema(t: Tables) -> DataFrame:
    good = envelope.well_formed(envelope.decode_messages(event_messages(t)))
    values = envelope.project_by_schema(F.col("record"), F.col("schema.columns"))
    return good.withColumn("_v", values).select("offset", *[F.get("_v", F.lit(i)).alias(f"c{i}") for i in range(3)])


@query("batch_by_table", f"SELECT event_type AS table_name, count(*) AS n_messages FROM {GOOD_EVENTS} GROUP BY 1")
def batch_by_table(t: Tables) -> DataFrame:
    return envelope.group_statistics(envelope.well_formed(envelope.decode_messages(event_messages(t))))


@query(
    "first_schema_wins",
    "SELECT table_name, part AS partition, event_id AS offset, CASE WHEN event_id > 5000 THEN 3 ELSE 2 END AS n_columns FROM "
    "(SELECT event_type AS table_name, part, event_id, row_number() OVER (PARTITION BY event_type ORDER BY part, event_id) AS k "
    f"FROM {GOOD_EVENTS}) WHERE k = 1",
)
def first_schema_wins(t: Tables) -> DataFrame:
    first = envelope.first_schemas(envelope.well_formed(envelope.decode_messages(event_messages(t))))
    return first.select("table_name", "position.partition", "position.offset", F.size("columns").alias("n_columns"))


@query("publish_roundtrip", f"SELECT {MESSAGE_SQL} AS value FROM events")
def publish_roundtrip(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "topic")
    topic.publish(event_messages(t).select("value"), "text", partitions=4, batch_size=1000, path=path)
    return topic.read_topic(t.spark, "text", path=path)


# ---- messages made from pages ----

_RECORD = {
    "status": "o_orderstatus",
    "order_": "format('{:,}', o_orderkey)",
    "price": "CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE '$' || format('{:,.2f}', o_totalprice) END",
    "price_2": "(o_custkey % 100) || '%'",
    "placed": "strftime(o_orderdate, '%Y-%m-%d')",
    "shipped": "strftime(o_orderdate, '%b %-d, %Y')",
    "priority": "o_orderpriority",
    "note": "''",
}
_SCHEMA_JSON = (
    '{"table_name":"order_","columns":[' + ",".join(f'{{"name":"{n}","type":"{d}"}}' for n, d in ORDER_COLUMNS) + "]}"
)
_RECORD_JSON = " || ',' || ".join(f"'\"{k}\":' || {sql_json(_RECORD[k])}" for k in sorted(_RECORD))


def order_records(t: Tables) -> DataFrame:
    return publishing.records_with_schema(extract_tables(fixtures.orders_pages(t), "wikitable"), "Order[2]")


@query(
    "build_records",
    "SELECT o_orderkey // 100 AS page_id, " + ", ".join(f"{v} AS {k}" for k, v in _RECORD.items()) + " FROM orders",
)
def build_records(t: Tables) -> DataFrame:
    return order_records(t).select("page_id", *[F.element_at("record", F.lit(k)).alias(k) for k in _RECORD])


@query(
    "build_messages",
    "SELECT o_orderkey // 100 AS page_id, 'order_' AS table_name, "
    f"'{','.join(n + ' ' + d for n, d in ORDER_COLUMNS)}' AS columns, 8 AS n_fields FROM orders",
)
def build_messages(t: Tables) -> DataFrame:
    listed = F.array_join(F.transform("schema.columns", lambda c: F.concat_ws(" ", c["name"], c["type"])), ",")
    return order_records(t).select(
        "page_id", F.col("schema.table_name").alias("table_name"), listed.alias("columns"), F.size("record").alias("n_fields")
    )


@query(
    "encode_messages",
    f"SELECT o_orderkey // 100 AS page_id, '{{\"schema\":{_SCHEMA_JSON},\"record\":{{' || {_RECORD_JSON} || '}}}}' AS value FROM orders",
)
def encode_messages(t: Tables) -> DataFrame:
    return publishing.build_messages(fixtures.orders_pages(t), "Order[2]").select("page_id", "value")


@query(
    "messages_any_page_id",
    "SELECT p AS page, n_pages, n_records, n_rejects FROM (SELECT CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'u' || (s_suppkey // 10) END AS p, "
    "count(*) AS n_pages, count(*) * 2 - 2 * sum(CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 0 END) AS n_records, "
    "CAST(sum(CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_rejects FROM supplier GROUP BY 1)",
)
def messages_any_page_id(t: Tables) -> DataFrame:
    """Null, text and repeated page ids: messages and rejects account for every page."""
    cells = "concat('<table><tr><th>', s_name, '<th>k<tr><td>', s_acctbal, '<td>a<tr><td>', s_nationkey, '<td>b</table>')"
    pages = t.supplier.selectExpr(
        "if(s_suppkey % 3 = 0, null, concat('u', s_suppkey div 10)) AS page_id", f"if(s_suppkey % 7 = 0, '<p>none', {cells}) AS html"
    )
    found = publishing.messages_and_rejects(pages, "suppliers", css_class=None)
    first = F.coalesce("row_idx", F.lit(1)) == 1
    return found.groupBy(F.col("page_id").alias("page")).agg(
        F.count(F.when(first, 1)).alias("n_pages"), F.count("value").alias("n_records"), F.count("reason").alias("n_rejects")
    )


# ---- content hashes over whole documents ----

_DOCUMENT = {"lang": "lang", "source": "source", "text": "text", "tag <&>": "lang || chr(9) || '\"'"}
_DOCUMENT_JSON = " || ',' || ".join(
    f"{sql_json(chr(39) + k + chr(39))} || ':' || {sql_json(_DOCUMENT[k])}" for k in sorted(_DOCUMENT)
)


@query("row_hash", f"SELECT doc_id, sha256('{{' || {_DOCUMENT_JSON} || '}}') AS row_hash FROM documents")
def row_hash(t: Tables) -> DataFrame:
    record = F.create_map(*[F.expr(x) for k, v in _DOCUMENT.items() for x in (f"'{k}'", v)])
    return t.documents.select("doc_id", canonical.row_hash(record).alias("row_hash"))
