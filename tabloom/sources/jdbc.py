"""Relational destinations through Spark's JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.operators.dedupe import skip_existing
from tabloom.operators.load import Columns

# Rows per insert statement batch.
INSERT_BATCH = 1000


def column_types(columns: Columns) -> str:
    """Column types for a table that Spark creates, in the syntax of ``createTableColumnTypes``."""
    names = {"TEXT": "STRING"}
    fixed = [("_id", "BIGINT"), ("_row_hash", "VARCHAR(64)")]
    return ", ".join(f"`{n}` {names.get(t, t)}" for n, t in [*fixed, *columns])


def read_hashes(spark: SparkSession, url: str, table: str, partitions: int = 16, **options: str) -> DataFrame:
    """The target's hashes, one range of first hex digits per task."""
    digits = "0123456789abcdef"
    step = -(-len(digits) // max(1, min(partitions, len(digits))))
    ranges = []
    for i in range(0, len(digits), step):
        low = f"_row_hash >= '{digits[i]}'" if i else "1 = 1"
        high = f"_row_hash < '{digits[i + step]}'" if i + step < len(digits) else "1 = 1"
        ranges.append(f"{low} AND {high}")
    return spark.read.jdbc(url, table, predicates=ranges, properties=options).select("_row_hash")


def append_rows(
    rows: DataFrame, url: str, table: str, columns: Columns, exists: bool, batch_rows: int | None = None, **options: str
) -> None:
    """Append rows (``_id``, ``_row_hash``, typed columns) whose hash the table does not hold.

    For a unique constraint and generated ids, create the table beforehand with
    the statement from ``create_table_sql``.
    """
    if exists:
        held = read_hashes(rows.sparkSession, url, table, **options)
        rows = skip_existing(rows, held, ["_row_hash"], batch_rows)
    names = ["_id", "_row_hash", *[n for n, _ in columns]]
    writer = rows.select(*[F.col(f"`{n}`") for n in names]).write.format("jdbc").mode("append")
    writer.options(
        **{"url": url, "dbtable": table, "batchsize": str(INSERT_BATCH), "createTableColumnTypes": column_types(columns), **options}
    ).save()
