"""Set semantics of destination tables: distinct rows, conflict skip, row ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# A key is at most a table name and a 64-character hash, so this many fit a broadcast.
BROADCAST_KEYS = 200_000
# So many hashes sort within one task.
RANK_IN_ONE_TASK = 200_000


def dedupe_batch(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Keep one row per key; copies are combined before the shuffle."""
    return batch.dropDuplicates(keys)


def skip_existing(batch: DataFrame, target: DataFrame, keys: list[str], batch_rows: int | None = None) -> DataFrame:
    """Rows of a distinct ``batch`` whose keys the ``target`` does not hold yet.

    The target only grows. While the batch is known to be small, its keys are
    broadcast and the target is filtered where it lies, so the target is never
    shuffled; what is left is no larger than the batch. A larger batch, or one
    of unknown size, meets the target by a shuffle on the hash, which spreads
    evenly even when one table holds most rows.
    """
    held = target.select(*keys)
    if batch_rows is not None and batch_rows <= BROADCAST_KEYS:
        held = F.broadcast(held.join(F.broadcast(batch.select(*keys)), keys, "left_semi"))
    return batch.join(held, keys, "left_anti")


def assign_ids(
    rows: DataFrame, keys: list[str], start: DataFrame | int = 0, row_hash: str = "_row_hash", prefix: int = 3,
    known_rows: int | None = None,
) -> DataFrame:
    """Add ``_id``: per table, ``start`` plus the rank of the row's hash.

    Ranking a large table in one window would sort it in one task. The hash is
    uniform, so its first ``prefix`` hex digits cut every table into even slices
    in rank order: slices are counted, their offsets summed over at most
    16**prefix small rows per table, and rows ranked within their slice.
    ``start`` is a number, or ``keys`` plus ``max_id`` per table. Rows known to
    be few are ranked directly, which reads them once instead of twice.
    """
    if isinstance(start, int) and known_rows is not None and known_rows <= RANK_IN_ONE_TASK:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(row_hash))
        return rows.withColumn("_id", (rank + F.lit(start)).cast("bigint"))
    sliced = rows.withColumn("_slice", F.substring(row_hash, 1, prefix))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    if isinstance(start, DataFrame):
        offsets = offsets.join(start, keys, "left").withColumn(
            "_before", F.col("_before") + F.coalesce("max_id", F.lit(0))
        ).drop("max_id")
    else:
        offsets = offsets.withColumn("_before", F.col("_before") + F.lit(start))
    rank = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(row_hash))
    return (
        sliced.join(offsets, [*keys, "_slice"])
        .withColumn("_id", (F.col("_before") + rank).cast("bigint"))
        .drop("_slice", "_before")
    )
