"""Types of columns that grow: facts of the pages seen so far are kept, new pages are added to them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabloom.operators.infer import decide_types, merge_facts, page_facts


def absorb_pages(cells: DataFrame, path: str, batch: int, keys: list[str], pos: str, page: str) -> DataFrame:
    """``keys`` plus ``type`` of every column seen up to this batch, as ``infer_types`` would
    give for all pages at once; pages of earlier batches are not read again.

    ``path`` holds one snapshot per batch: a small row of facts for each column, however many
    pages it had. Batches count from 0 without gaps. Their pages may come in any order (``page``
    tells the place), each in one batch only. A repeated batch starts from the snapshot before
    it and writes its own again, so it counts once.
    """
    spark = cells.sparkSession
    facts = page_facts(cells, keys, pos, page)
    if batch:
        facts = facts.unionByName(spark.read.parquet(f"{path}/snapshot-{batch - 1}"))
    merged = merge_facts(facts, keys)
    merged.write.mode("overwrite").parquet(f"{path}/snapshot-{batch}")
    return decide_types(spark.read.schema(merged.schema).parquet(f"{path}/snapshot-{batch}"), keys)
