"""Page scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def scan_pages(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Pages from a crawl table; only successful fetches pass when it records a status."""
    pages = spark.read.format(fmt).options(**options).load(path)
    if "status" in pages.columns:
        pages = pages.filter(F.col("status") == 200)
    return pages


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores one split per core.

    Parsing text is work for the processor, so a few large row groups would keep
    most cores idle. A scan that is already wide enough is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
