"""Evaluate costly expressions once, whatever filters follow; build long ones once, however many batches use them."""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import Any

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, functions as F


def evaluate_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` that later filters do not reach through.

    A filter on a computed column is normally pushed below the projection, where
    it repeats the whole expression once per mention. Filters stay above a
    generator, so the columns are produced by one that yields a single row.
    """
    keep = [c for c in df.columns if c not in columns]
    packed = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.explode(F.array(packed)).alias("_once")).select(
        *keep, *[F.col("_once")[name].alias(name) for name in columns]
    )


def built_once(make: Callable[..., Any]) -> Callable[..., Any]:
    """Keep the columns that ``make`` builds from names and numbers: a long expression takes a call to the JVM for
    each of its parts, several hundred milliseconds in all, and stays the same from batch to batch."""
    kept: dict[Any, tuple[Any, Any]] = {}

    @functools.wraps(make)
    def get(*given: Any) -> Any:
        jvm = SparkContext._gateway
        if given not in kept or kept[given][0] is not jvm:
            kept[given] = jvm, make(*given)
        return kept[given][1]

    return get
