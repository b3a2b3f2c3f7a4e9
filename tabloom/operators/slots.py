"""Rows of any schema in one physical layout.

Every column type belongs to a class of values; the k-th column of a class, in schema order,
is kept in the k-th slot of that class. Tables of any names and schemas then share files
and one cast, and a stored schema tells which slots to read under which names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabloom.functions.literals import load_value
from tabloom.operators.load import SPARK_TYPES, Columns, spark_type
from tabloom.operators.once import built_once, evaluate_once

# Class: its declared types; whatever else is declared is text.
CLASSES = {"n": "BIGINT", "f": "DOUBLE", "t": "TIMESTAMP", "d": "DATE", "s": "TEXT"}
LEAST_WIDTH = 8


def class_of(declared: Column) -> Column:
    out = F.lit("s")
    for letter, kind in CLASSES.items():
        out = F.when(declared == kind, F.lit(letter)).otherwise(out)
    return out


def slots(columns: Columns) -> list[str]:
    """The slot of each column of a schema."""
    letters = {kind: letter for letter, kind in CLASSES.items()}
    seen: dict[str, int] = {}
    out = []
    for _, declared in columns:
        letter = letters.get(declared, "s")
        out.append(f"{letter}{seen.get(letter, 0)}")
        seen[letter] = seen.get(letter, 0) + 1
    return out


def width_of(columns: Columns) -> int:
    """The width of a schema: slots of its largest class, rounded up to a power of two."""
    most = max((int(s[1:]) + 1 for s in slots(columns)), default=1)
    width = LEAST_WIDTH
    while width < most:
        width *= 2
    return width


def width_column(columns: Column) -> Column:
    """``width_of`` for a column of schemas."""
    counts = [F.size(F.filter(columns, lambda c: class_of(c["type"]) == letter)) for letter in CLASSES]  # noqa: B023
    return F.greatest(F.lit(LEAST_WIDTH), F.pow(2, F.ceil(F.log2(F.greatest(*counts, F.lit(1))))).cast("int"))


def slot_schema(columns: Columns) -> T.StructType:
    """What is read of the shared files for one table."""
    fields = [T.StructField(s, T._parse_datatype_string(spark_type(t))) for s, (_, t) in zip(slots(columns), columns)]
    return T.StructType(fields)


def cast_records(records: DataFrame, columns: str) -> DataFrame:
    """Add ``cells``, ``bad`` and ``width``: the record's values under the schema in ``columns``, each parsed once
    as its own type, and the non-empty ones their column cannot store."""
    cells, bad, width = _casting(columns)
    return evaluate_once(records, {"cells": cells}).withColumns({"bad": bad, "width": width})


@built_once
def _casting(columns: str) -> tuple[Column, Column, Column]:
    given = F.transform(
        columns,
        lambda c: F.struct(class_of(c["type"]).alias("class"), c["name"].alias("column"), F.try_element_at("record", c["name"]).alias("value")),
    )
    typed = lambda x: [
        F.when(x["class"] == letter, load_value(x["value"], kind)).alias(letter) for letter, kind in CLASSES.items()
    ]
    cells = F.transform(given, lambda x: F.struct(x["class"].alias("class"), x["column"].alias("column"), x["value"].alias("value"), *typed(x)))
    misfit = lambda x: (x["value"] != "") & reduce(Column.__and__, (x[letter].isNull() for letter in CLASSES))
    bad = F.transform(F.filter("cells", misfit), lambda x: F.struct(x["column"].alias("column"), x["value"].alias("value")))
    return cells, bad, width_column(F.col(columns))


def slot_columns(counts: dict[str, int]) -> list[Column]:
    """``cells`` as slots, so many of each class."""
    return _slots_of(tuple(counts[letter] for letter in CLASSES))


@built_once
def _slots_of(counts: tuple[int, ...]) -> list[Column]:
    out = []
    for (letter, kind), count in zip(CLASSES.items(), counts):
        values = F.transform(F.filter("cells", lambda x: x["class"] == letter), lambda x: x[letter])
        out += [F.get(values, F.lit(k)).cast(SPARK_TYPES[kind]).alias(f"{letter}{k}") for k in range(count)]
    return out


@built_once
def slot_counts(cells: str = "cells") -> list[Column]:
    """Aggregates: the most slots of each class that any row needs."""
    return [F.max(F.size(F.filter(cells, lambda x: x["class"] == letter))).alias(letter) for letter in CLASSES]
