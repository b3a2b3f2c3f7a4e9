"""From record text to typed columns, with rows that do not fit set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.literals import load_value
from tabloom.operators.once import evaluate_once

Columns = list[tuple[str, str]]

# Declared column type -> Spark type.
SPARK_TYPES = {
    "BIGINT": "bigint", "DOUBLE": "double", "TIMESTAMP": "timestamp",
    "DATE": "date", "VARCHAR(512)": "string", "TEXT": "string",
}
VARCHAR_CHARS = 512


def spark_type(declared: str) -> str:
    """Unknown type names are stored as text."""
    return SPARK_TYPES.get(declared, "string")


def typed_columns(record: Column, columns: Columns) -> list[Column]:
    """One typed column per schema column. The declared type rides along as column metadata."""
    return [
        load_value(F.try_element_at(record, F.lit(name)), declared).alias(name, metadata={"declared": declared})
        for name, declared in columns
    ]


def bad_cells(record: Column, columns: Columns, typed: Column | None = None, enforce_length: bool = False) -> Column:
    """``array<struct<column, value>>`` of the non-empty values their column cannot store.

    ``typed`` is a struct of the columns' values when they are at hand already.
    ``enforce_length`` also lists text too long for VARCHAR(512), for databases that mind.
    """
    checks = []
    for name, declared in columns:
        value = F.try_element_at(record, F.lit(name))
        ok = (load_value(value, declared) if typed is None else typed[name]).isNotNull()
        if enforce_length and declared == "VARCHAR(512)":
            ok = F.length(value) <= VARCHAR_CHARS
        checks.append(F.when((value != "") & ~ok, F.struct(F.lit(name).alias("column"), value.alias("value"))))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def unknown_columns(message_columns: Column, stored: list[str]) -> Column:
    """Names in a message's schema that the stored table does not have."""
    names = F.transform(message_columns, lambda c: c["name"])
    return F.array_except(names, F.array(*[F.lit(n) for n in stored]).cast("array<string>"))


def judge_rows(batch: DataFrame, columns: Columns, enforce_length: bool = False) -> DataFrame:
    """Add ``typed``, ``reason`` and ``detail``: the values, and why a row cannot be stored, else NULL.

    ``batch`` holds ``record`` and the message's ``columns``.
    """
    staged = batch.withColumn("typed", F.struct(*typed_columns(F.col("record"), columns))).withColumns(
        {
            "_extra": unknown_columns(F.col("columns"), [n for n, _ in columns]),
            "_bad": bad_cells(F.col("record"), columns, F.col("typed"), enforce_length),
        }
    )
    judged = {
        "typed": F.col("typed"),
        "reason": F.when(F.size("_extra") > 0, F.lit("unknown_column")).when(F.size("_bad") > 0, F.lit("bad_value")),
        "detail": F.when(F.size("_extra") > 0, F.to_json("_extra")).when(F.size("_bad") > 0, F.to_json("_bad")),
    }
    return evaluate_once(staged, judged).drop("_extra", "_bad")
