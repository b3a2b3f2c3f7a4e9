"""SQL-safe column and table names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.functions.text import strip_footnotes, unicode_trim

# Words that get a trailing underscore, and the length limit.
RESERVED_WORDS = ["rank", "index", "order", "key", "group"]
MAX_NAME_LENGTH = 64


def escape_reserved(c: Column) -> Column:
    return F.when(c.isin(RESERVED_WORDS), F.concat(c, F.lit("_"))).otherwise(c)


def sanitise_name(c: Column) -> Column:
    """Header text to identifier: ``% of World[2]`` becomes ``of_world``."""
    text = unicode_trim(strip_footnotes(c))
    ident = F.lower(F.btrim(F.regexp_replace(text, "[^a-zA-Z0-9]+", "_"), F.lit("_")))
    named = F.when(ident == "", F.lit("col")).otherwise(ident)
    return F.substring(escape_reserved(named), 1, MAX_NAME_LENGTH)


def dedupe_names(headers: DataFrame, keys: list[str], base: str, pos: str, out: str = "name") -> DataFrame:
    """Make the names of each table distinct.

    The k-th repeat of a base name becomes ``base_k``. A renamed column may then
    meet a header that is spelled like it, or lose its suffix to the length
    limit; the second window gives those a ``__pos`` suffix, which no other name
    of the table can carry.
    """
    repeats = F.row_number().over(Window.partitionBy(*keys, base).orderBy(pos))
    first = headers.withColumn("_k", repeats).withColumn(
        "_candidate",
        F.when(F.col("_k") == 1, F.col(base)).otherwise(
            F.substring(F.concat(F.col(base), F.lit("_"), F.col("_k").cast("string")), 1, MAX_NAME_LENGTH)
        ),
    )
    # Unrenamed columns keep their name, so they sort in front of renamed ones.
    clash = F.row_number().over(Window.partitionBy(*keys, "_candidate").orderBy(F.least(F.col("_k"), F.lit(2)), pos))
    suffix = F.concat(F.lit("__"), F.col(pos).cast("string"))
    unique = F.concat(F.expr(f"left(_candidate, {MAX_NAME_LENGTH} - length(concat('__', {pos})))"), suffix)
    return (
        first.withColumn("_n", clash)
        .withColumn(out, F.when(F.col("_n") == 1, F.col("_candidate")).otherwise(unique))
        .drop("_k", "_candidate", "_n")
    )
