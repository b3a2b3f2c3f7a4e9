"""Column types and table schemas, inferred with mergeable aggregates.

The rule is a fold over the rows of a column: its type starts at BIGINT and
moves down BIGINT, DOUBLE, TIMESTAMP, DATE, VARCHAR/TEXT to the first type that
accepts the value, never back up; VARCHAR or TEXT is then decided again by every
value, so the last one counts. The outcome only depends on which kinds occur, on
the first and last position of some kinds and on the length of the last value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.literals import VARCHAR_BYTES, value_kind
from tabloom.functions.names import dedupe_names, sanitise_name


def _summary(pos: str) -> list[Column]:
    """Partial facts of one column; every buffer is a number, so hash aggregation applies."""
    kind, at = F.col("_kind"), F.col(pos)

    def where(*kinds: str) -> Column:
        return F.when(kind.isin(*kinds), at)

    return [
        F.max(kind == "F").alias("has_f"),
        F.max(kind == "T").alias("has_t"),
        F.max(kind == "A").alias("has_a"),
        F.max(kind == "S").alias("has_s"),
        F.max(where("I", "F")).alias("last_number"),
        F.min(where("T", "A")).alias("first_moment"),
        F.max(where("T")).alias("last_t"),
        F.min(where("A")).alias("first_a"),
        F.max_by("_bytes", at).alias("last_bytes"),
    ]


def _went_back() -> Column:
    """A number after a timestamp or date, or a timestamp after a date, ends as text."""
    return F.coalesce(F.col("last_number") > F.col("first_moment"), F.lit(False)) | F.coalesce(
        F.col("last_t") > F.col("first_a"), F.lit(False)
    )


def _decide() -> Column:
    return (
        F.when(
            F.col("has_s") | F.col("went_back"),
            F.when(F.col("last_bytes") > VARCHAR_BYTES, F.lit("TEXT")).otherwise(F.lit("VARCHAR(512)")),
        )
        .when(F.col("has_a"), F.lit("DATE"))
        .when(F.col("has_t"), F.lit("TIMESTAMP"))
        .when(F.col("has_f"), F.lit("DOUBLE"))
        .otherwise(F.lit("BIGINT"))
    )


_FLAGS = ("has_f", "has_t", "has_a", "has_s", "went_back")


def _facts(cells: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """``_summary`` of every group. Empty cells take no part, but an all-empty column still comes out."""
    observed = cells.withColumn("_kind", value_kind(F.col("value")))
    seen = F.col("_kind").isNotNull()
    observed = observed.select(
        *keys, F.when(seen, F.col(pos)).alias(pos), "_kind", F.when(seen, F.octet_length("value")).alias("_bytes")
    )
    return observed.groupBy(*keys).agg(*_summary(pos)).withColumn("went_back", _went_back())


def page_facts(cells: DataFrame, keys: list[str], pos: str, page: str) -> DataFrame:
    """One row for each of ``keys`` and each page, its positions the page's: facts that ``merge_facts`` takes."""
    at = {x: F.when(F.col(x).isNotNull(), F.col(page)) for x in ("last_number", "first_moment", "last_t", "first_a")}
    last_page = F.when(F.col("last_bytes").isNotNull(), F.col(page))
    return _facts(cells, [*keys, page], pos).withColumns({**at, "last_page": last_page}).drop(page)


def merge_facts(facts: DataFrame, keys: list[str]) -> DataFrame:
    """One row of facts for each of ``keys``, from facts of pages or merged ones, in any order and
    any grouping; no page may be among them twice."""
    return facts.groupBy(*keys).agg(
        *[F.max(x).alias(x) for x in (*_FLAGS, "last_number", "last_t", "last_page")],
        *[F.min(x).alias(x) for x in ("first_moment", "first_a")],
        F.max_by("last_bytes", "last_page").alias("last_bytes"),
    )


def decide_types(facts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` plus ``type`` of facts that hold each of ``keys`` once."""
    judged = facts.withColumn("went_back", F.col("went_back") | _went_back())
    flags = {x: F.coalesce(F.col(x), F.lit(False)) for x in _FLAGS}
    return judged.withColumns(flags).select(*keys, _decide().alias("type"))


def infer_types(cells: DataFrame, keys: list[str], pos: str = "row_idx", outer_pos: str | None = None) -> DataFrame:
    """``keys`` plus ``type`` from cleaned cells ``(keys, pos, value)``; all-empty groups are BIGINT.

    ``pos`` orders the values of a group. When a group is spread over many pages,
    ``outer_pos`` orders the pages: each page is summarised first, then the pages
    are compared. Both steps combine before the shuffle, so a column that holds
    most of the data sends one small row per task.
    """
    if outer_pos:
        return decide_types(merge_facts(page_facts(cells, keys, pos, outer_pos), keys), keys)
    return decide_types(_facts(cells, keys, pos), keys)


def name_columns(tables: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, pos, name`` from ``headers``: sanitised and distinct within each table."""
    named = tables.select(*keys, F.posexplode(F.transform("headers", sanitise_name)).alias("pos", "base"))
    return dedupe_names(named, keys, "base", "pos").select(*keys, "pos", "name")


def table_schemas(names: DataFrame, types: DataFrame, keys: list[str], *facts: Column) -> DataFrame:
    """``keys, columns``: one ordered array of (name, type) per table.

    ``names`` is ``(keys, pos, name)`` and ``types`` is ``(keys, col_idx, type)``.
    Both are reduced to one row per table first; a column without rows is BIGINT.
    ``facts`` are further aggregates over ``names`` to keep.
    """
    named = names.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("_names"), *facts)
    typed = types.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("col_idx", "type"))).alias("_types"))
    column = F.transform(
        "_names",
        lambda n: F.struct(
            n["name"].alias("name"),
            F.coalesce(F.try_element_at(F.col("_types"), n["pos"]), F.lit("BIGINT")).alias("type"),
        ),
    )
    return named.join(typed, keys, "left").withColumn("columns", column).drop("_names", "_types")
