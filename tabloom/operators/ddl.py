"""CREATE TABLE text for a table schema, per database dialect."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Identifier quote, id column and type spellings of each dialect.
QUOTES = {"mysql": "`", "postgres": '"'}
ID_TYPES = {"mysql": "BIGINT AUTO_INCREMENT PRIMARY KEY", "postgres": "BIGSERIAL PRIMARY KEY"}
TYPE_NAMES = {"mysql": {}, "postgres": {"DOUBLE": "DOUBLE PRECISION"}}
HASH_TYPE = "VARCHAR(64) NOT NULL UNIQUE"


def create_table_sql(table_name: Column, columns: Column, dialect: str) -> Column:
    """DDL with the key, the unique content hash and the inferred columns."""
    quote = QUOTES[dialect]

    def ident(c: Column) -> Column:
        doubled = F.replace(c, F.lit(quote), F.lit(quote * 2))
        return F.concat(F.lit(quote), doubled, F.lit(quote))

    def type_name(c: Column) -> Column:
        out = c
        for name, spelled in TYPE_NAMES[dialect].items():
            out = F.when(c == name, F.lit(spelled)).otherwise(out)
        return out

    fixed = F.array(
        F.concat(ident(F.lit("_id")), F.lit(" " + ID_TYPES[dialect])),
        F.concat(ident(F.lit("_row_hash")), F.lit(" " + HASH_TYPE)),
    )
    inferred = F.transform(columns, lambda c: F.concat(ident(c["name"]), F.lit(" "), type_name(c["type"])))
    body = F.array_join(F.concat(fixed, inferred), ",\n  ")
    return F.concat(F.lit("CREATE TABLE IF NOT EXISTS "), ident(table_name), F.lit(" (\n  "), body, F.lit("\n)"))
