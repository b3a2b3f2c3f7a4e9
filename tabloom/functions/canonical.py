"""Canonical JSON text of a record and its content hash.

Two equal records must give the same bytes on every engine that reads the topic:
keys sorted by their UTF-8 bytes, no spaces, and the escapes listed below.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters with a short escape. Other control characters, and
# the three HTML-sensitive ones with the two line separators, are written \\u00xx.
SHORT_ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t"}
LONG_ESCAPES = [chr(n) for n in range(0x20) if chr(n) not in "\n\r\t"] + ["<", ">", "&", "\u2028", "\u2029"]

_NEEDS_ESCAPE = r'["\\<>&\x00-\x1f\u2028\u2029]'


def json_string(c: Column) -> Column:
    """A JSON string literal; text without special characters skips the replacements."""
    escaped = c
    for raw, short in SHORT_ESCAPES.items():  # the backslash comes first
        escaped = F.replace(escaped, F.lit(raw), F.lit(short))
    long = escaped
    for raw in LONG_ESCAPES:
        long = F.replace(long, F.lit(raw), F.lit(f"\\u{ord(raw):04x}"))
    rare = F.when(escaped.rlike(r"[<>&\x00-\x1f\u2028\u2029]"), long).otherwise(escaped)
    body = F.when(c.rlike(_NEEDS_ESCAPE), rare).otherwise(c)
    return F.concat(F.lit('"'), body, F.lit('"'))


def canonical_json(record: Column) -> Column:
    """A MAP<STRING,STRING> as canonical JSON; a NULL value counts as empty text."""
    pairs = F.transform(
        F.array_sort(F.map_entries(record)),
        lambda e: F.concat(json_string(e["key"]), F.lit(":"), json_string(F.coalesce(e["value"], F.lit("")))),
    )
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def row_hash(record: Column) -> Column:
    """Hex SHA-256 of the record's canonical JSON."""
    return F.sha2(canonical_json(record), 256)


def hash_text(digest: Column) -> Column:
    """The text of a hash's bytes."""
    return F.lower(F.hex(digest))
