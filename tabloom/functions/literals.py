"""Recognise and parse integers, floats, timestamps and dates written as text.

Each parser returns NULL for text that is not of its kind, so the type tests are
``parse(...) IS NOT NULL``. A regular expression decides what is accepted; the
cast that follows only computes the value.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabloom.functions.text import CURRENCY_SIGNS

# Month names, long and short.
LONG_MONTHS = [
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
]
SHORT_MONTHS = [m[:3] for m in LONG_MONTHS]

# Longest text, in bytes, that is still VARCHAR.
VARCHAR_BYTES = 512

# Rejects most plain text before the costlier expressions run.
_MOMENT_START = r"^(?:[0-9]{1,4}[-/]|[A-Za-z]{3})"

# Number patterns match the text as written: a currency sign of each kind in
# front, a percent sign behind, one extra plus, and commas anywhere between.
_C = ",*+"


def _spaced(word: str) -> str:
    return "".join(ch + _C for ch in word)


def _digits(one: str) -> str:
    return f"{one}(?:{_C}(?:_{_C})?{one})*+{_C}"


_DEC, _HEX = _digits("[0-9]"), _digits("[0-9a-fA-F]")
_FRONT = "^" + "".join(("\\" if s == "$" else "") + s + "?" for s in CURRENCY_SIGNS) + rf"{_C}(?:\+{_C})?"
_SIGN = f"(?:[+-]{_C})?"
_DECIMAL = rf"(?:{_DEC}(?:\.{_C}(?:{_DEC})?)?|\.{_C}{_DEC})(?:[eE]{_C}{_SIGN}{_DEC})?"
_HEXADECIMAL = rf"0{_C}[xX]{_C}(?:(?:_{_C})?{_HEX}(?:\.{_C}(?:{_HEX})?)?|\.{_C}{_HEX})[pP]{_C}{_SIGN}{_DEC}"
_SPELLED = f"(?i:{_SIGN}{_spaced('inf')}(?:{_spaced('inity')})?|{_spaced('nan')})"

_INT = rf"{_FRONT}{_SIGN}[0-9][0-9,]*+%?\z"
_FLOAT = rf"{_FRONT}(?:{_SIGN}(?:{_DECIMAL}|{_HEXADECIMAL})|{_SPELLED})%?\z"
_SPELLED_FLOAT = rf"{_FRONT}{_SPELLED}%?\z"

_CLOCK = "([0-9]{1,2}:[0-9]{2}:[0-9]{2}(?:[.,][0-9]+)?)"
_ISO_DAY = "([0-9]{4}-[0-9]{2}-[0-9]{2})"
_OFFSET = "([+-][0-9]{2}:[0-9]{2})"
_MONTH_DAY_YEAR = " +([0-9]{1,2}), +([0-9]{4})"

# Each layout with the text it is rewritten to; "@" stands for the month number.
_TS_LAYOUTS = [
    (rf"^{_ISO_DAY}(?: +{_CLOCK}|T{_CLOCK}(?:Z|{_OFFSET})?)\z", "$1 $2$3"),
    (rf"^([0-9]{{2}})/([0-9]{{2}})/([0-9]{{4}}) +{_CLOCK}\z", "$3-$1-$2 $4"),
    (rf"^(?i:{'|'.join(SHORT_MONTHS)}){_MONTH_DAY_YEAR} +{_CLOCK}\z", "$2-@-$1 $3"),
]
# Month first where the first number can be a padded month: the second number
# could not be one then, or both readings are valid and month-first wins.
_DATE_LAYOUTS = [
    (rf"^{_ISO_DAY}\z", "$1"),
    (r"^(0[1-9]|1[0-2])/([0-9]{2})/([0-9]{4})\z", "$3-$1-$2"),
    (r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\z", "$3-$2-$1"),
    (rf"^(?i:{'|'.join(LONG_MONTHS)}|(?:{'|'.join(SHORT_MONTHS)})\.?){_MONTH_DAY_YEAR}\z", "$2-@-$1"),
]


def parse_int(c: Column) -> Column:
    """Decorated integer text to BIGINT; out of range is NULL."""
    return F.when(c.rlike(_INT), F.regexp_replace(c, "[^0-9-]", "").try_cast("bigint"))


def _may_overflow(c: Column) -> Column:
    return c.rlike("[eEpP]") | (F.length(c) > 300)


def parse_float(c: Column) -> Column:
    """Decorated decimal, exponent, hexadecimal, ``inf`` or ``nan`` text to DOUBLE.

    A plus sign never changes the value, so all of them go with the decoration.
    """
    value = F.regexp_replace(c, f"[{''.join(CURRENCY_SIGNS)},_%+]", "").try_cast("double")
    in_range = F.when((F.abs(value) < F.lit(float("inf"))) | c.rlike(_SPELLED_FLOAT), value)
    return F.when(c.rlike(_FLOAT), F.when(_may_overflow(c), in_range).otherwise(value))


def _rewrite(c: Column, layouts: list[tuple[str, str]]) -> Column:
    """Text in one of the layouts as numbers in ISO order, else NULL; one cast then reads them all."""
    month = F.element_at(
        F.create_map(*[F.lit(x) for i, m in enumerate(SHORT_MONTHS, 1) for x in (m.lower(), f"{i:02d}")]),
        F.lower(F.substring(c, 1, 3)),
    )
    out = None
    for pattern, target in layouts:
        text = F.regexp_replace(c, pattern, target)
        if "@" in target:
            text = F.replace(text, F.lit("@"), month)
        out = F.when(c.rlike(pattern), text) if out is None else out.when(c.rlike(pattern), text)
    return F.when(c.rlike(_MOMENT_START), out)


def parse_timestamp(c: Column) -> Column:
    """Text in one of the six timestamp layouts to an instant.

    Without an offset the text is taken as UTC, whatever the session zone is.
    """
    offset = F.right(c, F.lit(6))
    hours, minutes = F.substring(offset, 2, 2).cast("int"), F.substring(offset, 5, 2).cast("int")
    seconds = F.when((hours <= 24) & (minutes <= 60), hours * 3600 + minutes * 60)
    shift = F.when(c.rlike(rf"T.*{_OFFSET}\z"), F.when(offset.startswith("-"), seconds).otherwise(-seconds)).otherwise(F.lit(0))
    local = F.translate(_rewrite(c, _TS_LAYOUTS), ",", ".")
    return F.timestamp_add("SECOND", shift, F.concat(local, F.lit("Z")).try_cast("timestamp"))


def parse_date(c: Column) -> Column:
    """Text in one of the six date layouts to DATE; month-first wins over day-first."""
    return _rewrite(c, _DATE_LAYOUTS).try_cast("date")


def is_int(c: Column) -> Column:
    """Up to 18 characters always fit BIGINT, so only longer ones are parsed."""
    return c.rlike(_INT) & ((F.length(c) <= 18) | parse_int(c).isNotNull())


def is_float(c: Column) -> Column:
    return c.rlike(_FLOAT) & (~_may_overflow(c) | parse_float(c).isNotNull())


def is_timestamp(c: Column) -> Column:
    return parse_timestamp(c).isNotNull()


def is_date(c: Column) -> Column:
    return parse_date(c).isNotNull()


def is_long_text(c: Column) -> Column:
    return F.octet_length(c) > VARCHAR_BYTES


def value_kind(c: Column) -> Column:
    """Narrowest kind of a cleaned value: I, F, T, A (date) or S; NULL when empty."""
    return (
        F.when(c == "", F.lit(None).cast("string"))
        .when(is_int(c), F.lit("I"))
        .when(is_float(c), F.lit("F"))
        .when(is_timestamp(c), F.lit("T"))
        .when(is_date(c), F.lit("A"))
        .otherwise(F.lit("S"))
    )


def fits(c: Column, declared: Column) -> Column:
    """Whether a cleaned, non-empty value can be stored under its declared type."""
    return (
        F.when(declared == "BIGINT", is_int(c))
        .when(declared == "DOUBLE", is_float(c))
        .when(declared.isin("TIMESTAMP", "DATE"), is_timestamp(c) | is_date(c))
        .otherwise(F.lit(True))
    )


def load_value(c: Column, declared: str) -> Column:
    """The value of a cleaned text as the Spark type behind ``declared``."""
    if declared == "BIGINT":
        return parse_int(c)
    if declared == "DOUBLE":
        return parse_float(c)
    if declared == "TIMESTAMP":
        midnight = F.concat(parse_date(c).cast("string"), F.lit(" 00:00:00Z")).cast("timestamp")
        return F.coalesce(parse_timestamp(c), midnight)
    if declared == "DATE":
        # Days are taken in UTC, the zone every instant here is written in.
        micros = F.unix_micros(parse_timestamp(c))
        midnight = micros - F.pmod(micros, F.lit(86_400_000_000))
        day = F.date_from_unix_date((midnight / F.lit(86_400_000_000)).cast("int"))
        return F.coalesce(parse_date(c), day)
    return F.nullif(c, F.lit(""))
