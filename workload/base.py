"""Registry of checked queries and the expressions both engines share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.session import configure
from tabloom.sources.pages import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given Parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return spread(self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet"))


def query(name: str, oracle: str | None = None) -> Callable:
    """Register ``fn(tables)`` under ``name``, with the SQL that must give the same rows."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def choose(selector: str, values: list[str], otherwise: str) -> str:
    """A CASE that both engines read: the n-th value where ``selector`` is n."""
    arms = " ".join(f"WHEN {i} THEN {quoted(v)}" for i, v in enumerate(values))
    return f"CASE {selector} {arms} ELSE {otherwise} END"


# Texts on which number, date and time parsers tend to disagree.
EDGE_TEXTS = [
    "5.", ".5", ".", "+3", "++5", "+-7", "$-5", "-$5", "€$5", "$€5", "₹1,000", "1e400", "1e5", "1.5E-3", "1_000",
    "1__0", "_1", "NaN", "-nan", "Inf", "-Infinity", "infinit", "1.0d", "1f", "5 6", "1 000", "12%", "12%%", "%",
    "$", ",", "1,2,3", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "007", "2024",
    "2024-01-15 09:30:00", "2024-01-15 9:30:00.5", "2024-01-15   09:30:00,25", "2024-01-15T09:30:00Z",
    "2024-01-15T09:30:00", "2024-01-15T09:30:00+05:30", "2024-01-15 09:30:00+05:30", "2024-01-15 24:00:00",
    "2024-01-15 09:60:00", "01/02/2024 10:11:12", "13/01/2024 10:11:12", "mar  3,  2024 1:02:03", "2024-02-30",
    "2024-02-29", "2023-02-29", "2024-1-5", "13/01/2024", "01/02/2024", "1/2/2024", "31/4/2024", "May 5, 2020",
    "may. 5, 2020", "September 05, 2020", "Sept 5, 2020", "SEP. 5, 2020", "June. 5, 2020", "Feb 30, 2021",
    "5 May 2020", "12:30:00", "plain text", "true", "0x1F", "é€", "1'000",
]

MONTHS_SQL = (
    "CASE month(l_shipdate) WHEN 1 THEN 'Jan' WHEN 2 THEN 'February' WHEN 3 THEN 'Mar.' WHEN 4 THEN 'April' "
    "WHEN 5 THEN 'May' WHEN 6 THEN 'jun' WHEN 7 THEN 'JULY' WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sep.' WHEN 10 THEN 'October' "
    "WHEN 11 THEN 'Nov' ELSE 'December' END"
)
DAY_SQL = "CAST(CAST(l_shipdate AS DATE) AS STRING)"
PRICE_SQL = "CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING)"

# One text per lineitem: every part number modulo the list picks an edge text, other rows carry real data.
VALUE_SQL = choose(
    "l_partkey % 199",
    EDGE_TEXTS,
    "CASE l_linenumber "
    f"WHEN 1 THEN '$' || {PRICE_SQL} "
    "WHEN 2 THEN CAST(l_orderkey AS STRING) || ',000' "
    f"WHEN 3 THEN {DAY_SQL} "
    f"WHEN 4 THEN {DAY_SQL} || 'T09:30:00-07:00' "
    f"WHEN 5 THEN {MONTHS_SQL} || ' ' || CAST(day(l_shipdate) AS STRING) || ', ' || CAST(year(l_shipdate) AS STRING) "
    "WHEN 6 THEN l_returnflag || l_linestatus || ' line' "
    "ELSE CAST(CAST(l_discount AS DECIMAL(5,2)) AS STRING) || '%' END",
)


def lineitem_values(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.expr(VALUE_SQL).alias("value"))


LINEITEM_VALUES = f"(SELECT l_orderkey, l_linenumber, {VALUE_SQL} AS value FROM lineitem)"

# ---- DuckDB spellings of the cleaning and parsing rules, built from SQL text ----

_WS = r"\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def sql_footnotes(x: str) -> str:
    return rf"regexp_replace({x}, '\[[^\]]*\]', '', 'g')"


def sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def sql_null_tokens(x: str) -> str:
    return f"CASE WHEN {x} IN ('—','–','-','N/A','n/a','NA','?') THEN '' ELSE {x} END"


def sql_clean(x: str) -> str:
    return sql_null_tokens(f"({sql_trim(sql_footnotes(x))})")


def sql_strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^\$?€?£?¥?₹?', ''), '%$', '')"


def sql_number_text(x: str) -> str:
    return rf"regexp_replace(replace({sql_strip(x)}, ',', ''), '^\+', '')"


def sql_int(n: str) -> str:
    """From number text."""
    return f"CASE WHEN regexp_full_match({n}, '[+-]?[0-9]+') THEN TRY_CAST({n} AS BIGINT) END"


_D = "[0-9](_?[0-9])*"


def sql_is_float(n: str) -> str:
    """From number text; hexadecimal floats do not occur in the data."""
    shape = rf"[+-]?(({_D})(\.({_D})?)?|\.({_D}))([eE][+-]?({_D}))?"
    value = f"TRY_CAST(replace({n}, '_', '') AS DOUBLE)"
    return (
        f"(regexp_full_match(lower({n}), '[+-]?inf(inity)?|nan') OR "
        f"(regexp_full_match({n}, '{shape}') AND coalesce(isfinite({value}), false)))"
    )


_CLOCK = "([01]?[0-9]|2[0-3]):[0-9]{2}:[0-9]{2}([.,][0-9]+)?"
_MON = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
_LONG = "january|february|march|april|may|june|july|august|september|october|november|december"


def _instant(text: str) -> str:
    return f"TRY_CAST(replace({text}, ',', '.') AS TIMESTAMP)"


def sql_timestamp(v: str) -> str:
    """UTC timestamp of a text in one of the layouts, else NULL."""
    month = f"lpad(CAST(list_position(string_split('{_MON}', '|'), lower({v}[1:3])) AS VARCHAR), 2, '0')"
    t = "([0-9:.,]+)"
    named = (
        f"regexp_extract({v}, ', +([0-9]+) ', 1) || '-' || {month} || '-' || "
        f"lpad(regexp_extract({v}, ' +([0-9]+),', 1), 2, '0') || ' ' || regexp_extract({v}, ' {t}$', 1)"
    )
    off = f"{v}[-6:]"
    minutes = f"(CAST({off}[2:3] AS INT) * 60 + CAST({off}[5:6] AS INT)) * CASE {off}[1] WHEN '-' THEN -1 ELSE 1 END"
    iso = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
    return f"""CASE
      WHEN regexp_full_match({v}, '{iso} +{_CLOCK}') THEN {_instant(f"regexp_replace({v}, ' +', ' ')")}
      WHEN regexp_full_match({v}, '{iso}T{_CLOCK}Z?') THEN {_instant(f"replace(replace({v}, 'T', ' '), 'Z', '')")}
      WHEN regexp_full_match({v}, '{iso}T{_CLOCK}[+-][0-9]{{2}}:[0-9]{{2}}')
        THEN {_instant(f"replace({v}[:-7], 'T', ' ')")} - to_minutes(CAST({minutes} AS BIGINT))
      WHEN regexp_full_match({v}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}} +{_CLOCK}')
        THEN {_instant(f"{v}[7:10] || '-' || {v}[1:2] || '-' || {v}[4:5] || ' ' || ltrim({v}[11:])")}
      WHEN regexp_full_match(lower({v}), '({_MON}) +[0-9]{{1,2}}, +[0-9]{{4}} +{_CLOCK}') THEN {_instant(named)}
    END"""


def sql_date(v: str) -> str:
    parts = f"string_split({v}, '/')"

    def ymd(month: int, day: int) -> str:
        return f"TRY_CAST({parts}[3] || '-' || lpad({parts}[{month}], 2, '0') || '-' || lpad({parts}[{day}], 2, '0') AS DATE)"

    month = f"lpad(CAST(list_position(string_split('{_MON}', '|'), lower({v}[1:3])) AS VARCHAR), 2, '0')"
    named = f"{v}[-4:] || '-' || {month} || '-' || lpad(regexp_extract({v}, ' +([0-9]+),', 1), 2, '0')"
    return f"""CASE
      WHEN regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST({v} AS DATE)
      WHEN regexp_full_match({v}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') THEN coalesce({ymd(1, 2)}, {ymd(2, 1)})
      WHEN regexp_full_match({v}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') THEN {ymd(2, 1)}
      WHEN regexp_full_match(lower({v}), '({_LONG}|({_MON})[.]?) +[0-9]{{1,2}}, +[0-9]{{4}}') THEN TRY_CAST({named} AS DATE)
    END"""


def sql_kinds(source: str, keep: str, value: str = "value") -> str:
    """A subquery with ``keep`` columns, the cleaned value ``v`` and its kind letter ``k`` (empty rows gone)."""
    return f"""(SELECT {keep}, v, CASE WHEN {sql_int('n')} IS NOT NULL THEN 'I' WHEN {sql_is_float('n')} THEN 'F'
        WHEN ({sql_timestamp('v')}) IS NOT NULL THEN 'T' WHEN ({sql_date('v')}) IS NOT NULL THEN 'A' ELSE 'S' END AS k
      FROM (SELECT *, {sql_number_text('v')} AS n FROM (SELECT *, {sql_clean(value)} AS v FROM {source})) WHERE v <> '')"""


# The inference rule as the row-by-row fold it is defined by; kinds arrive as letter plus length class.
SQL_FOLD = """list_reduce(list_prepend('BIGINT', {steps}), lambda acc, x: CASE
    WHEN acc = 'BIGINT' AND x[1] = 'I' THEN 'BIGINT'
    WHEN acc IN ('BIGINT', 'DOUBLE') AND x[1] IN ('I', 'F') THEN 'DOUBLE'
    WHEN acc IN ('BIGINT', 'DOUBLE', 'TIMESTAMP') AND x[1] = 'T' THEN 'TIMESTAMP'
    WHEN acc IN ('BIGINT', 'DOUBLE', 'TIMESTAMP', 'DATE') AND x[1] = 'A' THEN 'DATE'
    WHEN x[2] = 'L' THEN 'TEXT' ELSE 'VARCHAR(512)' END)"""


def sql_fold(order: str) -> str:
    return SQL_FOLD.format(steps=f"list(k || CASE WHEN strlen(v) > 512 THEN 'L' ELSE 's' END ORDER BY {order})")


def sql_json(x: str) -> str:
    """A JSON string literal; other control characters do not occur in the data."""
    out = x
    for raw, esc in [("\\", "\\\\"), ('"', '\\"'), ("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026")]:
        out = f"replace({out}, {quoted(raw)}, {quoted(esc)})"
    for code, esc in [(10, "\\n"), (13, "\\r"), (9, "\\t"), (8232, "\\u2028"), (8233, "\\u2029")]:
        out = f"replace({out}, chr({code}), {quoted(esc)})"
    return f"""('"' || {out} || '"')"""


def sql_name(x: str) -> str:
    base = f"lower(trim(regexp_replace({sql_trim(sql_footnotes(x))}, '[^a-zA-Z0-9]+', '_', 'g'), '_'))"
    return (
        f"(SELECT left(CASE WHEN b IN ('rank','index','order','key','group') THEN b || '_' WHEN b = '' THEN 'col' ELSE b END, 64)"
        f" FROM (SELECT {base} AS b))"
    )
