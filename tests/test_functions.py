import datetime as dt
import hashlib
import json
import math

import pytest
from pyspark.sql import functions as F

from tabloom.functions import canonical, literals, names, text


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def check(spark, fn, cases):
    got = apply(spark, fn, list(cases))
    assert dict(zip(cases, got)) == cases


def test_clean_value(spark):
    tokens = ["", "—", "–", "-", "N/A", "n/a", "NA", "?"]
    spaces = ["", " ", "\u3000", "\x85 \t", "\u2003"]
    cases = {f"{left}{token}{note}{right}": "" for token in tokens for left in spaces for right in spaces for note in ("", "[9]", "[z][12]")}
    cases |= {f"{left}q{k} r{note}{right}": f"q{k} r" for k, (left, right) in enumerate(zip(spaces, reversed(spaces))) for note in ("", "[k]")}
    check(spark, text.clean_value, cases | {"Na": "Na", "s[1]t[2]": "st", "[open": "[open", "\u200bx": "\u200bx"})


def test_trim_agrees_with_the_unicode_property(spark):
    """Every code point Java calls White_Space is trimmed, and none besides."""
    df = spark.range(1, 0x10000).filter("id < 55296 or id > 57343").select(
        F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE").alias("c")
    )
    trimmed = text.unicode_trim(F.concat("c", F.lit("x"), "c")) == "x"
    assert df.filter(trimmed != F.col("c").rlike(r"^\p{IsWhite_Space}\z")).count() == 0


def test_strip_decorations(spark):
    check(spark, text.strip_decorations, {
        "$5": "5", "$€£¥₹5%": "5", "€$5": "$5", "-$5": "-$5", "$$5": "$5", "5%%": "5%", "% 5": "% 5", "$ 5": " 5", "%": "",
    })


def test_sanitise_name(spark):
    """Letters and digits stay in lower case, anything between becomes one mark, none at the ends."""
    parts = ["Height", "m2", "OF", "x9", "é"]
    cases = {}
    for mark in (" ", " / ", "-", "__", " (", "% "):
        raw = mark.join(parts)
        cases[raw] = "height_m2_of_x9"
        cases[f"{mark}{raw}{mark}[4]"] = "height_m2_of_x9"
    cases |= {"": "col", "—": "col", "[q]": "col", "ORDER": "order_", "Y" * 80: "y" * 64}
    check(spark, names.sanitise_name, cases)


def test_dedupe_names(spark):
    headers = ["price", "price", "name", "name", "a", "a_2", "a", "a", "x" * 64, "x" * 64]
    df = spark.createDataFrame([(1, i, h) for i, h in enumerate(headers)], "t int, pos int, base string")
    got = [r["name"] for r in names.dedupe_names(df, ["t"], "base", "pos").orderBy("pos").collect()]
    assert got[:8] == ["price", "price_2", "name", "name_2", "a", "a_2", "a_2__6", "a_3"]
    assert len(set(got)) == len(got) and max(map(len, got)) <= 64


INTS = {
    "5": 5, "-5": -5, "+5": 5, "++5": 5, "+-5": -5, "1,400,000": 1400000, "$1,234": 1234, "€5,000,000": 5000000, "12%": 12,
    "$€7": 7, "€$7": None, "-$5": None, "$-5": -5, "5%%": None, "5 ": None, " 5": None, "5\n": None, "5.0": None, "": None,
    ",": None, "9223372036854775807": 2**63 - 1, "9223372036854775808": None, "-9223372036854775808": -(2**63),
    "0000000000000000000000005": 5, "1_000": None, "0x10": None, "2024": 2024, "٣": None, "5,%": 5, "5%,": None,
}


def test_parse_int(spark):
    check(spark, literals.parse_int, INTS)
    assert apply(spark, literals.is_int, list(INTS)) == [v is not None for v in INTS.values()]


FLOATS = {
    "3.5": 3.5, "3.5%": 3.5, "-0.5%": -0.5, "5.": 5.0, ".5": 0.5, ".": None, "1e5": 1e5, "1E-3": 1e-3, "1e400": None, "-1e400": None,
    "1e-400": 0.0, "1_000": 1000.0, "1_23.50_0_0e+1_2": 1.235e14, "1__0": None, "_1": None, "1_": None, "1_.5": None, "1._5": None,
    "0x1p-2": 0.25, "0x_1p-2": 0.25, "0X1.8P1": 3.0, "0x10": None, "0x.p1": None, "1.0d": None, "1f": None, "1,2,3.4,5": 123.45,
    "Inf": math.inf, "-infinity": -math.inf, "+INF": math.inf, "infinit": None, "-nan": None, "$1.5": 1.5, "1 .5": None, "1e": None,
    "e5": None, "": None, "42": 42.0, "9" * 400: None, "0." + "1" * 400: float("0." + "1" * 400), "1e5\n": None,
}


def test_parse_float(spark):
    check(spark, literals.parse_float, FLOATS)
    assert apply(spark, literals.is_float, list(FLOATS)) == [v is not None for v in FLOATS.values()]
    assert all(map(math.isnan, apply(spark, literals.parse_float, ["NaN", "+nan", "$NAN%"])))


TIMES = {
    "2024-01-15 09:30:00": "2024-01-15T09:30:00", "2024-01-15   9:30:00.5": "2024-01-15T09:30:00.500000",
    "2024-01-15 09:30:00,123456789012": "2024-01-15T09:30:00.123456", "2024-01-15T09:30:00Z": "2024-01-15T09:30:00",
    "2024-01-15T09:30:00": "2024-01-15T09:30:00", "2024-01-15T09:30:00+05:30": "2024-01-15T04:00:00",
    "2024-01-15T09:30:00-23:00": "2024-01-16T08:30:00", "2024-01-15T09:30:00+25:00": None, "2024-01-15 09:30:00Z": None,
    "2024-01-15t09:30:00": None, "01/02/2024 10:11:12": "2024-01-02T10:11:12", "1/2/2024 10:11:12": None,
    "13/01/2024 10:11:12": None, "Jan 2, 2024 10:11:12": "2024-01-02T10:11:12", "jan  02,  2024  1:11:12": "2024-01-02T01:11:12",
    "January 2, 2024 10:11:12": None, "2024-02-30 00:00:00": None, "2024-01-15 24:00:00": None, "2024-01-15 09:60:00": None,
    "2024-01-15 09:30": None, "2024-01-15": None, "": None, "2024-01-15 09:30:00\n": None,
}


def test_parse_timestamp(spark):
    def iso(c):
        return F.unix_micros(literals.parse_timestamp(c))

    epoch = dt.datetime(1970, 1, 1)
    want = {k: v and (dt.datetime.fromisoformat(v) - epoch) // dt.timedelta(microseconds=1) for k, v in TIMES.items()}
    check(spark, iso, want)


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        micros = apply(spark, lambda c: F.unix_micros(literals.load_value(c, "TIMESTAMP")), ["1970-01-02", "1970-01-02 00:00:01"])
        days = apply(spark, lambda c: literals.load_value(c, "DATE"), ["1970-01-02 23:59:59", "9999-12-31 23:59:59.999999"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert micros == [86_400_000_000, 86_401_000_000]
    assert days == [dt.date(1970, 1, 2), dt.date(9999, 12, 31)]


DATES = {
    "2024-01-15": dt.date(2024, 1, 15), "2024-1-15": None, "01/02/2024": dt.date(2024, 1, 2), "13/01/2024": dt.date(2024, 1, 13),
    "1/2/2024": dt.date(2024, 2, 1), "31/4/2024": None, "January 2, 2024": dt.date(2024, 1, 2), "Jan 2, 2024": dt.date(2024, 1, 2),
    "Jan. 2, 2024": dt.date(2024, 1, 2), "JAN. 02,   2024": dt.date(2024, 1, 2), "May 5, 2020": dt.date(2020, 5, 5),
    "May. 5, 2020": dt.date(2020, 5, 5), "January. 2, 2024": None, "Sept 2, 2024": None, "Jan 2,2024": None, "Jan 2 2024": None,
    "2024": None, "2023-02-29": None, "2024-02-29": dt.date(2024, 2, 29), "Feb 30, 2024": None, "": None, "Jan 2, 24": None,
}


def test_parse_date(spark):
    check(spark, literals.parse_date, DATES)


def test_long_text_counts_bytes(spark):
    check(spark, literals.is_long_text, {"a" * 512: False, "a" * 513: True, "é" * 256: False, "é" * 257: True})


def expected_json(record):
    out = json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    for ch in "<>&  ":
        out = out.replace(ch, f"\\u{ord(ch):04x}")
    return out.replace("\\b", "\\u0008").replace("\\f", "\\u000c")


RECORDS = [
    {"b": "1", "a": "x", "B": "y", "é": "z", "": ""}, {"a": 'q"\\ \n\r\t\x01\x1f\x7f <b>&amp;  '}, {"k": "\x08\x0c"}, {},
    {"k": "emoji 😀", "😀": "é"},
]


@pytest.mark.parametrize("record", RECORDS)
def test_canonical_json_and_hash(spark, record):
    df = spark.createDataFrame([(record,)], "r map<string,string>")
    got, digest = df.select(canonical.canonical_json(F.col("r")), canonical.row_hash(F.col("r"))).first()
    assert got == expected_json(record)
    assert digest == hashlib.sha256(expected_json(record).encode()).hexdigest()
