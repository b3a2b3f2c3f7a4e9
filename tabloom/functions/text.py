"""Cleaning of cell text. Every function is Column -> Column and stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts that stand for "no data".
NULL_TOKENS = ["—", "–", "-", "N/A", "n/a", "NA", "?"]

# Currency signs, in the order in which they are stripped.
CURRENCY_SIGNS = ["$", "€", "£", "¥", "₹"]

# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_footnotes(c: Column) -> Column:
    """Delete every ``[...]`` marker; text without a bracket skips the pattern."""
    return F.when(F.contains(c, F.lit("[")), F.regexp_replace(c, r"\[[^\]]*\]", "")).otherwise(c)


def unicode_trim(c: Column) -> Column:
    """Trim all Unicode white space; ``trim`` alone only knows U+0020."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def split_words(c: Column) -> Column:
    """Split on Unicode white space."""
    return F.split(c, r"\p{IsWhite_Space}+")


def null_tokens(c: Column) -> Column:
    """Map the "no data" tokens to the empty string."""
    return F.when(c.isin(NULL_TOKENS), F.lit("")).otherwise(c)


def clean_value(c: Column) -> Column:
    """Footnotes out, white space trimmed, "no data" emptied."""
    return null_tokens(unicode_trim(strip_footnotes(c)))


def strip_decorations(c: Column) -> Column:
    """Drop at most one of each currency sign in front, then one ``%`` behind."""
    signs = "".join(rf"\{s}?" if s == "$" else f"{s}?" for s in CURRENCY_SIGNS)
    return F.regexp_replace(F.regexp_replace(c, f"^{signs}", ""), r"%\z", "")


def number_text(c: Column) -> Column:
    """The digits a number test looks at: no decoration, no commas, one ``+`` less."""
    return F.regexp_replace(F.replace(strip_decorations(c), F.lit(","), F.lit("")), r"^\+", "")


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
