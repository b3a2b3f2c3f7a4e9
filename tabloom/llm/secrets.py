"""Secret scans: patterns, and a battery of randomness tests, in DataFrame operations alone.

Three patterns give the base spans. Besides, every run of 20 or more key-like characters
is a candidate: its encoding (hexadecimal, base32, or base64 and its relatives) gives the
alphabet, and the positions of its characters in the alphabet are tested for what a random
key would show: chi-squared for even use of the alphabet's quarters, the number of runs
above and below its middle, and the correlation of neighbours. Fisher's method joins the
three probabilities. Candidates are rejected as text, file name or number by
Benjamini-Hochberg, for each class of lengths by itself as longer ones reject more easily;
those left over, with a letter and a digit, are spans of kind ``random`` unless they
overlap a base span.

Spans count code points, ends are exclusive. Null text is empty. Rows that repeat a doc_id
are judged each by its text; what is rejected depends on all candidates of the table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.llm.common import stored

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "random"]

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
# Encodings by pattern, with their alphabets in order; the first that fits counts.
ENCODINGS = [
    (r"^[0-9a-f]+$", "0123456789abcdef"),
    (r"^[0-9A-F]+$", "0123456789ABCDEF"),
    (r"^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    (r"^[A-Za-z0-9+/]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    (r"^.", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]
LENGTHS = [32, 64]
FALSE_DISCOVERIES = 0.05
STEPS_PER_E = 16
DEEPEST = 700.0


def matches(text: Column, pattern: str) -> Column:
    """The leftmost matches that do not overlap, as (gap, gap_bytes, value): each with the
    length of what lies before it. Places follow by adding up."""
    pattern_ = F.lit(pattern)
    found = F.regexp_extract_all(text, pattern_, F.lit(0))
    one = lambda gap, value: F.struct(F.length(gap).alias("gap"), F.octet_length(gap).alias("gap_bytes"), value.alias("value"))
    zipped = F.filter(F.zip_with(F.split(text, pattern, -1), found, one), lambda m: m["value"].isNotNull())
    return F.when(F.regexp_like(text, pattern_), zipped).otherwise(F.array().cast("array<struct<gap:int,gap_bytes:int,value:string>>"))


def placed_matches(documents: DataFrame) -> DataFrame:
    """One row for each span of a base kind and each candidate (kind ``random``): doc_id,
    text_hash, kind, begin, end, begin_byte, end_byte, value, free (it overlaps no base span).

    The patterns ask for the least length at once where that cannot change what is found.
    Sums and maxima run over the matches of one text in order, so the work follows their number.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    patterns = [ASSIGN, ACCESS[:-1] + "{16,}", HEX[:-1] + "{24,}", CANDIDATE]
    numbered = lambda kind: lambda m, at: F.struct(F.lit(kind).alias("kind"), at.alias("at"), m["gap"], m["gap_bytes"], m["value"])
    every = F.concat(*(F.transform(matches(text, pattern), numbered(kind)) for kind, pattern in enumerate(patterns)))
    found = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), every.alias("every"))
    found = found.select("doc_id", "text_hash", F.explode_outer("every").alias("m")).where("m IS NOT NULL")  # rows leave the text behind
    found = found.select("doc_id", "text_hash", "m.*").distinct().repartition("doc_id", "text_hash")
    so_far = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("at")
    size, size_bytes = F.length("value"), F.octet_length("value")
    found = found.withColumns({
        "end": F.sum(F.col("gap") + size).over(so_far).cast("int"),
        "end_byte": F.sum(F.col("gap_bytes") + size_bytes).over(so_far).cast("int"),
    })
    found = found.withColumns({"begin": F.col("end") - size, "begin_byte": F.col("end_byte") - size_bytes})
    secret = F.length(F.regexp_extract("value", ASSIGN, 2)) >= 6
    base = F.col("kind") < KINDS.index("random")
    of_text = Window.partitionBy("doc_id", "text_hash")
    last_end = F.max(F.when(base, F.col("end"))).over(of_text.orderBy("begin"))
    next_begin = F.min(F.when(base, F.col("begin"))).over(of_text.orderBy(F.desc("begin")))
    return (
        found.where((F.col("kind") != KINDS.index("assign")) | secret)
        .withColumns({"last_end": last_end, "next_begin": next_begin})
        .withColumn("free", F.coalesce(F.col("last_end") <= F.col("begin"), F.lit(True)) & F.coalesce(F.col("next_begin") >= F.col("end"), F.lit(True)))
        .select("doc_id", "text_hash", "kind", "begin", "end", "begin_byte", "end_byte", "value", "free")
    )


def joined(spans: Column) -> Column:
    """kind:begin:end by begin, then kind, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["begin"], s["end"])
    return F.array_join(F.transform(F.sort_array(spans), one), ",")


def complement_of_error(x: Column) -> Column:
    """erfc for x >= 0, to about 1e-7 of its value: a rational form in the exponent."""
    t = 1 / (1 + x / 2)
    # Coefficients of a published Chebyshev fit.
    factors = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    inner = F.lit(factors[-1])
    for factor in reversed(factors[:-1]):
        inner = inner * t + F.lit(factor)
    return t * F.exp(-x * x + inner)


def log_chance(candidates: DataFrame) -> DataFrame:
    """Adds ``log_p``: minus the logarithm of Fisher's joined probability, from ``value``."""
    alphabet = F.lit(ENCODINGS[-1][1])
    for pattern, letters in reversed(ENCODINGS[:-1]):
        alphabet = F.when(F.col("value").rlike(pattern), F.lit(letters)).otherwise(alphabet)
    tested = candidates.withColumn("alphabet", alphabet).withColumn("size", F.length("alphabet"))
    places_ = F.transform(F.split(F.regexp_replace("value", "=+$", ""), ""), lambda c: F.instr(F.col("alphabet"), c) - 1)
    tested = tested.withColumn("at", F.filter(places_, lambda p: p >= 0)).withColumn("n", F.size("at"))
    total = lambda column, of: F.aggregate(column, F.lit(0.0), lambda a, x: a + of(x))
    quarter = lambda k: total(F.col("at"), lambda p: F.when(F.floor(p * 4 / F.col("size")) == k, 1.0).otherwise(0.0))
    expected = F.col("n") / 4
    chi = sum((quarter(k) - expected) * (quarter(k) - expected) / expected for k in range(4))
    high = F.transform("at", lambda p: (p * 2 >= F.col("size")).cast("int"))
    pairs = F.zip_with(F.slice("at", 1, F.col("n") - 1), F.slice("at", 2, F.col("n") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    tested = tested.withColumns({"chi": chi, "high": high, "pairs": pairs, "mean": total(F.col("at"), lambda p: p.cast("double")) / F.col("n")})
    tested = tested.withColumns({
        "above": total(F.col("high"), lambda h: h.cast("double")),
        "runs": 1 + F.aggregate(F.zip_with(F.slice("high", 1, F.col("n") - 1), F.slice("high", 2, F.col("n") - 1), lambda a, b: (a != b).cast("int")), F.lit(0), lambda a, x: a + x),
        "spread": total(F.col("at"), lambda p: (p - F.col("mean")) * (p - F.col("mean"))),
        "together": total(F.col("pairs"), lambda p: (p["a"] - F.col("mean")) * (p["b"] - F.col("mean"))),
    })
    below, above, n = F.col("n") - F.col("above"), F.col("above"), F.col("n")
    mean_runs = 1 + 2 * above * below / n
    variance = F.greatest((mean_runs - 1) * (mean_runs - 2) / (n - 1), F.lit(1e-9))
    runs_z = F.when((above == 0) | (below == 0), F.lit(30.0)).otherwise(F.abs(F.col("runs") - mean_runs) / F.sqrt(variance))
    serial_z = F.when(F.col("spread") == 0, F.lit(30.0)).otherwise(F.abs(F.col("together") / F.nullif(F.col("spread"), F.lit(0.0)) + 1 / n) * F.sqrt(n))
    two_sided = lambda z: complement_of_error(F.least(z, F.lit(30.0)) / math.sqrt(2))
    x = F.least(F.col("chi"), F.lit(1000.0))
    chi_p = complement_of_error(F.sqrt(x / 2)) + F.sqrt(2 * x / math.pi) * F.exp(-x / 2)
    minus_log = lambda p: F.least(F.lit(DEEPEST), -F.log(F.greatest(p, F.lit(1e-300))))
    half = minus_log(chi_p) + minus_log(two_sided(runs_z)) + minus_log(two_sided(serial_z))
    fisher = half - F.log(1 + half + half * half / 2)
    return tested.withColumn("log_p", F.greatest(F.lit(0.0), fisher)).select(*candidates.columns, "log_p")


def not_rejected(scored: DataFrame, share: float = FALSE_DISCOVERIES) -> DataFrame:
    """Candidates that Benjamini-Hochberg does not reject among those of their class of
    lengths. Probabilities are counted in steps of a sixteenth of e, so the table of counts is small
    and the same at every size; a step counts with its larger end."""
    length_class = sum((F.length("value") >= n).cast("int") for n in LENGTHS)
    stepped = scored.withColumns({"length_class": length_class, "step": F.floor(F.col("log_p") * STEPS_PER_E)})
    counts = stepped.groupBy("length_class", "step").agg(F.count("*").alias("n"))
    by_class = Window.partitionBy("length_class")
    ranked = counts.select(
        "length_class",
        "step",
        F.sum("n").over(by_class.orderBy(F.desc("step"))).alias("rank"),
        F.sum("n").over(by_class).alias("all"),
    )
    passed = F.exp(-F.col("step") / STEPS_PER_E) <= share * F.col("rank") / F.col("all")
    limits = ranked.groupBy("length_class").agg(F.min(F.when(passed, F.col("step"))).alias("limit"))
    return stepped.join(F.broadcast(limits), "length_class").where("limit IS NULL OR step < limit").select(*scored.columns)


def secret_spans(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, kind, begin, end, begin_byte, end_byte of every span, once for each
    doc_id and text."""
    placed = stored(placed_matches(documents), "secret-matches")
    is_random = F.col("kind") == KINDS.index("random")
    mixed = F.col("value").rlike("[A-Za-z]") & F.col("value").rlike("[0-9]")
    # The candidates of one text spread over tasks, and each is tested once.
    scored = stored(log_chance(placed.where(is_random).repartition("doc_id", "begin")), "secret-scores")
    random = not_rejected(scored).where(mixed & F.col("free"))
    columns = ["doc_id", "text_hash", "kind", "begin", "end", "begin_byte", "end_byte"]
    return placed.where(~is_random).select(*columns).unionByName(random.select(*columns))


def report_secrets(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row for each row."""
    spans = F.collect_list(F.struct("begin", "kind", "end"))
    found = secret_spans(documents).groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).agg(spans.alias("found"))
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    every = F.coalesce("found", F.array().cast(found.schema["found"].dataType))
    of_kind = lambda k: F.size(F.filter("every", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("every", lambda s: s["kind"] < KINDS.index("random"))
    return (
        rows.join(found, same, "left")
        .withColumn("every", every)
        .select(
            "doc_id",
            *(of_kind(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:3])),
            F.sha2(joined(base), 256).alias("base_sha256"),
            joined(F.col("every")).alias("spans"),
        )
    )


def redact_secrets(documents: DataFrame, mark: str = "[secret]") -> DataFrame:
    """Every row with all its columns; secrets in ``text`` become ``mark`` (those that overlap
    become one), and ``n_chars``, where there is such a column, follows. Null text stays null.
    Texts are cut by byte, so a cut costs the same wherever it lies."""
    of_text = Window.partitionBy("doc_id", "text_hash").orderBy("begin_byte", "end_byte")
    before = F.max("end_byte").over(of_text.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before > F.col("begin_byte"), 0).otherwise(1)
    found = (
        secret_spans(documents)
        .withColumn("begins", begins)
        .withColumn("number", F.sum("begins").over(of_text.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "number")
        .agg(F.min("begin_byte").alias("begin"), F.max("end_byte").alias("end"))
        .groupBy("id", "hash")
        .agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("cuts"))
    )
    text = F.col("row.text")
    kept_from = F.concat(F.array(F.lit(0)), F.col("cuts.end"))
    kept_to = F.concat(F.col("cuts.begin"), F.array(F.octet_length(text)))
    bounds = F.zip_with(kept_from, kept_to, lambda a, b: F.struct(a.alias("from"), b.alias("to")))
    # One element, so that the bytes of the text are taken once and not for each piece.
    piece = lambda whole: lambda p: F.substring(whole, p["from"] + 1, p["to"] - p["from"]).cast("string")
    clean = F.transform(F.array(text.cast("binary")), lambda whole: F.array_join(F.transform(bounds, piece(whole)), mark))
    rows = documents.select(F.struct(*documents.columns).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("hash"))
    changed = rows.join(found, same, "left").withColumn("clean", F.when(F.col("cuts").isNull(), text).otherwise(F.get(clean, F.lit(0))))
    new = {"text": F.col("clean")}
    if "n_chars" in documents.columns:
        length = F.length("clean").cast(documents.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("cuts").isNull(), F.col("row.n_chars")).otherwise(length)
    return changed.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in documents.columns))
