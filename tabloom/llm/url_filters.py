"""URL filters: rules found by their rarest literal token, in DataFrame operations alone.

A rule is a text of the usual filter-list form. ``||host/path`` fits a host and all its
subdomains, where the address goes on with the path as written. Any other rule is a pattern
over host and all that follows, letters in either case: ``*`` stands for anything, ``^`` for
a separator (neither letter, digit nor one of ``_.%-``) or the end, ``|`` at the start or the
end for that place, other characters for themselves.

Words of letters and digits that an address must hold whole for a rule to fit are the rule's
tokens. Each rule is filed under the one that stands in the fewest addresses of the given
table. The tokens of an address fetch their rules, and only those run as regular expressions.
A rule without a token is filed under the empty token, which every address has.

Rules on hosts decide first: the longest that fits, ``allow`` before ``block`` among equally
long ones. Else patterns decide, ``allow`` before ``block``; else the address is allowed.
Among rules that are equal in this, the one whose text is last in byte order counts.

A null address, or one without ``://``, has an empty host and path, no rule and is allowed.
Rows that repeat a page_id or an address are judged each by its own address. Null rules, or
such without a known verdict, are left out; an empty rule table allows everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST_ONLY = r"^(?:[^/?#]*\.)?"
SEPARATOR = r"(?:[^0-9A-Za-z_.%-]|\z)"

HOST_RULES = [("||net/", "block"), ("||example.net/en/", "allow"), ("||example.com/de/", "block"), ("||org/fr/", "allow")]
# Addresses that seldom lead to prose: shops, sign-ins, trackers, adult hosts, files.
BLOCKED_PATHS = ["login", "signin", "signup", "logout", "cart", "checkout", "wp-admin", "wp-login.php", "cgi-bin", "ads", "banners"]
BLOCKED_HOSTS = ["ads.", "ads-", "adserver.", "adult.", "adult-", "porn.", "tracker.", "pixel."]
BLOCKED_ENDINGS = ["jpg", "jpeg", "png", "gif", "svg", "css", "js", "zip", "gz", "exe", "mp3", "mp4"]
PATTERN_RULES = [
    *((f"/{name}^", "block") for name in BLOCKED_PATHS),
    *((f"{place}{label}", "block") for label in BLOCKED_HOSTS for place in "|."),
    ("-track.", "block"),
    *((f".{ending}^", "block") for ending in BLOCKED_ENDINGS),
    ("?replytocom=", "block"),
    ("&sessionid=", "block"),
    ("/robots.txt|", "allow"),
    ("/help/login^", "allow"),
]


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """A small list of (rule, verdict) as a table."""
    rows = [F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")) for rule, verdict in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def compiled(rules: DataFrame) -> DataFrame:
    """rule, on_host, allow, pattern (a regular expression), tokens."""
    given = F.col("rule")
    on_host = given.startswith("||")
    host = F.regexp_extract(given, r"^\|\|([^/?#]*)", 1)
    rule = F.when(on_host, F.concat(F.lit("||"), lowered(host), F.substring(given, F.length(host) + 3, F.length(given)))).otherwise(given)
    known = rules.where(given.isNotNull() & F.col("verdict").isin("allow", "block"))
    known = known.select(rule.alias("rule"), (F.col("verdict") == "allow").alias("allow")).distinct()
    rule, on_host = F.col("rule"), F.col("rule").startswith("||")
    at_start, at_end = rule.startswith("|") & ~on_host, rule.rlike(r"(?s)^\|{0,2}.+\|\z") & ~on_host
    body = F.regexp_replace(rule, r"^\|\|?", "")
    body = F.when(at_end, F.regexp_replace(body, r"\|\z", "")).otherwise(body)
    body = F.regexp_replace(body, r"([\\.?+$(){}\[\]|])", r"\\$1")
    # In a rule on hosts all characters stand for themselves.
    literal = F.regexp_replace(body, r"([*^])", r"\\$1")
    body = F.regexp_replace(F.regexp_replace(body, r"\*", ".*"), r"\^", SEPARATOR.replace("\\", r"\\"))
    pattern = F.when(on_host, F.concat(F.lit("(?s)" + HOST_ONLY), literal)).otherwise(
        F.concat(F.lit("(?is)"), F.when(at_start, "^").otherwise(""), body, F.when(at_end, r"\z").otherwise(""))
    )
    edge = F.lit(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])")
    tokens = F.array_distinct(F.regexp_extract_all(lowered(rule), edge, F.lit(0)))
    return known.select("rule", on_host.alias("on_host"), "allow", pattern.alias("pattern"), tokens.alias("tokens"))


def split_url(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path, target (lower-case host and all that follows it)."""
    rest = F.when(F.contains("url", F.lit("://")), F.substring("url", F.instr("url", "://") + 3, F.length("url"))).otherwise("")
    parts = pages.select("page_id", "url").withColumn("rest", F.coalesce(rest, F.lit("")))
    parts = parts.withColumn("host", F.regexp_extract("rest", r"^[^/?#]*", 0))
    after = F.substring("rest", F.length("host") + 1, F.length("rest"))
    return parts.select(
        "page_id",
        "url",
        lowered(F.col("host")).alias("host"),
        F.regexp_extract(after, r"^[^?#]*", 0).alias("path"),
        F.concat(lowered(F.col("host")), after).alias("target"),
    )


def token_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Each rule with the token, of those it has, that stands in the fewest addresses."""
    rules = stored(compiled(rules), "url-rules")
    wanted = rules.select("rule", "allow", F.explode("tokens").alias("token"))
    seen = urls.select(F.explode(tokens_of("target")).alias("token"))
    counts = seen.join(wanted.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rarest = (
        wanted.join(counts, "token", "left")
        .groupBy("rule", "allow")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    )
    filed = rules.drop("tokens").join(rarest, ["rule", "allow"], "left")
    return stored(filed.withColumn("token", F.coalesce("token", F.lit(""))), "url-index")


def tokens_of(target: str) -> Column:
    """The tokens of an address, each once; the empty one is always among them."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(lowered(F.col(target)), "[^a-z0-9]+")))


def filter_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern of every row of ``pages`` (page_id, url).

    ``rules`` has the columns rule and verdict. ``rule`` is the rule on hosts that decided,
    ``pattern`` the pattern that did, null otherwise. Both joins leave it to Spark whether a
    side is small enough to broadcast; addresses that are frequent, and tokens that are, are
    split by adaptive execution, as both sides of the joins come from plain exchanges."""
    urls = split_url(pages)
    addresses = urls.where(F.contains("url", F.lit("://")))
    index = token_index(rules, addresses)
    fits = F.rlike(F.col("target"), F.col("pattern"))
    fetched = addresses.select("url", "target", F.explode(tokens_of("target")).alias("token")).join(index, "token")
    length = F.when(F.col("on_host"), F.length("rule")).otherwise(0)
    best = F.max(F.struct("on_host", length.alias("length"), "allow", "rule"))
    decided = stored(fetched.where(fits).groupBy("url").agg(best.alias("best")), "url-verdicts")
    # Rows without an address meet nothing, each at a place of its own.
    key = F.when(F.contains("url", F.lit("://")), F.col("url")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id")))
    rows = urls.drop("target").withColumn("key", key)
    judged = rows.join(decided.select(F.col("url").alias("key"), "best"), "key", "left")
    on_host, allow = F.coalesce("best.on_host", F.lit(False)), F.coalesce("best.allow", F.lit(True))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.when(on_host, F.substring("best.rule", 3, F.length("best.rule"))).alias("rule"),
        F.when(allow, "allow").otherwise("block").alias("verdict"),
        F.when(~on_host, F.col("best.rule")).alias("pattern"),
    )


def judge_pages(pages: DataFrame) -> DataFrame:
    return filter_urls(pages, rule_table(pages.sparkSession, HOST_RULES + PATTERN_RULES))
