"""Address rules by rarest token, against every rule tried on every address."""

import random
import re

import pytest
from tests.oracle import connect, difference

from tabloom.llm import queries, url_filters
from tabloom.llm.oracles import _pattern
from tabloom.llm.url_filters import HOST_RULES, PATTERN_RULES, filter_urls, judge_pages, rule_table

SCHEMA = "page_id long, url string, html string, host string, rule string, token string, target string, n long, best string"


def pages(spark, urls):
    rows = [(k, u, None, "h", "r", "t", "g", 1, "b") for k, u in urls]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def plain(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow", None
    rest = url[url.index("://") + 3 :]
    raw = re.match(r"[^/?#]*", rest)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
    path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    target = host + rest[len(raw) :]
    fits = []
    for rule, verdict in rules:
        if rule.startswith("||"):
            # A rule without a slash may end inside a label or a path; one with it fits whole hosts.
            labels = host.split(".")
            tails = [".".join(labels[k:]) + target[len(host) :] for k in range(len(labels))]
            if any(t.startswith(rule[2:]) for t in tails):
                fits.append((True, len(rule), verdict == "allow", rule))
        elif re.search(_pattern(rule).replace(r"\z", r"\Z"), target):
            fits.append((False, 0, verdict == "allow", rule))
    if not fits:
        return host, path, None, "allow", None
    on_host, _, allow, rule = max(fits)
    return host, path, rule[2:] if on_host else None, "allow" if allow else "block", None if on_host else rule


ODD = [
    None, "", "://", "http://", "net/", "http:/net/", "mailto:a@net", "http://net/", "HTTP://NET/", "http://net", "http://net?x=/",
    "http://a.net/x", "http://anet/x", "http://.net/", "http://EXAMPLE.Net/en/", "http://example.net/EN/", "http://example.net/en",
    "http://x.example.net/en/?a", "http://notexample.net/en/1", "http://example.com/de/", "http://a.b.example.com/de/x#y",
    "http://org/fr/", "http://w.org/fr/a", "http://w.org/fr", "http://u:p@w.org/fr/", "http://w.org:80/fr/", "http://é.org/fr/é",
    "http://a#b.net/", "http://a?b.net/", "x://y://a.net/", "http://a/\nb.net/", "http://a.de/LOGIN", "http://a.de/login.html",
    "http://a.de/help/login?x", "http://a.de/x.JPG", "http://a.de/x.jpgs", "http://ads.de/", "http://m.ads-x.de/", "http://a.de/robots.txt",
    "http://robots.txt/login", "http://a.de/" + "very-long/" * 20_000 + "cart/", "http://a.de/?a&sessionid=3", "https://x-track.example.com/",
]




def test_contract_rules_and_patterns(spark):
    urls = [(k if k % 7 else None, u) for k, u in enumerate(ODD)] + [(3, "http://net/"), (3, "http://net/"), (None, None)]
    got = judge_pages(pages(spark, urls)).collect()
    want = [(k, *plain(u, HOST_RULES + PATTERN_RULES)) for k, u in urls]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_random_rules(spark, broadcast):
    r = random.Random(9)
    words = ["a", "b1", "shop", "Net", "de", "x9"]
    text = lambda seps, n: "".join(r.choice(words) + r.choice(seps) for _ in range(n))
    urls = [(k, f"http://{text('.', 2)}{r.choice(['de', 'com'])}/{text('/-.?=&|', r.randint(0, 5))}") for k in range(400)]
    rules = [("||" + text(".", r.randint(0, 2)).lower() + "de/" + text("/", r.randint(0, 1)), r.choice(["allow", "block"])) for _ in range(40)]
    rules += [(r.choice(["", "|", "/", "*"]) + text("/-.*^|?=", r.randint(1, 3)) + r.choice(["", "|", "^", "*"]), r.choice(["allow", "block"])) for _ in range(120)]
    rules = sorted(set(rules))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        got = filter_urls(pages(spark, urls), rule_table(spark, rules)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = [(k, *plain(u, rules)) for k, u in urls]
    assert sorted(map(tuple, got)) == sorted(want)
    assert len({g["verdict"] for g in got}) == 2 and any(g["rule"] for g in got) and any(g["pattern"] for g in got)


def test_no_pages_and_no_rules(spark):
    none = pages(spark, [(1, "http://net/")])
    assert judge_pages(none.where("page_id = 2")).collect() == []
    rules = rule_table(spark, [("||net/", "block"), ("||net/", "perhaps"), (None, "block")])
    assert [tuple(r) for r in filter_urls(none, rules.where("rule = 'x'")).collect()] == [(1, "net", "/", None, "allow", None)]
    assert [tuple(r) for r in filter_urls(none, rules).collect()] == [(1, "net", "/", "net/", "block", None)]


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = url_filters.split_url(pages(spark, [(k, "http://example.net/en/" if k else "http://example.net/de/") for k in range(9)]))
    index = url_filters.token_index(rule_table(spark, [("||example.net/de/", "block"), ("ample", "block"), ("/zz/", "block")]), urls)
    assert {r["rule"]: r["token"] for r in index.collect()} == {"||example.net/de/": "de", "ample": "", "/zz/": "zz"}


def test_main_path_is_native(spark):
    plan = judge_pages(pages(spark, [(1, "http://net/")]))._jdf.queryExecution().toString()
    assert not re.search("Python|MapInArrow|MapInPandas|ArrowEval|CartesianProduct|BroadcastNestedLoop", plan)


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    name = "op13_url_filters"
    assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) is None
