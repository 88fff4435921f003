"""URL rules against a plain loop over all rules, mapped and joined."""

import random

import pytest

from matchwright.llm import url_filter
from matchwright.llm.queries import URL_RULES

PAGES = "page_id bigint, url string"


def plain(url, rules, otherwise="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]
    best = None
    for rule_host, rule_path, verdict in rules:
        if verdict in ("allow", "block") and (host == rule_host or host.endswith("." + rule_host)):
            if path.startswith(rule_path):
                rank = (len(rule_host + rule_path), len(rule_host.encode()), verdict)
                best = max(best, (rank, rule_host + rule_path)) if best else (rank, rule_host + rule_path)
    return host, path, best[1] if best else None, best[0][2] if best else otherwise


URLS = [
    None,
    "",
    "no scheme",
    "://",
    "http://",
    "HTTP://EXAMPLE.Org/es/x",
    "http://example.org",
    "http://example.org?x=/es/",
    "http://example.org#://a.org/es/",
    "http://badexample.org/es/1",
    "http://a.b.example.org/en/12/3",
    "http://example.org:80/es/",
    "http://org/",
    "http://.org/es/",
    "http://x.com/fr/1\n2?q",
    "http://É.COM/de/É",
    "ftp://x.com/de",
    "http://x.com/de/" + "y" * 200_000,
    "http://" + "a." * 20_000 + "com/de/",
    "a://b://c.org/x",
]


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, str(r)))


def wanted(rows, rules, otherwise="allow"):
    return sorted(
        ((k, *plain(u, rules, otherwise)) for k, u in rows), key=lambda r: (r[0] is None, r[0] or 0, str(r))
    )


@pytest.mark.parametrize("mapped_rules", [url_filter.MAPPED_RULES, 0])
def test_odd_urls(spark, mapped_rules):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, "http://example.org/es/"), (3, "http://example.org/es/"), (None, "x://a.com/de/")]
    pages = spark.createDataFrame([(k, u, "h", "p", "r") for k, u in rows], f"{PAGES}, host string, rule string, html string")
    rules = spark.createDataFrame(URL_RULES, url_filter.RULES)
    assert shown(url_filter.judge(pages, rules, mapped_rules=mapped_rules)) == wanted(rows, URL_RULES)


@pytest.mark.parametrize("bits", [64, 2])
@pytest.mark.parametrize("mapped_rules", [url_filter.MAPPED_RULES, 0])
def test_random_rules_also_when_digests_collide(spark, bits, mapped_rules):
    pick = random.Random(7)
    labels, parts = ["a", "b", "aa", "é", "org", "com"], ["/", "/a", "/a/", "/é", "/ab", ""]
    host = lambda: ".".join(pick.choices(labels, k=pick.randint(1, 4)))
    path = lambda: "".join(pick.choices(parts, k=pick.randint(0, 3)))
    rules = [(host(), path(), pick.choice(["allow", "block"])) for _ in range(150)]
    rows = [(i, f"http://{host()}/{path()}?{path()}") for i in range(600)]
    out = url_filter.judge(
        spark.createDataFrame(rows, PAGES),
        spark.createDataFrame(rules, url_filter.RULES),
        otherwise="block",
        bits=bits,
        mapped_rules=mapped_rules,
    )
    assert shown(out) == wanted(rows, rules, "block")


@pytest.mark.parametrize("mapped_rules", [url_filter.MAPPED_RULES, 0])
def test_no_rules_no_pages_and_rules_with_nulls(spark, mapped_rules):
    none, pages = spark.createDataFrame([], url_filter.RULES), spark.createDataFrame([(1, "http://a.org/x")], PAGES)
    odd = spark.createDataFrame(
        [(None, None, "block"), ("ORG", None, None), ("ORG", "/x", "block"), ("org", "/x", "allow"), ("a.org", "/", "other")],
        url_filter.RULES,
    )
    judge = lambda p, r: shown(url_filter.judge(p, r, mapped_rules=mapped_rules))
    assert judge(pages, none) == [(1, "a.org", "/x", None, "allow")]
    assert judge(spark.createDataFrame([], PAGES), odd) == []
    assert judge(pages, odd) == [(1, "a.org", "/x", "org/x", "block")]
    assert judge(spark.createDataFrame([(2, None)], PAGES), odd) == [(2, "", "", "", "block")]


def test_equal_lengths_are_decided_by_the_longer_host(spark):
    rules = [("b.org", "/", "allow"), ("org", "/x/", "block"), ("a.b.org", "", "block")]
    rules = [r for r in rules if len(r[0] + r[1]) <= 7]
    rows = [(1, "http://a.b.org/x/"), (2, "http://b.org/x/")]
    out = url_filter.judge(spark.createDataFrame(rows, PAGES), spark.createDataFrame(rules, url_filter.RULES))
    assert shown(out) == wanted(rows, rules)
