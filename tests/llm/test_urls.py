"""URL rules."""

import re

import numpy as np
import pytest

from tastemap.llm import urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("b.net", "/es/x", "allow"), ("NET", "/es/", "allow"),
         ("org", "", "block"), (None, "/", "block"), ("", "/", "block"), ("x", None, "block")]


def brute(url, rules):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = match.groups() if match else ("", "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for rule_host, rule_path, verdict in rules:
        if rule_host and rule_path is not None:
            rule_host = rule_host.lower()
            if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
                fits.append((len(rule_host + rule_path), len(rule_host), verdict,
                             rule_host + rule_path))
    best = max(fits, default=(0, 0, "allow", None))
    return host, path, best[3], best[2]


URLS = ["http://www.Example.com/en/a?b#c", "https://example.com/en/", "http://a.example.com/en/x",
        "http://example.com", "http://example.com?/en/", "a://b://c.com/", "net/es/", "x://net/es/",
        "x://a.b.net/es/xyz", "x://anet/es/", "x://.net/es/", "x://net./es/", "x://org:80/", None, "",
        "://", "x:///en/", "x://ÉX.com/É", "x://user@w.org/#", "x://a.org/\n?", "x://com/a\nb",
        "x://" + "a." * 3000 + "net/es/" + "p" * 20_000]


@pytest.mark.parametrize("rules", [RULES, RULES[:1], []])
def test_rules_against_brute_force(spark, rules):
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    # Ids repeat, and a column has the name of one of the operator's.
    pages = spark.createDataFrame([(i // 2, url, "x") for i, url in enumerate(URLS)] + [(None, None, None)],
                                  "page_id long, url string, host string")
    got = urls.judge_urls(pages, listed).collect()
    expected = [(i // 2, *brute(url, rules)) for i, url in enumerate(URLS)]
    expected.append((None, *brute(None, rules)))
    order = [str(tuple(r)) for r in got]
    assert sorted(order) == sorted(str(e) for e in expected)


def test_no_pages(spark):
    listed = spark.createDataFrame(RULES, "host string, path string, verdict string")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(empty, listed).count() == 0


def test_the_filter_misses_no_key_and_passes_few_others(spark):
    keys = spark.range(20_000).selectExpr("xxhash64(id) AS key")
    bloom = urls.build_filter(keys)
    there = np.array([r.key for r in keys.collect()], np.int64)
    others = np.array([r.key for r in spark.range(20_000, 60_000).selectExpr("xxhash64(id) AS key")
                      .collect()], np.int64)
    assert urls.may_contain(bloom, there).all()
    assert urls.may_contain(bloom, others).mean() < 0.001


def test_a_full_filter_changes_no_verdict(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_BYTES", 64)
    hosts = [(f"h{i}.com", "/", "block") for i in range(500)]
    listed = spark.createDataFrame(hosts, "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, f"http://h{i}.com/") for i in range(0, 1000, 3)],
                                  "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge_urls(pages, listed).collect()}
    assert got == {i: "block" if i < 500 else "allow" for i in range(0, 1000, 3)}
