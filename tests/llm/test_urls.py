from __future__ import annotations

import pytest

from tidemark.llm import urls

RULES = [*urls.SITE_RULES, *(urls.word_rule("block", w) for w in urls.SPAM_WORDS)]


def brute(url):
    _, mark, rest = (url or "").partition("://")
    rest = rest.split("?")[0].split("#")[0] if mark else ""
    host, slash, path = rest.partition("/")
    host, path = "".join(c.lower() if c.isascii() else c for c in host), slash + path
    fits = [
        (len(site), verdict, site)
        for verdict, site in [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
        if ("." + host).endswith("." + site.partition("/")[0]) and path.startswith("/" + site.partition("/")[2])
    ]
    if fits:
        return host, path, max(fits)[2], max(fits)[1]
    return host, path, None, "block" if set(host.replace("-", ".").split(".")) & set(urls.SPAM_WORDS) else "allow"


CASES = [
    None, "", "no scheme", "http://", "http://COM/", "http://com", "http://com?x", "https://a.example.com/en/1?q#f", "https://www.example.com/en/", "https://x.www.example.com/en/2",
    "https://www.example.com/EN/", "http://notexample.com/en/", "http://example.com.net/es/x", "http://net/fr/", "http://x.net/fr", "http://é.NET/es/ü", "http://casino-win.example.org/en/1",
    "http://casinowin.org/", "http://spam.org", "http://user@spam.org:80/x", "http://a/b://c", "http://.com/", "http://x.com\n/y", "https://m.example.net/en/#top",
]


def test_cases_match_brute_force(spark):
    df = spark.createDataFrame([(i % 7, u, "clash") for i, u in enumerate(CASES * 2)], "page_id int, url string, host string")
    rows = urls.judge_urls(df, RULES).collect()
    assert len(rows) == 2 * len(CASES)
    for row in rows:
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == brute(row["url"]), row["url"]


def test_rules_are_filed_under_their_rarest_token():
    index, always = urls.index_rules([urls.host_rule("block", "example.com/en/"), urls.host_rule("block", "é/")], {"example": 3, "com": 9, "en": 1})
    assert set(index) == {"en"} and [r.name for r in always] == ["é/"]


def test_only_candidates_run(spark, monkeypatch):
    rule = urls.host_rule("block", "shop.example/x")
    assert rule.tokens == ("shop", "example")  # a token the path may continue is no whole token
    got = urls.judge_urls(spark.createDataFrame([("http://shop.example/xyz",)], "url string"), [rule]).first()
    assert got["verdict"] == "block"


def test_empty_inputs(spark):
    assert urls.judge_urls(spark.createDataFrame([], "url string"), RULES).collect() == []
    assert urls.judge_urls(spark.createDataFrame([("http://a.b/",)], "url string"), []).first()["verdict"] == "allow"


def test_rule_lists_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_RULES", 3)
    with pytest.raises(ValueError):
        urls.judge_urls(spark.createDataFrame([("x",)], "url string"), RULES)
