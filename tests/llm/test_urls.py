from collections import Counter

import pytest

from hirelake.llm import queries, url_filter

URLS = [
    None, "", "no scheme", "://", "http://", "http://net", "http://NET/", "http://net?x=/", "http://a.b.net/x", "http://anet/", "ftp://example.net/en/1",
    "http://www.example.net/en", "http://www.example.net/en/", "http://example.net/EN/", "https://x.org/fr/?q#a", "https://org/fr/", "https://org/fr",
    "http://u@h://net/", "http://example.com/de/x\ny", "http://a.example.com/de/", "http://example.com./de/", "x y://É.org/fr/é", "http://ÀB.net/a#://", "http://..net/",
    "http://net/" + "a" * 5000, "http://" + "a." * 3000 + "net/",
]


def plain(url, rules, otherwise="allow"):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    host = ""
    for c in rest:
        if c in "/?#":
            break
        host += c.lower() if c.isascii() else c
    path = rest[len(host) :].split("?")[0].split("#")[0]
    best = None
    for rule in rules:
        at = rule.find("/") if "/" in rule else len(rule)
        if rule and (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]):
            best = rule if best is None or len(rule) > len(best) else best
    return host, path, best, rules[best] if best else otherwise


MORE = {"": "block", "b.net/x": "allow", "net": "block", "example.com/d": "allow", "a.example.com/de/": "allow"}


@pytest.mark.parametrize("rules", [queries.RULES, {}, {**queries.RULES, **MORE}, {**{f"h{i}.net/p{i}": "block" for i in range(3000)}, **queries.RULES}])
@pytest.mark.parametrize("whole", [True, False])
def test_judge(spark, monkeypatch, rules, whole):
    if not whole:
        monkeypatch.setattr(url_filter, "SENT_WHOLE", -1)
    rows = [(i, u, "h", "k", 1) for i, u in enumerate(URLS)] + [(3, "http://net/", "h", "k", 2)] * 3 + [(None, "http://h7.net/p7", "", "", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, key string, copies long")
    listed = spark.createDataFrame(list(rules.items()), "rule string, verdict string")
    out = url_filter.judge(pages, listed).collect()
    assert Counter(map(tuple, out)) == Counter((r[0], *plain(r[1], rules)) for r in rows)


def test_two_verdicts_and_no_pages(spark):
    listed = spark.createDataFrame([("net/", "allow"), ("net/", "block"), (None, "block")], "rule string, verdict string")
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    assert url_filter.judge(pages, listed).first()["verdict"] == "block"
    assert url_filter.judge(pages.limit(0), listed).count() == 0


def test_no_python_in_the_plan(spark):
    df = queries.QUERIES["op2_url_filter"](spark, "/root/testdata/sf0.001")
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().executedPlan().toString()
