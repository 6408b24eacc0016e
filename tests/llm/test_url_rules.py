import pytest

from grainmill.llm.catalog import QUERIES, SQL, URL_RULES
from grainmill.llm.url_rules import BROADCAST_RULES, judge

import oracle


def plain(url, rules, default="allow"):
    before, mark, rest = (url or "").partition("://")
    if not mark:
        host = path = ""
    else:
        ends = [i for i in map(rest.find, "/?#") if i >= 0]
        cut = min(ends, default=len(rest))
        host, tail = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        stops = [i for i in map(tail.find, "?#") if i >= 0]
        path = tail[: min(stops, default=len(tail))]
    best = max(((len(h + p), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    return host, path, best[1] if best else None, best[2] if best else default


URLS = [
    None, "", "no scheme", "http://", "http:///x", "http://EXAMPLE.org/en/1?x", "https://a.example.ORG/en/12#t", "x://b.example.org/es/",
    "http://example.org/es", "http://notexample.org/es/", "ftp://m.com/fr/", "ftp://m.com/FR/", "a://com/de/x://org/", "a://com.", "b://.com/de/",
    "b://..org/", "http://x.com:80/de/", "http://u@x.com/de/9?q=/fr/", "http://x.com?/de/", "http://é.Üx.org/ä\nb", "http://a.b.c.d.e.f.org/" + "y" * 5000,
]


@pytest.mark.parametrize("limit", [BROADCAST_RULES, 0])
def test_rules_like_a_plain_loop(frame, spark, monkeypatch, limit):
    monkeypatch.setattr("grainmill.llm.url_rules.BROADCAST_RULES", limit)
    more = URL_RULES + [("allow", "x.com", "/de/9"), ("block", "é.Üx.org", "/ä"), ("allow", "", "/x")]
    rules = frame([*more, ("allow", "com", "/de/"), (None, "org", "/"), ("allow", None, "/"), ("other", "org", "/zz")], "action string, host string, path string")
    rows = [(i, u, "kept") for i, u in enumerate(URLS * 2)] + [(0, URLS[0], "kept")]
    got = judge(frame(rows, "page_id int, url string, rule string"), rules)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    want = sorted((i, u or "", *[x or "" for x in plain(u, more)]) for i, u, _ in rows)
    assert sorted((r[0], r[1] or "", *[x or "" for x in r[2:]]) for r in got.collect()) == want


def test_no_rules_and_no_pages(frame):
    schema = "action string, host string, path string"
    got = judge(frame([(1, "http://a.org/")], "page_id int, url string"), frame([], schema), default="block").collect()
    assert [tuple(r) for r in got] == [(1, "http://a.org/", "a.org", "/", None, "block")]
    assert judge(frame([], "page_id int, url string"), frame(URL_RULES, schema)).count() == 0


def test_clashing_columns(frame):
    pages = frame([(1, "http://a.org/", "x", 2, {"k": 1})], "page_id int, url string, action string, whole_url int, BEST_rule map<string,int>")
    got = judge(pages, frame(URL_RULES, "action string, host string, path string"))
    assert got.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    assert tuple(got.first()) == (1, "http://a.org/", "x", 2, {"k": 1}, "a.org", "/", "org/", "allow")


def test_query_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert oracle.compare(QUERIES["op5_url_rules"](spark, folder), oracle.connect(folder), SQL["op5_url_rules"]) == []
