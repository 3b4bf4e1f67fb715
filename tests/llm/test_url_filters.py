"""Url rules next to a plain loop over all rules."""

from pairloom.llm import url_filters

URLS = [
    None, "", "no scheme", "http://", "HTTP://Example.COM", "http://example.com/", "http://m.example.com/en/1?x=/es/", "http://www.example.com/en/1",
    "http://xexample.com/en/1", "http://a.net/es/1", "http://a.net/es", "http://net/fr/#a", "http://a.net?q", "http://a.NET/FR/", "x://y://z/en/",
    "http://com/a", "http://.com/", "http://a.com./en/", "ftp://ÄÖ.com/é", "http://" + "a." * 3000 + "com/" + "p/" * 3000, "http://example.com:80/en/",
    "http://a.com/b\nc#d", "http://a.com/b\nc#d",
]
RULES = [*url_filters.RULES, ("allow", "net", "/es/"), ("block", "a.com", "/b"), (None, "com", "/"), ("block", "", "/"), ("block", None, "/"),
         ("block", "com", None)]


def plain(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = max(((len(h + p), len(h), v, h + p) for v, h, p in rules if v and h and p is not None
                and (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_verdicts(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)] + [(None, None, None)], "page_id long, url string, rule string")
    got = url_filters.judge(pages, url_filters.rule_frame(spark, RULES)).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain(r.url, RULES), r.url
    kept = url_filters.keep_allowed(pages, url_filters.rule_frame(spark, RULES))
    assert kept.count() == sum(plain(u, RULES)[3] == "allow" for u in [*URLS, None])


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = url_filters.rule_frame(spark).limit(0)
    assert [r.verdict for r in url_filters.judge(pages, none).collect()] == ["allow"]
    assert url_filters.judge(pages.limit(0), url_filters.rule_frame(spark)).count() == 0


def test_match_is_confirmed_by_the_whole_digest(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "SHORT", 0)  # every expression meets every rule
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    for r in url_filters.judge(pages, url_filters.rule_frame(spark)).collect():
        assert (r.rule, r.verdict) == plain(r.url, url_filters.RULES)[2:]
