"""Verdicts against plain Python; the cascade is exact."""

import re

from saleslake.llm import urls
from saleslake.llm.common import QUERIES, table


def plain(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    listed = bool(set(re.split("[.-]", host)) & set(urls.LISTED_WORDS))
    return host, path, None, "block" if listed else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org/es/1", "https://a.example.org/en/12?x#y", "https://a.example.org/en/2",
    "http://x.com/de/", "http://x.com/fr/a", "http://x.com?de/", "http://spam-farm.net/a", "http://a.net/spam", "a://b://c/d",
    "http://xexample.org/es/", "http://Ä.net/É", "http://a.net\n/x",
]


def test_verdicts_and_odd_rows(spark):
    rows = [(i, u, "old") for i, u in enumerate(URLS)] + [(0, None, "old"), (None, "http://pills.net/", "old")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    listed = urls.hosts_with_words(pages, urls.LISTED_WORDS)
    got = urls.judged(pages, listed, urls.RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain(r.url), r.url
    assert urls.judged(pages.limit(0), listed, urls.RULES).count() == 0
    assert {r.verdict for r in urls.judged(pages, listed.limit(0), []).collect()} == {"allow"}


def test_cascade_is_exact_over_shards(spark):
    keys = spark.range(3000).selectExpr("concat('host', id) as host")
    listed = spark.range(0, 3000, 7).selectExpr("concat('host', id) as host")
    for shard_keys in (10_000, 200):
        got = urls.listed_by_cascade(keys.union(keys), listed, "host", shard_keys).collect()
        assert len(got) == 6000
        assert all(r.listed == (int(r.host[4:]) % 7 == 0) for r in got)


def test_query_equals_plain(spark, tables):
    by_id = {r.page_id: r.url for r in table(spark, tables, "pages").collect()}
    rows = QUERIES["op6_url_cascade"](spark, tables).collect()
    assert len(rows) == len(by_id)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == plain(by_id[r.page_id])
