"""The URL filter against a brute-force version."""

import random
from collections import Counter

import pytest

from assayflow.llm import url_filters

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    rest = rest[cut:]
    return host, rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]


def slow(url, rules, default="allow"):
    host, path = parse(url)
    best = None
    for h, p, v in rules:
        if not h or v is None:
            continue
        h, p = h.lower(), p or ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0, 0, "", ""), (len(h) + len(p), len(h), h + p, v))
    return (host, path, best[2], best[3]) if best else (host, path, None, default)


def check(spark, urls, rules, default="allow"):
    pages = spark.createDataFrame([(i if i % 50 else None, u, "x", i) for i, u in enumerate(urls)], "page_id long, url string, found string, part int").repartition(3)
    got = url_filters.judge(pages, url_filters.rule_table(spark, rules), default=default)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = Counter((i if i % 50 else None, *slow(u, rules, default)) for i, u in enumerate(urls))
    assert Counter(tuple(r) for r in got.collect()) == want


EDGES = [
    None, "", "no scheme", "http://", "http:///x", "HTTP://WWW.Example.NET/en/1", "http://example.net/EN/1", "http://net", "http://net/",
    "http://net?x=/", "http://internet/en/", "http://a.b.example.net/en/?q#f", "http://example.net:80/en/", "x://y://net/", "http://net./",
    "http://.net/", "http://..net/a", "http://a..b.org/fr/", "http://org/fr", "http://örg.org/fr/é", "http://ÄB.ORG/fr/",
]


@pytest.mark.parametrize("sample", [16, 1])
def test_rules_against_brute_force(spark, monkeypatch, sample):
    monkeypatch.setattr(url_filters, "SAMPLE", sample)
    random.seed(5)
    hosts = ["net", "example.net", "www.example.net", "example.com", "m.example.com", "blog.x.org", "org", "other.test"]
    paths = ["", "/", "/en/", "/en/a", "/en", "/de/", "/de/x.html", "/fr/", "/fr/y/z", "/EN/"]
    urls = EDGES + [f"{random.choice(['http', 'https'])}://{random.choice(hosts)}{random.choice(paths)}{random.choice(['', '?p=1', '#top'])}" for _ in range(400)]
    urls += ["https://www.example.net/en/hot"] * 300
    check(spark, urls, RULES)
    nested = RULES + [("example.net", "/en/a", "block"), ("www.example.net", "/", "allow"), ("net", "/en/a/b/c/d", "allow"), ("org", "/fr/", "block")]
    nested += [("WWW.example.net", "/en/h", "block"), ("x.org", None, "block"), (None, "/", "block"), ("", "/", "block"), ("com", "/", None), ("b.org", "", "allow")]
    check(spark, urls, nested, default="block")


def test_many_nested_rules_and_clipped_keys(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "CLIP", 4)
    random.seed(6)
    words = ["a", "b", "ab", "aa"]

    def some(k):
        return "".join("/" + random.choice(words) for _ in range(random.randrange(k)))

    rules = list({(h, p): (h, p, random.choice(["allow", "block"])) for h, p in ((random.choice(["t", "a.t", "b.a.t", "u"]), some(5)) for _ in range(80))}.values())
    urls = [f"h://{random.choice(['t', 'a.t', 'x.a.t', 'c.b.a.t', 'at', 'u'])}{some(7)}" for _ in range(500)] + ["h://a.t" + "/ab" * 20_000, "h://" + "q." * 400 + "a.t/a"]
    check(spark, urls, rules)


def test_empty_tables(spark):
    check(spark, EDGES, [])
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filters.judge(pages, url_filters.rule_table(spark, RULES)).count() == 0
