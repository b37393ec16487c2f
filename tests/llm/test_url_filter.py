import random
import re
import string

import numpy as np
import pytest

from residua.llm import url_filter
from residua.llm.url_filter import Digests, UrlFilter, pack

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"), ("a.example.com/de/x", "allow"), ("xn--é.net/ü", "block"), ("com/d", "allow")]
WORDS = [("casino", "block"), ("news", "allow"), ("pills", "block")]


def by_hand(url, rules=RULES, words=WORDS):
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        own = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(own) :]).group()
        host = own.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    fitting = []
    for rule, verdict in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fitting.append((len(rule), len(h), rule, verdict))
    if fitting:
        *_, rule, verdict = max(fitting)
        return host, path, rule, None, verdict
    blocked = sorted(set(re.split(r"[.-]", host)) & {w for w, v in words if v == "block"})
    return host, path, None, blocked[0] if blocked else None, "block" if blocked else "allow"


def urls():
    rng = random.Random(5)
    hosts = ["example.org", "EXAMPLE.org", "a.example.com", "b.a.example.com", "notexample.org", "org", "com", "casino-win.net", "the.pills.info", "news-casino.net", "news.net", "xn--é.net", "x.XN--é.net", "example.org:80", "example.org.", "İ.com", "", "pills"]
    paths = ["", "/", "/es", "/es/", "/es/1", "/en/1", "/en/12/x", "/en/2", "/de/x/y", "/de/", "/d", "/fr/9", "/FR/9", "/ü/1", "//", "/en//1"]
    tails = ["", "?q=/es/", "#top", "?a#b://c", "\n"]
    made = [f"{rng.choice(['http', 'https', 'HTTP', ''])}://{h}{p}{rng.choice(tails)}" for h in hosts for p in paths]
    made += [None, "", "example.org/es/1", "http:/example.org/es/", "mailto:x@example.org", "a://b://example.org/es/", "http://" + "a." * 3000 + "example.org/es/" + "z" * 20000]
    return [*made, *made[:7]]


@pytest.mark.parametrize("limit, probes", [(64_000_000, 4_000_000), (60, 4_000_000), (100, 20)])
def test_by_hand(spark, monkeypatch, limit, probes):
    """One broadcast image, several images, several images with several copies."""
    monkeypatch.setattr(url_filter, "PROBES", probes)
    entries = spark.createDataFrame([*RULES, *WORDS, RULES[0], (None, "block"), ("", "block"), ("pills", "allow"), ("news", None)], "entry string, verdict string")
    rows = [(i % 50, u, "x", "y", 3) for i, u in enumerate(urls())]
    pages = spark.createDataFrame(rows, "page_id long, url string, `row` string, Path string, entry int")
    made = UrlFilter(limit=limit).build(entries)
    assert (made.parts > 1) == (limit < 1000)
    out = made.judge(pages)
    assert out.columns == ["page_id", "url", "row", "entry", "host", "path", "rule", "word", "verdict"]
    words = [("casino", "block"), ("news", "block"), ("pills", "block")]
    wanted = [(i, u, "x", 3, *by_hand(u, words=words)) for i, u, *_ in rows]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("limit", [64_000_000, 10])
def test_empty(spark, limit):
    entries = spark.createDataFrame([*RULES], "entry string, verdict string")
    pages = spark.createDataFrame([(1, "http://example.org/es/")], "page_id long, url string")
    assert UrlFilter(limit=limit).build(entries).judge(pages.where("false")).count() == 0
    assert [tuple(r) for r in UrlFilter(limit=limit, default="block").build(entries.where("false")).judge(pages).select("rule", "word", "verdict").collect()] == [(None, None, "block")]


def test_colliding_digests(monkeypatch):
    """All strings share one of three digests: only the stored string decides."""
    monkeypatch.setattr(url_filter, "xxh64", lambda strings: np.array([len(s) % 3 for s in strings], np.uint64))
    words = [f"w{i}" for i in range(50)] + ["ü" * k for k in range(1, 9)]
    inside = words[::2]
    digests = Digests(pack([w.encode() for w in inside], [len(w) % 2 == 0 for w in inside]))
    assert digests.verdicts([*words, "", *words]) == {w: len(w) % 2 == 0 for w in inside}
    assert Digests(pack([], [])).verdicts(words) == {}
