import math
import random
import re

import pytest

from residua.llm import language
from residua.llm.language import LanguageEvidence
from residua.llm.quality import gram_ids

WORDS = {"en": "the house and river with some green water under trees".split(), "de": "der garten und straße mit einer grünen tür über bäume".split(), "fr": "le jardin et forêt avec une verte porte déjà où".split()}


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    rows = [(sentence(rng, lang, 40), lang) for lang in WORDS for _ in range(40)] + [(None, "en"), ("", "de"), ("the", None)]
    return LanguageEvidence(bits=12).fit(spark.createDataFrame(rows, "text string, lang string"))


def page(lang, body):
    return f'<!DOCTYPE html><html lang="{lang}"><head><script>var the = 1</script></head><body><p>{body}</p></body></html>' if lang else f"<p>{body}</p>"


def test_evidence_is_fused(spark, model):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        lang = ("en", "de", "fr")[i % 3]
        host = {"en": "a.example.com", "de": f"h{i % 5}.beispiel.de", "fr": "exemple.fr"}[lang]
        rows.append((i, f"https://{host}/x/{i}", page(lang, sentence(rng, lang, 25))))
    rows += [
        (1000, "https://h1.beispiel.de/", "<p></p>"),  # nothing but the host
        (1001, "http://exemple.fr", page("fr", "")),
        (1002, None, None),
        (1003, "not an address", page("de", sentence(rng, "de", 30))),
        (1004, "https://exemple.fr/", page("fr", sentence(rng, "de", 60))),  # the text wins over what is declared
    ]
    got = {r["page_id"]: r for r in model.identify(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, lang string")).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["lang"] == ("en", "de", "fr")[i % 3] and 0 < got[i]["probability"] <= 1 for i in range(300))
    assert got[1000]["lang"] == "de" and got[1001]["lang"] == "fr" and got[1003]["lang"] == "de" and got[1004]["lang"] == "de"
    assert got[1002]["lang"] in WORDS and got[1002]["host"] is None
    assert sum(r["lang"] is not None for r in got.values()) == len(rows)


def test_priors_by_hand(spark, model):
    """A page without text, markup or suffix of its own is judged by its host's smoothed share."""
    rng = random.Random(5)
    rows = [(i, "http://mixed.site.org/", page(None, sentence(rng, "fr" if i < 8 else "en", 30))) for i in range(10)]
    rows += [(99, "http://mixed.site.org/empty", None)]
    got = {r["page_id"]: r for r in model.identify(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0]["lang"] == "fr" and got[9]["lang"] == "en"
    guess = [got[i]["text_lang"] for i in range(10)] + [got[99]["text_lang"]]
    names = sorted(WORDS)
    n = [guess.count(x) for x in names]
    world = [(c + 1) / (sum(n) + 3) for c in n]
    domain = [(c + 5 * w) / (sum(n) + 5) for c, w in zip(n, world, strict=True)]
    host = [(c + 5 * w) / (sum(n) + 5) for c, w in zip(n, domain, strict=True)]
    suffix = [(c + 1) / (c + 1) for c in n]
    weight = [h * s for h, s in zip(host, suffix, strict=True)]
    best = max(range(3), key=lambda k: weight[k])
    assert got[99]["lang"] == names[best] and got[99]["probability"] == pytest.approx(weight[best] / sum(weight))


def plain(text):
    """Visible text by plain rules, for pages as ``page`` makes them."""
    return " ".join(re.sub(r"<[^>]*>", " ", re.sub(r"<script>.*?</script>", " ", text or "")).split())


def test_fused_scores_by_hand(spark, model):
    """Every page recomputed: likelihoods gram by gram, witnesses and smoothed priors from the other pages' guesses."""
    rng = random.Random(11)
    rows = []
    for i in range(60):
        lang = rng.choice(["en", "de", "fr"])
        host = rng.choice(["a.example.com", "b.example.com", "c.beispiel.de", "exemple.fr", f"only{i}.net"])
        body = sentence(rng, rng.choice([lang, "en"]), rng.choice([0, 1, 2, 3, 30]))
        rows.append((i, f"https://{host}/{i}", page(rng.choice([lang, None, "de"]), body)))
    rows += [(90, None, None), (91, "nowhere", page("xx", "le jardin")), (92, "http://exemple.fr", "")]
    names, weights, size = model.names, [w for part in model.parts for w in part.value], 1 << 12
    pages = {}
    for i, url, text in rows:
        shown = plain(text).encode()
        ids = gram_ids([shown], 3, size)[0]
        ids = [b for b in ids if b < size]
        logs = [sum(w[b] for b in ids) / max(len(shown), 1) * min(len(shown), 100) for w in weights]
        host = re.match(r"https?://([^/]+\.[^/]+)", url or "")
        host = host and host[1]
        lang = re.search(r'lang="(\w+)"', text or "")
        guess = max(range(3), key=lambda k: (logs[k], -k)) if shown else None
        pages[i] = {"logs": logs, "guess": guess, "host": host, "domain": host and ".".join(host.split(".")[-2:]), "suffix": host and host.split(".")[-1], "declared": lang and lang[1]}
    got = {r["page_id"]: r for r in model.identify(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, p in pages.items():
        count = lambda level: [sum(o["guess"] == k and (level is None or o[level] == p[level]) for j, o in pages.items() if j != i) for k in range(3)]  # noqa: B023, E731
        everywhere = count(None)
        prior = [(n + 1) / (sum(everywhere) + 3) for n in everywhere]
        for level in ("domain", "host"):
            if p[level]:
                own = count(level)
                prior = [(n + 5 * w) / (sum(own) + 5) for n, w in zip(own, prior, strict=True)]
        sums = [a + math.log(b) for a, b in zip(p["logs"], prior, strict=True)]
        for level in ("declared", "suffix"):
            known = {o[level] for o in pages.values()} - {None}
            if p[level] and any(o[level] == p[level] and o["guess"] is not None for o in pages.values()):
                sums = [s + math.log((n + 1) / (m + len(known))) for s, n, m in zip(sums, count(level), everywhere, strict=True)]
        best = max(range(3), key=lambda k: sums[k])
        assert got[i]["lang"] == names[best], i
        assert got[i]["probability"] == pytest.approx(1 / sum(math.exp(s - max(sums)) for s in sums)), i
        assert got[i]["text_lang"] == (None if p["guess"] is None else names[p["guess"]]), i


def test_visible_text():
    assert language.visible(b"<p>caf&eacute;&nbsp;&#233; &lt;b&gt;</p><!-- x --> y &unknown; &#xD800;") == "café é <b> y &unknown; \ufffd".encode()
    assert language.visible(b"<script>var a = 1</script>  a\n b") == b"a b"


def test_every_label_can_be_a_result(spark):
    """Seventy languages, the last ones the rarest: all are found, and their witnesses are counted as theirs."""
    rng = random.Random(7)
    names = [f"l{k:02d}" for k in range(70)]
    words = {n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(12)] for n in names}
    text = lambda n: " ".join(rng.choice(words[n]) for _ in range(30))
    docs = spark.createDataFrame([(text(n), n) for k, n in enumerate(names) for _ in range(4 if k < 64 else 3)], "text string, lang string")
    pages = spark.createDataFrame([(k, f"http://h{k}.example.t{k}/", f"<p>{text(n)}</p>") for k, n in enumerate(names)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["lang"], r["text_lang"]) for r in LanguageEvidence().fit(docs).identify(pages).collect()}
    assert got == {k: (n, n) for k, n in enumerate(names)}


def test_parts_of_the_languages_make_no_difference(spark, monkeypatch):
    rng = random.Random(8)
    docs = spark.createDataFrame([(sentence(rng, lang, 40), lang) for lang in WORDS for _ in range(9)], "text string, lang string")
    rows = [(i, f"http://h{i % 4}.site.org/", page(None, sentence(rng, ("en", "de", "fr")[i % 3], 20))) for i in range(30)]
    pages = spark.createDataFrame([*rows, (99, "http://h1.site.org", None)], "page_id long, url string, html string")
    whole = sorted(LanguageEvidence().fit(docs).identify(pages).collect())
    monkeypatch.setattr(language, "PART", 1)
    model = LanguageEvidence().fit(docs)
    assert len(model.parts) == 3 and sorted(model.identify(pages).collect()) == whole


def test_empty_tables(spark, model):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert model.identify(none).count() == 0
    untrained = LanguageEvidence().fit(spark.createDataFrame([], "text string, lang string"))
    some = spark.createDataFrame([(1, "http://a.example.com", page("en", "the house"))], "page_id long, url string, html string")
    assert [(r["page_id"], r["lang"], r["declared"]) for r in untrained.identify(some).collect()] == [(1, None, "en")]
