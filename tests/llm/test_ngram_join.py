import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from residua.llm import ngram_join
from residua.llm.components import components
from residua.llm.ngram_join import NgramJoin, PrefixTree


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, n, percent):
    """(key, size, component) of every row by comparing all rows."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return sorted(((k, len(s), least.get(root(i), k)) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def joined(spark, rows, **settings_):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in NgramJoin(**settings_).join(df).collect()), key=repr)


def corpus(seed, texts=120):
    """Copies and near copies of a few texts of many lengths, texts that share a passage, and short ones."""
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(3000)]
    passage = [rng.choice(words) for _ in range(60)]
    bases = [[rng.choice(words) for _ in range(rng.randint(3, 250))] for _ in range(8)]
    rows = []
    for i in range(texts):
        kind = rng.random()
        text = list(rng.choice(bases))
        if kind < 0.6:
            for _ in range(rng.randint(0, 1 + len(text) // 40)):
                text[rng.randrange(len(text))] = rng.choice(words)
        elif kind < 0.8:
            text = passage + [rng.choice(words) for _ in range(rng.randint(0, 40))]
        else:
            text = [rng.choice(words[:5]) for _ in range(rng.randint(0, 6))]
        rows.append((i, " ".join(text).upper() if rng.random() < 0.1 else " ".join(text)))
    return rows


@pytest.mark.parametrize("seed, n, percent, often", [(2, 3, 90, 3), (3, 5, 80, 4), (4, 2, 50, 2)])
def test_components_by_brute_force(spark, seed, n, percent, often):
    rows = corpus(seed)
    assert joined(spark, rows, n=n, percent=percent, often=often) == brute(rows, n, percent)


def test_awkward_rows(spark, documents, empty):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert joined(spark, rows) == brute(rows, 3, 90)
    assert NgramJoin().join(empty).count() == 0
    clash = documents.selectExpr("*", "1 as class", "2 as token", "3 as component_id")
    assert sorted((tuple(r) for r in NgramJoin().join(clash).collect()), key=repr) == brute(rows, 3, 90)


def test_one_group_of_near_copies(spark, monkeypatch):
    """A branch that holds most rows, dealt out in many chunks."""
    monkeypatch.setattr(ngram_join, "CHUNK", 7)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(200)] = f"c{i}-{rng.random()}"
        rows.append((i, " ".join(text)))
    assert joined(spark, rows) == brute(rows, 3, 90)


def test_distinct_keeps_one_row_of_each_component(spark, documents):
    out = NgramJoin().distinct(documents)
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    kept = {k for k, _, c in brute(rows, 3, 90) if k is not None and k == c}
    got = [r["doc_id"] for r in out.collect()]
    assert out.columns == documents.columns
    assert sorted(k for k in got if k is not None) == sorted(kept) and got.count(None) == 2


def test_distinct_with_repeated_and_missing_ids(spark):
    one, two, three = ("".join(f"{c}{k} " for k in range(30)) for c in "abc")
    rows = [(1, one), (1, two), (2, two), (None, one), (None, three), (None, three), (7, ""), (None, None), (None, None)]
    got = [tuple(r) for r in NgramJoin().distinct(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=repr) == sorted([(1, one), (1, two), (None, three), (7, ""), (None, None), (None, None)], key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40)), min_size=1, max_size=12), st.sets(st.integers(0, 40)), st.sampled_from([50, 80, 90, 100]))
def test_trie_by_brute_force(sets, probe, percent):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    found = PrefixTree(arrays).similar(np.array(sorted(probe), np.uint64), percent)
    assert sorted(found) == [i for i, s in enumerate(sets) if 100 * len(s & probe) >= percent * len(s | probe)]


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 4)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}


def test_only_linked_or_repeated_sets_are_looked_up(spark, monkeypatch):
    """Rows that stand alone do not repeat themselves once per salt in the last join."""
    rows = [(i, f"own{i} words{i} of{i} text{i}") for i in range(60)] + [(90, "own3 words3 of3 text3")]
    seen = []
    real = ngram_join.lookup_join
    monkeypatch.setattr(ngram_join, "lookup_join", lambda r, t, on, n, *a, **k: seen.append(n) or real(r, t, on, n, *a, **k))
    assert joined(spark, rows) == brute(rows, 3, 90)
    assert seen[-1] == 1


def test_frequent_ngrams_reach_the_driver_as_packed_numbers(spark, monkeypatch):
    """In order, with the logarithm of the count; no object per n-gram, and rarer n-grams still come first in a set."""
    (plain,) = ngram_join.ngram_sets([b"a b c d e f g h"], 3, None)
    counts = {int(t): c for t, c in zip(plain, (0, 2, 3, 4, 70_000, 1000), strict=True) if c}
    rows = spark.createDataFrame(list(counts.items()), "token long, count long").repartition(3)
    for packed in (2, 1 << 16):
        monkeypatch.setattr(ngram_join, "PACKED", packed)
        late = ngram_join.ranked(rows)
        assert [(int(x) >> 4, int(x) & 15) for x in late] == [(t, min(c.bit_length() - 1, 15)) for t, c in sorted(counts.items())]
    assert not len(ngram_join.ranked(rows.where("false")))
    (ordered,) = ngram_join.ngram_sets([b"a b c d e f g h"], 3, late)
    assert set((ordered & ngram_join.PLAIN).tolist()) == set(plain.tolist())
    assert [int(x) >> 60 for x in ordered] == [0, 1, 1, 2, 9, 15]
