import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from residua.llm.quality import QualityRules, base_counts, gram_ids, log_ratio

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines, seen, repeats = text.split("\n"), set(), 0
    for line in lines:
        repeats += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeats, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab é#|\n\t\x0b\x85　日", max_size=40), min_size=1, max_size=6))
def test_base_counts_by_hand(texts):
    counts = base_counts([t.encode() for t in texts])
    got = list(zip(*[counts[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], strict=True))
    assert got == [plain_counts(t) for t in texts]


def brute_score(text, grams, weights, size):
    ids = gram_ids([text.encode()], grams, size)[0]
    own = [round(weights[i] * 2**24) / 2**24 for i in ids if i < size]
    return sum(own) / len(own) if own else 0.0


def test_scores_by_hand(spark, documents):
    rules = QualityRules(bits=10, min_words=2, threshold=-0.01)
    trusted = spark.createDataFrame([(5,), (5,), (8,), (None,), (99,)], "doc_id long")
    rows = documents.collect()
    size = 1 << 10
    raw, target = np.zeros(size), np.zeros(size)
    for r in rows:
        data = (r["text"] or "").encode()
        grams = [data[i : i + 4].ljust(4, b"\0") for i in range(len(data))]
        for g in grams:
            value = 0
            for b in g:
                value = (value * 257 + b) % (1 << 64)
            bucket = (value * 0x9E3779B97F4A7C15 % (1 << 64)) >> 54
            raw[bucket] += 1
            target[bucket] += r["doc_id"] in (5, 8)
    model = rules.fit(documents, trusted)
    weights = log_ratio(raw, target, 1.0)
    assert np.allclose(model.weights, weights)
    got = model.score(documents).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")
    for r, g in zip(sorted(rows, key=key), sorted(got, key=key), strict=True):
        text = r["text"] or ""
        n, chars, symbols, lines, repeated = plain_counts(text)
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == (n, chars, symbols, lines, repeated)
        failed = n < 2 or 100 * repeated > 50 * n
        score = brute_score(text, 4, weights, size)
        assert g["base_failed"] == failed and math.isclose(g["score"], score, abs_tol=1e-9)
        assert g["kept"] == (not failed and score >= -0.01)


def test_edges(spark, documents, empty):
    nobody = spark.createDataFrame([], "doc_id long")
    assert QualityRules(bits=8).fit(empty, nobody).score(empty).count() == 0
    model = QualityRules(bits=8).fit(documents, nobody)
    assert {r["score"] for r in model.score(documents).select("score").collect()} == {0.0}
    clash = documents.selectExpr("*", "'x' as kept", "1 as score", "2 as _trusted")
    out = model.score(clash)
    assert out.count() == documents.count() and dict(out.dtypes)["kept"] == "boolean" and "_trusted" in out.columns


def test_verdicts_do_not_depend_on_partitions(spark, documents):
    trusted = documents.where("doc_id < 9").select("doc_id")
    one = QualityRules().fit(documents.repartition(1), trusted).score(documents)
    many = QualityRules().fit(documents.repartition(7), trusted).score(documents.repartition(5))
    sort = lambda df: sorted(map(repr, df.select("doc_id", "score", "kept").collect()))
    assert sort(one) == sort(many)


def test_many_trusted_names_count_alike(spark, documents, monkeypatch):
    """Beyond what is broadcast: repeated ids, null ids and names of another type give the same counts."""
    trusted = spark.createDataFrame([("5",), ("5",), ("8",), (None,), ("none",), ("99",)], "doc_id string")
    few = QualityRules(bits=10).fit(documents, trusted)
    monkeypatch.setattr("residua.llm.quality.BROADCAST_ROWS", 1)
    many = QualityRules(bits=10).fit(documents, trusted)
    assert (few.weights == many.weights).all() and few.weights.any()
    numbers = QualityRules(bits=10).fit(documents, spark.createDataFrame([(5,), (8,)], "doc_id int"))
    assert (few.weights == numbers.weights).all()
