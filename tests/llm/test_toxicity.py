import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from residua.llm.toxicity import Scanner, Toxicity, stems


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet="abc", min_size=1, max_size=9), min_size=1, max_size=5, unique=True), st.lists(st.booleans(), min_size=5, max_size=5), st.text(alphabet="abcd", max_size=12))
def test_automaton_by_brute_force(entries, whole, word):
    lexicon = [e + "$" * w for e, w in zip(entries, whole, strict=False)]
    best = 99
    for e in lexicon:
        letters = e.rstrip("$")
        allowed = 0 if len(letters) < 5 else 1 if len(letters) < 8 else 2
        beginnings = [word] if e.endswith("$") else [word[:k] for k in range(1, len(word) + 1)]
        best = min([best] + [d for b in beginnings if (d := distance(letters, b)) <= allowed])
    assert Scanner(lexicon, 5).word(word) == (0 if best == 99 else 1 if best == 0 else 2)


def test_stems_find_words_and_beginnings():
    counts = {"idi": 30, "idio": 30, "idiot": 30, "idiot$": 30, "lowe": 20, "lowei": 20, "loweia": 5, "loweia$": 5, "loweib": 6, "loweib$": 6}
    assert set(stems(counts, 10)) == {"idiot$", "lowei"}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    words = ["tree", "house", "river", "cloud", "walk", "green", "table", "window", "paper", "stone"]
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randint(5, 40))]
        kind = i % 4
        if kind == 0:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["blockhead", "nitwit", "grobia" + rng.choice("nsz")]))
        elif kind == 1:
            text.insert(rng.randrange(len(text)), '"blockhead"')
            text.insert(0, "wrote:") if i % 8 else None
        rows.append((i, " ".join(text)))
        labels.append((i, int(kind == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy_quotation_and_misspelling(spark, labelled):
    docs, labels, truth = labelled
    model = Toxicity(purity=0.6).fit(docs, labels.where("doc_id % 5 != 0"))
    out = model.score(docs).where("doc_id % 5 = 0").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in out) >= 0.95 * len(out)
    probe = spark.createDataFrame([(1, "you are a blockhed and a nitwiit, blockhead"), (2, "green tree"), (3, 'he wrote: "blockhead" on paper')], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in model.score(probe).collect()}
    assert got[1] >= 0.5 > got[2] and got[3] < 0.5


def test_edges(spark, documents, empty, labelled):
    docs, labels, _ = labelled
    model = Toxicity().fit(docs, labels)
    assert model.score(empty).count() == 0
    out = model.score(documents.selectExpr("*", "'x' as score")).collect()
    assert len(out) == documents.count()
    assert len({r["score"] for r in out if not (r["text"] or "").strip()}) == 1
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in Toxicity().fit(docs, none).score(docs).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1), (2, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    assert {r["score"] for r in Toxicity().fit(docs, one).score(docs).collect()} == {1.0}
