import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from residua.llm import common
from residua.llm.mixing import SourceMix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by resharing what exceeds the cap until nothing does."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        target = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        new = {s for s in free if target[s] > most * sizes[s]}
        if not new:
            return target | {s: most * sizes[s] for s in capped}
        capped |= new
        if len(capped) == len(order):
            return {s: most * sizes[s] for s in order}


def many(spark, n=4000):
    return spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.array_join(F.array_repeat(F.lit("w"), (F.pmod(F.xxhash64("id"), F.lit(200)) + 1).cast("int")), " ").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"),
    )


def test_targets_and_taken(spark):
    rows = SourceMix(block=8).plan(many(spark)).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    wanted = shares(sizes)
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]])
        ratio = r["target"] / r["source_size"]
        assert int(ratio) <= r["copies"] <= int(ratio) + 1 and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    for s, n in taken.items():
        assert abs(n - wanted[s]) <= 200  # one document's words


def test_copies_keep_their_expectation(spark):
    """Documents of every size are taken as often as their source's probability says."""
    docs = many(spark, 6000).withColumn("source", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"))
    rows = SourceMix(block=16).plan(docs).collect()
    for source in ("a", "b"):
        for low in range(0, 200, 40):
            own = [r for r in rows if r["source"] == source and low < r["size"] <= low + 40]
            ratio = own[0]["target"] / own[0]["source_size"]
            assert abs(sum(r["copies"] for r in own) / len(own) - ratio) < 4 * (0.25 / len(own)) ** 0.5


def test_awkward_rows(spark, documents, empty):
    assert SourceMix().plan(empty).count() == 0 and SourceMix().apply(empty).count() == 0
    given = documents.collect()
    rows = SourceMix(block=2).plan(documents.withColumn("size", F.lit("clash"))).collect()
    size = lambda t: len(WORD.findall(t or ""))
    key = lambda *x: tuple((v is None, v or 0 if not isinstance(v, str) else v) for v in x)
    assert sorted(key(r["doc_id"], r["source"], r["size"]) for r in rows) == sorted(key(r["doc_id"], r["source"], size(r["text"])) for r in given)
    sizes = Counter()
    for r in given:
        sizes[r["source"]] += size(r["text"])
    wanted = shares(sizes)
    assert all(r["target"] == pytest.approx(wanted[r["source"]]) for r in rows)


def test_apply_repeats_rows_as_planned(spark, documents):
    mix = SourceMix(block=2)
    plan = Counter()
    for r in mix.plan(documents).collect():
        plan[r["doc_id"], r["size"]] += r["copies"]
    out = mix.apply(documents)
    assert out.columns == documents.columns
    got = Counter((r["doc_id"], len(WORD.findall(r["text"] or ""))) for r in out.collect())
    assert got == +plan


def test_reruns_agree_whatever_the_partitions(spark):
    docs = many(spark, 1000)
    sort = lambda df: sorted(map(repr, df.collect()))
    assert sort(SourceMix().plan(docs)) == sort(SourceMix().plan(docs.repartition(13)))


def test_no_python_in_the_plan(spark, documents):
    mix = SourceMix()
    for df in (mix.plan(documents), mix.apply(documents)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_few_texts_travel_to_the_plan(spark, monkeypatch):
    """The bitmaps decide nearly all documents; where they decide none, the result is the same."""
    docs = many(spark).withColumn("source", F.coalesce("source", F.lit("none"))).unionByName(many(spark, 3))
    mix = SourceMix(block=8)
    plan = mix.plan(docs).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("m"))
    plan = plan.select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("z"), "copies", "m")
    sure, others = mix._told_apart(docs, plan)
    assert sure.count() + others.count() == docs.count() and others.count() < 100
    wanted = Counter(tuple(r) for r in mix.apply(docs).collect())
    monkeypatch.setattr(common, "FILTER_BITS", 7)
    sure, others = mix._told_apart(docs, plan)
    assert others.count() > 3000
    assert Counter(tuple(r) for r in mix.apply(docs).collect()) == wanted
