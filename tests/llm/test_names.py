"""Input columns that are named like an operator's own helper columns pass through unchanged."""

import pytest

from pyspark.sql import functions as F

from residua.llm.bpe import BpeEncoder
from residua.llm.fim import FillInMiddle
from residua.llm.mixing import SourceMix
from residua.llm.ngram_join import NgramJoin
from residua.llm.pii import Pseudonyms
from residua.llm.quality import QualityRules
from residua.llm.queries import word_bpe_path
from residua.llm.toxicity import Toxicity

NAMES = [
    "_text", "_toxic", "_trusted", "_id", "_d", "_s", "_z", "_m", "_n", "_take", "_copy", "_size", "_hash", "_body", "_mask", "_gone", "_lines", "_kept", "_new", "_key",
    "row", "given", "ids ", "body", "id", "d", "s", "z", "m", "from", "copies", "take", "copy", "size", "component", "class", "best", "best_id", "token", "text ",
]


def rules(spark, docs):
    return QualityRules().fit(docs, docs.select("doc_id").limit(2)).score(docs)


def toxic(spark, docs):
    labels = docs.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")).distinct()
    return Toxicity().fit(docs, labels).score(docs)


RUNS = {
    "op1": rules,
    "op2": lambda spark, docs: SourceMix().apply(docs),
    "op3": toxic,
    "op4": lambda spark, docs: Pseudonyms().apply(docs),
    "op5": lambda spark, docs: BpeEncoder(word_bpe_path()).encode(docs),
    "op7": lambda spark, docs: NgramJoin(n=5, percent=80).distinct(docs),
    "op11": lambda spark, docs: FillInMiddle().apply(docs),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_helper_names_pass_through(spark, documents, name):
    docs = documents.withColumns({n: F.lit(n) for n in NAMES})
    out = RUNS[name](spark, docs)
    assert set(out.columns) >= set(docs.columns)
    rows = out.collect()
    assert rows and all(r[n] == n for r in rows for n in NAMES)
    if name not in ("op2", "op4", "op7"):
        assert sorted((str(r["doc_id"]), str(r["text"])) for r in rows) == sorted((str(r["doc_id"]), str(r["text"])) for r in documents.collect())
