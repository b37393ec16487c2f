import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from residua.llm import fim
from residua.llm.fim import FillInMiddle, line_ends

UNITS = re.compile(r"[^\n]*\n|[^\n]+")


def by_hand(key, text, rate=100, spm=50, seed=7):
    """(n, form, prefix_chars, middle_chars, output), unit by unit."""
    text = text or ""
    units = UNITS.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


texts = st.lists(st.sampled_from(["a", "é𝄞", "\n", "\n\n", "<", "P>", "<S", "M>", ">", "<P", "\r", "\x00", " "]), max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(texts, st.integers(-3, 10**12), st.sampled_from([(100, 50), (40, 0), (100, 100), (0, 50)]), st.sampled_from([2, 500_000]))
def test_by_hand(text, key, rates, lines):
    rate, spm = rates
    before, fim.LINES = fim.LINES, lines
    try:
        maker = FillInMiddle(rate=rate, spm=spm)
        cut = maker.cut(text, str(key))
    finally:
        fim.LINES = before
    assert (cut.n, cut.form, cut.prefix_chars, cut.middle_chars, cut.output) == by_hand(key, text, rate, spm)
    assert maker.rebuilt(cut.output, cut.form) == text


def test_more_lines_than_one_match_keeps():
    text = "ab\n" * 700_001 + "end"
    ends = line_ends(text)
    assert len(ends) == 700_002 and ends[:2] == [3, 6] and ends[-2:] == [3 * 700_001, len(text)]


def test_documents(spark, documents, empty):
    maker = FillInMiddle()
    clashing = documents.withColumn("fim", F.lit(1)).withColumn("row", F.lit("r")).withColumn("text ", F.lit("t")).withColumn("Form", F.lit(2)).withColumn("key", F.lit("k"))
    out = maker.apply(clashing)
    assert out.columns == [*documents.columns, "row", "text ", "key", "n", "form", "prefix_chars", "middle_chars", "fim"]
    got = out.collect()
    wanted = [(r["doc_id"], r["text"], *by_hand(r["doc_id"], r["text"])) for r in documents.collect()]
    assert sorted(((r["doc_id"], r["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["fim"]) for r in got), key=str) == sorted(wanted, key=str)
    assert all((r["row"], r["key"], r["text "]) == ("r", "k", "t") for r in got)
    back = maker.restore(out)
    assert back.where("restored <=> coalesce(text, '')").count() == len(got)
    digest = {(r["doc_id"], r["text"]): r for r in maker.digest(documents).collect()}
    for key, text, *_, output in wanted:
        r = digest[key, text]
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert maker.apply(empty).count() == 0 and maker.digest(empty).columns[-1] == "restored_sha256"


@pytest.mark.parametrize("output, form", [(None, "psm"), ("x", None)])
def test_nothing_to_restore(spark, output, form):
    df = spark.createDataFrame([(output, form)], "fim string, form string")
    assert FillInMiddle().restore(df).first()["restored"] is None
