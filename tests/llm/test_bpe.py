import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from residua.llm.bpe import BpeEncoder, Codec

public = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as f:
        return Codec(json.load(f))


def same(codec, library, text):
    ids, decoded = codec.words(text)
    want = library.encode(text, add_special_tokens=False).ids
    assert " ".join(ids) == " ".join(map(str, want)), text
    assert " ".join(decoded) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ththananreinaahe's.,! 1é\n", max_size=60))
def test_words_like_the_library(codec, library, text):
    same(codec, library, text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_any_text_like_the_library(codec, library, text):
    same(codec, library, text)


@pytest.mark.parametrize("text", ["", "  ", "<|startoftext|><|endoftext|>x<|endof", "'S it's ''s we'll", "ΑΣ ΣΑΣ İstanbul", "a\x1cb\x1d c\x85d\xa0e​f　g", "a" * 3000, "é Å ﬁ Ⅷ ½", "👨‍👩‍👧 中文 \x00\x01﻿"])
def test_odd_texts_like_the_library(codec, library, text):
    same(codec, library, text)


def test_documents(spark, library, documents, empty):
    bpe = BpeEncoder(PATH)
    assert bpe.digest(empty).count() == 0
    digest = bpe.digest(documents.selectExpr("*", "'clash' as n_tokens")).collect()
    assert len(digest) == documents.count()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in digest:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(" ".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_decode_by_offsets(spark, library, documents):
    bpe = BpeEncoder(PATH)
    for r in bpe.decode(bpe.encode(documents)).collect():
        assert r["decoded"] == library.decode(r["ids"], skip_special_tokens=False)
    nothing = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode(nothing).collect()] == [None, ""]
