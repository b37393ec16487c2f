"""Quality rules: counted base rules and a hashed n-gram log-likelihood ratio between trusted and raw text.

Two multinomials over hashed byte n-grams are counted: one over the trusted documents, one over the whole corpus. A document
scores the mean log ratio of its n-grams, so length does not matter, and is kept if the score reaches a fixed
threshold: the same document gets the same verdict in every run. Both multinomials cover all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residua.functions.lookup import BROADCAST_ROWS, lookup_join
from residua.functions.materialize import materialize
from residua.llm.common import Filter, column, packed, slices, unpacked

SYMBOLS = b"#*$%&|<>"
#: Fixed-point unit of the scores.
UNIT = 1 << 24
COMPUTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


@dataclass(frozen=True)
class QualityRules:
    """``fit`` counts both multinomials, ``score`` judges every document.

    text            the text column; null counts as empty
    gram, bits      bytes of an n-gram, and bits of its bucket number: the model has 2**bits numbers, whatever the corpus
    smoothing       added to every bucket
    threshold       lowest mean log ratio that is kept
    min_words       fewer words fail the base rules
    max_repeat_pct  a larger share of words in repeated 3-word windows fails them

    Defined results: null and empty texts have zero counts, score 0 and fail the base rules; without trusted documents every
    score is 0; equal rows get equal results; an empty table gives an empty table.
    """

    text: str = "text"
    gram: int = 4
    bits: int = 18
    smoothing: float = 1.0
    threshold: float = -0.35
    min_words: int = 50
    max_repeat_pct: int = 50

    def _flagged(self, docs: DataFrame, trusted: DataFrame, on: str) -> DataFrame:
        """(_text, _trusted) of all documents with a text.

        Few names are broadcast, so no text travels. Beyond that, a bitmap of them lets most other documents stay where they are, and
        the rest meet the names exactly, salted by their content.
        """
        texts = docs.select(column(on).alias("_id"), column(self.text).alias("_text")).where("_text is not null")
        names = trusted.select(column(on).try_cast(texts.schema["_id"].dataType).alias("_id")).where("_id is not null").distinct()
        names = materialize(names.withColumn("_trusted", F.lit(True)), "trusted")
        n = names.count()
        if n <= BROADCAST_ROWS:
            return texts.join(F.broadcast(names), "_id", "left").select("_text", "_trusted")
        seen = Filter(names.select("_id"))
        near = lookup_join(seen.keep(texts, "_id"), names, ["_id"], n, limit=BROADCAST_ROWS).select("_text", "_trusted")
        return near.unionByName(seen.keep(texts, "_id", other=True).select("_text", F.lit(None).cast("boolean").alias("_trusted")))

    def fit(self, docs: DataFrame, trusted: DataFrame, on: str = "doc_id") -> NgramRatio:
        """``trusted`` names the trusted documents by ``on``; repeated and null names are allowed."""
        size, gram, text = 1 << self.bits, self.gram, "_text"
        flagged = self._flagged(docs, trusted, on)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
            for batch, texts in slices(batches, text):
                mark = np.array([bool(x) for x in batch.column("_trusted").to_pylist()])
                ids, starts, lengths = gram_ids(texts, gram, size)
                raw += np.bincount(ids, minlength=size + 1)[:size]
                if mark.any():
                    chosen = np.repeat(mark, lengths + gram - 1)
                    target += np.bincount(ids[chosen], minlength=size + 1)[:size]
            seen = np.flatnonzero(raw)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"])

        counts = (
            flagged.select(text, "_trusted")
            .mapInArrow(count, "bucket long, raw long, target long")
            .groupBy("bucket")
            .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        )
        raw, target = np.zeros(size), np.zeros(size)
        found = counts.toArrow()  # 2**bits rows at most
        at = found["bucket"].to_numpy()
        raw[at], target[at] = found["raw"].to_numpy(), found["target"].to_numpy()
        return NgramRatio(self, log_ratio(raw, target, self.smoothing))


@dataclass(frozen=True)
class NgramRatio:
    rules: QualityRules
    weights: np.ndarray = field(repr=False)

    def score(self, docs: DataFrame) -> DataFrame:
        """All rows and columns of ``docs``, with the computed columns in place of any of the same name."""
        rules, spark = self.rules, docs.sparkSession
        shared = spark.sparkContext.broadcast(self.weights)  # 2**bits numbers
        base = packed(docs, COMPUTED, text=column(rules.text))
        added = [T.StructField(n, T.LongType()) for n in COMPUTED[:5]]
        added += [T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())]

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights = shared.value
            for batch, texts in slices(batches, "text"):
                counts = base_counts(texts)
                n, repeated = counts["n_words"], counts["n_repeat_words"]
                failed = (n < rules.min_words) | (100 * repeated > rules.max_repeat_pct * n)
                scores = mean_weights(texts, rules.gram, weights)
                arrays = [batch.column("row")]
                arrays += [pa.array(counts[c]) for c in COMPUTED[:5]]
                arrays += [pa.array(failed), pa.array(scores), pa.array(~failed & (scores >= rules.threshold))]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", *COMPUTED])

        return unpacked(base.mapInArrow(judge, T.StructType([base.schema["row"], *added])), COMPUTED)


def log_ratio(raw: np.ndarray, target: np.ndarray, smoothing: float) -> np.ndarray:
    """Log of target probability over raw probability per bucket; zeros if either side has no n-gram."""
    if not raw.sum() or not target.sum():
        return np.zeros(len(raw))
    share = lambda x: np.log((x + smoothing) / (x.sum() + smoothing * len(x)))
    return share(target) - share(raw)


def gram_ids(texts: list[bytes], gram: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the n-gram that starts at each byte, zero bytes filling up the end of a text; first byte and length of
    each text. Buckets of the filling itself are ``size``."""
    fill = b"\0" * (gram - 1)
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join([t + fill for t in texts]) + fill, np.uint8)
    total = len(data) - len(fill)
    value = np.zeros(total, np.uint64)
    for k in range(gram):
        value = value * np.uint64(257) + data[k : k + total]
    value *= np.uint64(0x9E3779B97F4A7C15)
    ids = (value >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)
    starts = np.cumsum(lengths + len(fill)) - lengths - len(fill)
    for k in range(len(fill)):
        ids[starts + lengths + k] = size
    return ids, starts, lengths


def mean_weights(texts: list[bytes], gram: int, weights: np.ndarray) -> np.ndarray:
    """Mean weight of each text's n-grams, in fixed point: sums are exact, whatever texts lie beside one another."""
    ids, starts, lengths = gram_ids(texts, gram, len(weights))
    fixed = np.append(np.rint(weights * UNIT), 0).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(fixed[ids])])
    return (total[starts + lengths] - total[starts]) / (np.maximum(lengths, 1) * UNIT)


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counted base features of each text, exactly: words are numbered, windows compare by their words' numbers."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(texts), np.uint8)
    per_text = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[np.concatenate([[0], ends])])
    words = [t.split() for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    return {
        "n_words": n_words,
        "word_chars": per_text(~_SPACE[data] & (data & 0xC0 != 0x80)).astype(np.int64),
        "n_symbols": per_text(_SYMBOL[data]).astype(np.int64),
        "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64),
        "n_repeat_words": repeated_words(words, n_words),
    }


def repeated_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(lines) == len(set(lines)):
        return 0
    seen, repeats = set(), 0
    for line in lines:
        if line in seen:
            repeats += bool(line.strip(b" \t\r\x0b\f"))
        seen.add(line)
    return repeats


def repeated_words(words: list[list[bytes]], n_words: np.ndarray) -> np.ndarray:
    """Per text: words that lie in a 3-word window found twice or more in that text."""
    total = int(n_words.sum())
    if total < 3:
        return np.zeros(len(words), np.int64)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in words for w in ws), np.int64, total)
    doc = np.repeat(np.arange(len(words)), n_words)
    pair = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]  # numbers, so that three fit 64 bits
    window = pair[:-1] * len(numbers) + ids[2:]
    whole = np.flatnonzero(doc[:-2] == doc[2:])
    window, owner = window[whole], doc[whole]
    order = np.argsort(window, kind="stable")  # equal windows keep the order of the texts
    same = (window[order][1:] == window[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    repeated = np.zeros(len(whole), bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    covered = np.zeros(total, bool)
    for k in range(3):
        covered[whole[repeated] + k] = True
    return np.bincount(doc[covered], minlength=len(words)).astype(np.int64)
