"""Language identification by Bayesian evidence fusion.

The text's likelihoods come from hashed byte n-gram multinomials of labelled documents. The declared markup language and the address suffix are
witnesses whose reliability is counted: how often each is seen with each language that the text alone suggests. The prior is
that of the page's host, smoothed by its domain's, and that by the global one; all of it by grouped aggregation. A page is judged by
the counts of all other pages: its own guess is taken out, and a page without text has none.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residua.functions.lookup import lookup_join
from residua.functions.materialize import materialize
from residua.llm.common import column, slices, without
from residua.llm.quality import gram_ids

DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b"
HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
#: Languages whose weights make one broadcast matrix; more languages come as more matrices, of which a worker holds one at a time.
PART = 64
HIDDEN = re.compile(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


@dataclass(frozen=True)
class LanguageEvidence:
    """``fit`` counts the languages' n-grams over all labelled documents, ``identify`` judges pages.

    gram, bits  bytes of an n-gram, bits of its bucket: 2**bits numbers per language
    evidence    n-grams a text counts for at most, as neighbours repeat one another
    strength    weight of the next wider level in a prior, in pages

    Every label counts and can be a result, however many there are.
    Defined results: null or tagless pages have no markup evidence, null or hostless addresses no host and no suffix (the
    global prior holds); a page without text has no text_lang and is judged by the rest; without labelled documents every result is null; ties go to the smaller
    name; equal rows get equal results; an empty table gives an empty table.
    """

    gram: int = 3
    bits: int = 14
    evidence: int = 100
    strength: float = 5.0

    def fit(self, docs: DataFrame, text: str = "text", label: str = "lang") -> LanguageModel:
        size, gram = 1 << self.bits, self.gram
        rows = docs.select(column(text).alias("_text"), column(label).alias("_lang")).where("_lang is not null")
        names = sorted(r[0] for r in rows.select("_lang").distinct().collect())
        held = PART

        def flushed(total: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
            for k, counts in total.items():
                bucket = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), k)), pa.array(bucket), pa.array(counts[bucket])], names=["lang", "bucket", "n"])
            total.clear()

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = {n: k for k, n in enumerate(names)}
            total: dict[int, np.ndarray] = {}
            for batch, texts in slices(batches, "_text"):
                own = np.array([number[x] for x in batch.column("_lang").to_pylist()])
                ids, _, lengths = gram_ids(texts, gram, size)
                owner = np.repeat(own, lengths + gram - 1)
                for k in np.unique(own).tolist():
                    if k not in total and len(total) >= held:
                        yield from flushed(total)
                    found = np.bincount(ids[owner == k], minlength=size + 1)[:size]
                    total[k] = total[k] + found if k in total else found
            yield from flushed(total)

        counts = rows.mapInArrow(count, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        if len(names) > held:
            counts = materialize(counts, "language-counts")
        parts = []
        for start in range(0, len(names), held):
            some = counts.where(F.col("lang").between(start, start + held - 1)).toPandas()  # PART * 2**bits rows at most
            total = np.zeros((min(held, len(names) - start), size))
            total[some["lang"].to_numpy() - start, some["bucket"].to_numpy()] = some["n"]
            logs = np.log((total + 0.5) / (total.sum(axis=1, keepdims=True) + 0.5 * size))
            parts.append(docs.sparkSession.sparkContext.broadcast(logs))
        return LanguageModel(self, names, parts)


@dataclass(frozen=True)
class LanguageModel:
    settings: LanguageEvidence
    names: list[str]
    parts: list[Broadcast] = field(repr=False)

    def identify(self, pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
        """One row per page: key, lang, probability, text_lang, declared, suffix, host."""
        names, settings = self.names, self.settings
        host = F.lower(F.regexp_extract(column(url), HOST, 1))
        host = F.when(host.rlike(r"^[^.]+(\.[^.]+)+$"), host)
        declared = F.regexp_extract(column(html), DECLARED, 1)
        rows = pages.select(
            column(key).alias("_key"), F.lower(F.when(declared != "", declared)).alias("declared"), host.alias("host"),
            F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"), F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"), column(html).alias("_text"),
        )
        if not names:
            nothing = F.lit(None).cast("string")
            return rows.select(F.col("_key").alias(key), nothing.alias("lang"), F.lit(None).cast("double").alias("probability"), nothing.alias("text_lang"), "declared", "suffix", "host")
        parts, most = self.parts, settings.evidence
        gram, size = settings.gram, 1 << settings.bits
        kept = [f for f in rows.schema.fields if f.name != "_text"]

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in slices(batches, "_text"):
                plain = [visible(t) for t in texts]
                ids, starts, lengths = gram_ids(plain, gram, size)
                out = np.zeros((len(plain), len(names)))
                k = 0
                for part in parts:
                    for weights in part.value:
                        total = np.concatenate([[0.0], np.cumsum(np.append(weights, 0.0)[ids])])
                        out[:, k] = (total[starts + lengths] - total[starts]) / np.maximum(lengths, 1) * np.minimum(lengths, most)
                        k += 1
                    if len(parts) > 1 and part._path is not None:  # read again for the next slice
                        vars(part).pop("_value", None)
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(out.tolist(), pa.list_(pa.float64()))], names=[f.name for f in kept] + ["logs"])

        schema = T.StructType([*kept, T.StructField("logs", T.ArrayType(T.DoubleType()))])
        guess = F.when(F.array_min("logs") < 0, top(F.col("logs")))  # a text has a likelihood below 1
        seen = materialize(rows.mapInArrow(read, schema).withColumn("guess", guess), "language-evidence")
        guessed = dict(tuple(r) for r in seen.where("guess is not null").groupBy("guess").count().collect())
        joined = seen.withColumn("_own", F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), lambda k: F.when(F.col("guess") == k, 1.0).otherwise(0.0)))
        joined = joined.withColumn("_everywhere", others(F.array(*[F.lit(float(guessed.get(k, 0))) for k in range(len(names))])))
        pages_seen = F.lit(float(sum(guessed.values()) + len(names))) - F.when(F.col("guess").isNull(), 0.0).otherwise(1.0)
        prior = F.transform("_everywhere", lambda n: (n + 1.0) / pages_seen)
        for level in ("domain", "host"):
            joined = self._with_counts(joined, seen, level)
            joined = joined.withColumn(f"_prior_{level}", smoothed(F.col(f"_{level}"), prior, settings.strength))
            prior = F.col(f"_prior_{level}")
        # a witness says what it says with the frequency it had for each language
        for witness in ("declared", "suffix"):
            said = f"_said_{witness}"
            joined = self._with_counts(joined, seen, witness, said)
            kinds = max(1, seen.select(witness).where(F.col(witness).isNotNull()).distinct().count())
            among = F.transform("_everywhere", lambda n: n + F.lit(float(kinds)))  # noqa: B023
            likelihood = F.zip_with(F.col(said), among, lambda x, n: F.log((x + 1.0) / n))
            zeros = F.array(*[F.lit(0.0) for _ in names])
            joined = joined.withColumn(said, F.when(F.col(said).isNull(), zeros).otherwise(likelihood))
        witnessed = F.zip_with("_said_declared", "_said_suffix", lambda x, y: x + y)
        sums = F.zip_with(F.zip_with("logs", witnessed, lambda x, y: x + y), prior, lambda x, p: x + F.log(p))
        joined = joined.withColumn("_sum", sums).withColumn("_best", top(F.col("_sum")))
        joined = joined.withColumn("_peak", F.array_max("_sum"))
        weight = F.aggregate("_sum", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_peak")))
        name = lambda k: F.when(k.isNotNull(), F.element_at(F.array(*[F.lit(n) for n in names]), k + 1))
        return joined.select(F.col("_key").alias(key), name(F.col("_best")).alias("lang"), (1 / weight).alias("probability"), name(F.col("guess")).alias("text_lang"), "declared", "suffix", "host")

    def _with_counts(self, rows: DataFrame, seen: DataFrame, level: str, to: str | None = None) -> DataFrame:
        """``rows`` with the counts of the text's guesses among the other pages of the same ``level``; null where no page has one."""
        counts = seen.where((F.coalesce(F.col(level), F.lit("")) != "") & F.col("guess").isNotNull()).groupBy(level, "guess").agg(F.count(F.lit(1)).cast("double").alias("n"))
        counts = counts.groupBy(level).agg(F.map_from_entries(F.collect_list(F.struct("guess", "n"))).alias("all"))
        each = F.transform(F.sequence(F.lit(0), F.lit(len(self.names) - 1)), lambda k: F.coalesce(F.col("all")[k], F.lit(0.0)))
        to = to or f"_{level}"
        counts = materialize(counts.select(level, each.alias(to)), f"language-{level}")
        return lookup_join(rows, counts, [level], counts.count()).withColumn(to, others(F.col(to)))


def visible(text: bytes) -> bytes:
    """A page's text without tags, scripts and comments, its character references resolved, white space as single spaces."""
    text = HIDDEN.sub(b" ", text)
    if b"&" in text:
        text = markup.unescape(text.decode("utf-8", "replace")).replace("\xa0", " ").encode("utf-8", "replace")
    return b" ".join(text.split())


def others(counts: Column) -> Column:
    """Counts less the page's own guess."""
    return F.zip_with(counts, F.col("_own"), lambda n, own: n - own)


def smoothed(counts: Column, wider: Column, strength: float) -> Column:
    """Shares of the counts, pulled to the next wider level's as if that had been seen ``strength`` times; that level's without counts."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.when(counts.isNull(), wider).otherwise(F.zip_with(counts, wider, lambda x, p: (x + strength * p) / (total + strength)))


def top(logs: Column) -> Column:
    """Place of the largest number, the first if several are equal."""
    return (F.array_position(logs, F.array_max(logs)) - 1).cast("int")
