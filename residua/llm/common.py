"""Helpers the corpus operators share: word rules, bounded text slices of Arrow batches, worker caches, column rules.

Column rule of every operator: computed columns replace input columns of the same name; all other input columns pass
through unchanged where the operator returns its input rows.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.functions.materialize import materialize

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Bytes of text a Python task turns into arrays at a time; a longer single document is a slice of its own.
SLICE_BYTES = 2_000_000


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` less the columns that ``names`` would clash with; names compare as Spark compares them."""
    low = {n.lower() for n in names}
    kept = [c for c in df.columns if c.lower() not in low]
    return df.select(*[column(c) for c in kept])


def packed(df: DataFrame, computed: list[str] | tuple[str, ...], **inputs: Column) -> DataFrame:
    """``inputs`` beside the struct ``row`` of the input columns that ``computed`` does not replace: no input name can clash."""
    low = {n.lower() for n in computed}
    kept = [column(c) for c in df.columns if c.lower() not in low]
    row = F.struct(*kept) if kept else F.struct(F.lit(None).cast("int").alias("none"))
    return df.select(row.alias("row"), *[c.alias(n) for n, c in inputs.items()])


def unpacked(df: DataFrame, computed: list[str] | tuple[str, ...]) -> DataFrame:
    """The input columns out of ``row``, then the computed ones."""
    names = [n for n in df.schema["row"].dataType.names if n.lower() not in {c.lower() for c in computed}]
    return df.select(*[F.col("row").getField(n).alias(n) for n in names], *[column(c) for c in computed])


#: Documents that travel to a Python task at a time: texts are long, and a batch is held several times over.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Session setting for tables of documents, so that Arrow batches stay at a few megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


#: Bits of a bitmap filter.
FILTER_BITS = 24


class Filter:
    """A bitmap of hashed numbers, 2**FILTER_BITS bits whatever the data: one small row that is broadcast to keep rows that
    cannot match out of a shuffle. It lets some others through, so a join has to follow; null never matches."""

    def __init__(self, values: DataFrame):
        (name,) = values.columns
        at = self._place(F.col(name))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))
        words = values.where(F.col(name).isNotNull()).select(F.shiftright(at, 6).cast("int").alias("w"), bit.alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits"))
        slots = values.sparkSession.range(1 << (FILTER_BITS - 6)).select(F.col("id").cast("int").alias("w"))
        row = slots.join(words, "w", "left").select("w", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
        row = row.agg(F.sort_array(F.collect_list(F.struct("w", "bits"))).alias("all")).select(F.col("all.bits").alias("_mask"))
        self.row = materialize(row, "filter")

    @staticmethod
    def _place(value: Column) -> Column:
        return F.xxhash64(value).bitwiseAND((1 << FILTER_BITS) - 1)

    def _hit(self, name: str) -> Column:
        at = self._place(F.col(name))
        word = F.get("_mask", F.shiftright(at, 6).cast("int"))
        return (F.call_function("shiftrightunsigned", word, at.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1) & F.col(name).isNotNull()

    def mark(self, rows: DataFrame, name: str, flag: str) -> DataFrame:
        """``rows`` with a column that says whether the value may be among the numbers."""
        return rows.crossJoin(F.broadcast(self.row)).withColumn(flag, self._hit(name)).drop("_mask")

    def keep(self, rows: DataFrame, name: str, other: bool = False) -> DataFrame:
        """The rows whose value may be among the numbers, or with ``other`` all the others."""
        hit = self._hit(name)
        return rows.join(F.broadcast(self.row), ~hit if other else hit).drop("_mask")


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null: every word becomes one letter, then all white space goes."""
    letters = F.regexp_replace(text, r"[^\x20\x09-\x0D]++", "x")
    return F.coalesce(F.length(F.translate(letters, " \t\n\x0b\f\r", "")), F.lit(0)).cast("long")


def encoded(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [b"" if t is None else t for t in texts.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches cut so that the texts of one slice stay near ``limit`` bytes, with those texts."""
    for batch in batches:
        start = size = 0
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        for i, n in enumerate(sizes):
            if i > start and size + n > limit:
                part = batch.slice(start, i - start)
                yield part, encoded(part.column(text))
                start, size = i, 0
            size += n
        if batch.num_rows > start:
            part = batch.slice(start)
            yield part, encoded(part.column(text))


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker process, whatever task runs in it."""
    holder = sys.modules.setdefault("residua_worker_cache", types.ModuleType("residua_worker_cache"))
    return holder.__dict__.setdefault(name, {})


_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_ODD = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in order, and the number of words of each text.

    A word's hash is the sum of a random number per byte times a power of a base per place, taken from running sums over the whole
    slice and moved to the word's own start; then the bits are mixed.
    """
    cache = worker_cache("word hashes")
    if not cache:
        table = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        cache.update(table=table, power=np.ones(1, np.uint64), inverse=np.ones(1, np.uint64))
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    n = len(data) + 1
    if len(cache["power"]) < n:
        for name, base in (("power", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            cache[name] = np.cumprod(steps)
    word = np.concatenate([[False], ~_SPACES[data], [False]])
    starts, ends = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(~word[1:] & word[:-1])
    total = np.zeros(n, np.uint64)
    np.cumsum(cache["table"][data] * cache["power"][: n - 1], out=total[1:])
    value = (total[ends] - total[starts]) * cache["inverse"][starts]
    value = (value ^ (value >> np.uint64(32))) * _ODD
    value ^= value >> np.uint64(29)
    first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return value, np.diff(np.searchsorted(starts, first))
