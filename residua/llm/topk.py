"""Exact top-k search by inner product over a bit-sliced index.

Vectors are quantised to integers. The index holds, for blocks of distinct vectors, one bitmap per component and bit: bit r of
slice (d, b) is bit b of component d of row r, counted from the block's least value. The lowest bits are left out of the
slices and bounded instead. A query's scores come from adding slices with bitmap arithmetic, a ripple-carry adder over whole
bitmaps; the rows with the highest sums are selected from the most significant slice of the sum downward; the
rows that the left-out bits may still lift over the boundary get their exact score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from residua.functions.materialize import materialize
from residua.llm.common import column

ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class BitSlicedIndex:
    """``build`` writes the index, ``search`` finds each query's best rows, exactly.

    k       rows per query; every row with the query's own id is left out
    scale   a component x becomes floor(scale * x)
    drop    low bits without a slice
    block   distinct vectors of an index row, on average, and the most bytes of their components, 8 each
    queries queries that are worth a task of their own
    copies  most tasks that share the queries to a block: an index row travels so often at most, however many queries there are

    Defined results: vectors that are null, without id, or hold null or non-finite components take no part; a shorter vector, the empty one
    too, counts as filled up with zeros; equal vectors are stored once with their k + 1 smallest ids; ties go to the smaller id; queries that
    share an id are one query; scores are 64-bit sums; quantised components of 2**31 and more, and
    vectors whose sums might not fit, raise an error; an empty table gives an empty table; other columns do not matter.
    """

    key: str = "vec_id"
    vector: str = "embedding"
    k: int = 5
    scale: int = 256
    drop: int = 2
    block: int = 32_768
    block_bytes: int = 1 << 26
    queries: int = 256
    copies: int = 8

    def quantised(self, rows: DataFrame) -> DataFrame:
        doubled = F.transform(column(self.vector), lambda x: x.cast("double"))
        whole = rows.select(column(self.key).alias("id"), doubled.alias("x")).where("id is not null and x is not null")
        fine = ~F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return whole.where(F.coalesce(fine, F.lit(False))).select("id", F.transform("x", lambda x: F.floor(x * self.scale).cast("long")).alias("q"))

    def build(self, rows: DataFrame) -> DataFrame:
        """One row per block: its ids, its vectors, its slices. A written table."""
        ranked = self.quantised(rows).distinct().withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy("id")))
        distinct = ranked.where(F.col("n") <= self.k + 1).groupBy("q").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        distinct = materialize(distinct, "vectors")
        sums = distinct.agg(F.count(F.lit(1)), F.max(F.size("q"))).first()
        width, drop = sums[1] or 0, self.drop
        blocks = max(1, -(-sums[0] // max(1, min(self.block, self.block_bytes // max(1, 8 * width)))))

        def slice_block(rows: pa.Table) -> pa.Table:
            matrix = padded(rows.column("q").combine_chunks(), width)
            if matrix.size and max(int(matrix.max()), -int(matrix.min())) >= 1 << 31:
                raise ValueError("a quantised component has 2^31 or more in size: outside the index's range")
            low = matrix.min(axis=0)
            lifted = (matrix - low).astype(np.uint64)
            bits = max(int(lifted.max(initial=0)).bit_length(), drop + 1)
            words = -(-len(matrix) // 64)
            slices = np.zeros((width, bits - drop, words), np.uint64)
            for b in range(drop, bits):
                ones = np.zeros((width, words * 64), np.uint8)
                ones[:, : len(matrix)] = ((lifted >> np.uint64(b)) & np.uint64(1)).T
                slices[:, b - drop] = np.packbits(ones, axis=1, bitorder="little").view(np.uint64)
            made = [rows.column("block").slice(0, 1), [len(matrix)], [bits], [low.tobytes()], [rows.column("ids").to_pylist()], [matrix.astype(np.int32).tobytes()], [slices.tobytes()]]
            return pa.table(made, schema=pa.schema([("block", pa.int64()), ("n", pa.int64()), ("bits", pa.int64()), ("low", pa.binary()), ("ids", pa.list_(pa.list_(pa.int64()))), ("matrix", pa.binary()), ("slices", pa.binary())]))

        dealt = distinct.select(F.pmod(F.xxhash64("q"), F.lit(blocks)).alias("block"), "q", "ids")
        schema = "block long, n long, bits long, low binary, ids array<array<long>>, matrix binary, slices binary"
        return materialize(dealt.groupBy("block").applyInArrow(slice_block, schema), "bit-slices")

    def search(self, index: DataFrame, queries: DataFrame) -> DataFrame:
        """(query_id, rank, vec_id, score) of the ``k`` best rows of every query, ranks from 1."""
        asked = materialize(self.quantised(queries).distinct(), "queries")
        width = index.select(F.max(F.length("low") / 8).cast("int")).first()[0] or 0
        width = max(width, asked.agg(F.max(F.size("q"))).first()[0] or 0)
        parts = max(1, min(self.copies, -(-asked.count() // self.queries)))
        blocks = index.agg(F.max("block")).first()[0]
        k, drop = self.k, self.drop

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """A block's row, then its queries as they come, so neither all queries nor two blocks are held at a time."""
            block = None
            for batch in batches:
                places = list(zip(batch.column("block").to_pylist(), batch.column("part").to_pylist(), strict=True))
                whole, found = batch.column("index").is_valid().to_pylist(), ([], [], [])
                start = 0
                while start < len(places):
                    if whole[start]:
                        block = (places[start], Block(batch.column("index")[start].as_py(), width, drop))
                        start += 1
                        continue
                    end = start
                    while end < len(places) and places[end] == places[start] and not whole[end]:
                        end += 1
                    if block is not None and block[0] == places[start]:
                        asking = batch.slice(start, end - start)
                        wanted = padded(pa.array(asking.column("q").to_pylist(), pa.list_(pa.int64())), width)
                        block[1].check(wanted)
                        for query, vector in zip(asking.column("id").to_pylist(), wanted, strict=True):
                            ids, scores = block[1].best(query, vector, k)
                            found[0].extend([query] * len(ids))
                            found[1].extend(ids)
                            found[2].extend(scores)
                    start = end
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["query_id", "vec_id", "score"])

        # queries go to the blocks, in a few parts a block; a block stands before its queries. A number without a block finds none
        numbers = F.sequence(F.lit(0).cast("long"), F.lit(blocks or 0).cast("long"))
        ask = asked.select(F.explode(numbers).alias("block"), F.pmod(F.xxhash64("id", "q"), F.lit(parts)).alias("part"), "id", "q")
        own = F.struct("n", "bits", "low", "ids", "matrix", "slices").alias("index")
        each = index.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), own)
        dealt = each.unionByName(ask, allowMissingColumns=True).repartition("block", "part").sortWithinPartitions("block", "part", F.col("index").isNull())
        near = dealt.mapInArrow(best, "query_id long, vec_id long, score long")
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        ranked = near.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= self.k)
        return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def padded(vectors: pa.ListArray, width: int) -> np.ndarray:
    """A matrix of the vectors, zeros where one is short."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


class Block:
    """The rows of one index row."""

    def __init__(self, row: dict, width: int, drop: int):
        self.n, self.drop = row["n"], drop
        self.bits = row["bits"] - drop
        low = np.frombuffer(row["low"], np.int64)
        own = len(low)
        self.ids = row["ids"]
        self.matrix = np.zeros((self.n, width), np.int64)
        self.matrix[:, :own] = np.frombuffer(row["matrix"], np.int32).reshape(self.n, own)
        self.slices = np.frombuffer(row["slices"], np.uint64).reshape(own, self.bits, -1)
        self.all = np.full(self.slices.shape[2], ONES)
        if self.n % 64:
            self.all[-1] = np.uint64((1 << (self.n % 64)) - 1)

    def check(self, wanted: np.ndarray) -> None:
        """Sums of the lifted components, width times a component times a query's, must fit 64 bits."""
        largest = max(int(wanted.max()), -int(wanted.min())) if wanted.size else 0
        if self.matrix.shape[1] * largest << (self.bits + self.drop) >= 1 << 62:
            raise ValueError("scores of these vectors do not fit 64 bits")

    def sums(self, vector: np.ndarray) -> list[np.ndarray]:
        """Slices of the sum over components of |query| times the component, or its complement where the query is negative.

        Differs from the score by a constant of the query and the block, and by the bits that have no slice.
        """
        total: list[np.ndarray] = []
        for d, bitmaps in enumerate(self.slices):
            factor = abs(int(vector[d]))
            if not factor:
                continue
            term = [b ^ self.all for b in bitmaps] if vector[d] < 0 else list(bitmaps)
            shift = 0
            while factor >> shift:
                if factor >> shift & 1:
                    add(total, term, shift)
                shift += 1
        return total

    def best(self, query: int, vector: np.ndarray, k: int) -> tuple[list[int], list[int]]:
        total = self.sums(vector)
        # the k + 1 highest sums: one of the rows may be the query's own
        level = kth(total, self.all, min(k + 1, self.n))
        slack = int(np.abs(vector).sum()) * ((1 << self.drop) - 1)  # what the left-out bits add at most
        rows = np.flatnonzero(np.unpackbits(at_least(total, self.all, level - (-(-slack >> self.drop))).view(np.uint8), bitorder="little")[: self.n])
        scores = self.matrix[rows] @ vector
        if len(rows) > k + 1:
            keep = scores >= np.partition(scores, -(k + 1))[-(k + 1)]
            rows, scores = rows[keep], scores[keep]
        pairs = sorted((-int(s), i) for r, s in zip(rows, scores, strict=True) for i in self.ids[r] if i != query)[:k]
        return [i for _, i in pairs], [-s for s, _ in pairs]


def add(total: list[np.ndarray], term: list[np.ndarray], shift: int) -> None:
    """Add a bit-sliced number, shifted, to a bit-sliced total: a ripple-carry adder over bitmaps."""
    while len(total) < shift + len(term):
        total.append(np.zeros_like(term[0]))
    carry = None
    for j, t in enumerate(term, shift):
        s = total[j]
        half = s ^ t
        both = s & t
        if carry is None:
            total[j], carry = half, both
        else:
            total[j] = half ^ carry
            carry = both | (half & carry)
    j = shift + len(term)
    while carry.any():
        if j == len(total):
            total.append(np.zeros_like(carry))
        total[j], carry = total[j] ^ carry, total[j] & carry
        j += 1


def kth(total: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th highest number among ``rows``, its bits settled from the most significant slice downward."""
    sure, level, tied = 0, 0, rows
    for j in range(len(total) - 1, -1, -1):
        high = tied & total[j]
        n = int(np.bitwise_count(high).sum())
        level <<= 1
        if sure + n >= k:
            tied, level = high, level | 1
        else:
            sure += n
            tied = tied & ~total[j]
    return level


def at_least(total: list[np.ndarray], rows: np.ndarray, level: int) -> np.ndarray:
    """Bitmap of the rows whose number is ``level`` or more."""
    if level <= 0:
        return rows
    if level >> len(total):
        return rows & ~rows
    above, equal = np.zeros_like(rows), rows
    for j in range(len(total) - 1, -1, -1):
        if level >> j & 1:
            equal = equal & total[j]
        else:
            above = above | (equal & total[j])
            equal = equal & ~total[j]
    return above | equal
