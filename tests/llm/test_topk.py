import math
import random

import numpy as np
import pytest

from residua.llm.topk import BitSlicedIndex, add, at_least, kth


def brute(rows, queries, k, scale=256):
    def quantised(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(scale * float(np.float32(x))) for x in v]

    own = {(i, tuple(q)) for i, v in rows if i is not None and (q := quantised(v)) is not None}
    asked = {(i, tuple(q)) for i, v in queries if i is not None and (q := quantised(v)) is not None}
    best = {}
    for i, q in asked:
        best.setdefault(i, set()).update((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in own if j != i)
    return sorted((i, r, j, -s) for i, found in best.items() for r, (s, j) in enumerate(sorted(found)[:k], 1))


def rows_of(seed, n=300, width=12):
    rng = random.Random(seed)
    hot = [rng.uniform(-1, 1) for _ in range(width)]
    rows = []
    for i in range(n):
        v = list(hot) if i % 3 == 0 else [rng.gauss(0, 0.4) for _ in range(width)]
        rows.append((i, v))
    rows += [(n, None), (n + 1, []), (n + 2, [None] * width), (n + 3, [float("nan")] * width), (n + 4, [float("inf")] + [0.0] * (width - 1)), (None, hot), (n + 5, [0.0] * width), (n + 6, hot[:5]), (7, rows[7][1])]
    return rows


@pytest.mark.parametrize("big, width", [(float(1 << 23), 2), (float((1 << 23) - 1), 4)])
def test_outliers_are_refused(spark, big, width):
    """2^31 after quantising, and numbers below it whose scores do not fit 64 bits."""
    df = spark.createDataFrame([(1, [big] * width), (2, [0.5] * width)], "vec_id long, embedding array<float>")
    search = BitSlicedIndex()
    with pytest.raises(Exception, match="2\\^31 or more|do not fit 64 bits"):
        search.search(search.build(df), df).collect()


@pytest.mark.parametrize("seed, block, queries, drop", [(1, 1000, 1000, 2), (2, 40, 7, 2), (3, 64, 3, 0), (4, 50, 10, 6)])
def test_by_brute_force(spark, seed, block, queries, drop):
    rows = rows_of(seed)
    schema = "vec_id long, embedding array<float>, score int"
    df = spark.createDataFrame([(*r, 0) for r in rows], schema)
    search = BitSlicedIndex(block=block, queries=queries, drop=drop)
    asked = df.where("vec_id % 10 = 0 or vec_id > 299")
    got = sorted(tuple(r) for r in search.search(search.build(df), asked).collect())
    assert got == brute(rows, [r for r in rows if r[0] is not None and (r[0] % 10 == 0 or r[0] > 299)], 5)


@pytest.mark.parametrize("copies, batch", [(1, 3), (3, 1), (8, 1000)])
def test_blocks_meet_all_queries_as_they_come(spark, copies, batch):
    """However the queries are dealt, in batches of any size, many blocks to a task: the same result."""
    rows = rows_of(5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    search = BitSlicedIndex(block=1000, block_bytes=8 * 12 * 30, queries=2, copies=copies)
    index = search.build(df)
    assert index.count() > 5
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(batch))
    try:
        got = sorted(tuple(r) for r in search.search(index, df.where("vec_id % 10 = 0")).collect())
    finally:
        spark.conf.set(name, before)
    assert got == brute(rows, [r for r in rows if r[0] is not None and r[0] % 10 == 0], 5)


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    search = BitSlicedIndex()
    empty = spark.createDataFrame([], schema)
    assert search.search(search.build(empty), empty).count() == 0
    three = spark.createDataFrame([(1, [0.5, 0.5]), (2, [-0.5, 0.25]), (3, [0.0, 0.0])], schema)
    assert search.search(search.build(three), empty).count() == 0
    got = sorted(tuple(r) for r in search.search(search.build(three), three.where("vec_id = 1")).collect())
    assert got == [(1, 1, 3, 0), (1, 2, 2, 128 * -128 + 128 * 64)]


def test_bitmap_arithmetic():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 500, 130), rng.integers(0, 60, 130)
    sliced = lambda x: [np.packbits(np.pad(x >> k & 1, (0, 62)).astype(np.uint8), bitorder="little").view(np.uint64) for k in range(10)]
    total = []
    add(total, sliced(a), 0)
    add(total, sliced(b), 3)
    rows = np.packbits(np.pad(np.ones(130, np.uint8), (0, 62)), bitorder="little").view(np.uint64)
    read = lambda bitmap: np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:130].astype(bool)
    want = a + 8 * b
    assert (sum(read(t).astype(int) << k for k, t in enumerate(total)) == want).all()
    for k in (1, 5, 130):
        assert kth(total, rows, k) == np.sort(want)[-k]
    for level in (-3, 0, 1, int(want.max()), int(want.max()) + 1, 1 << 40):
        assert (read(at_least(total, rows, level)) == (want >= level)).all()
