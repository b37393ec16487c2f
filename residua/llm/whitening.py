"""Embedding whitening over the singular values of a bidiagonal matrix.

Tasks reduce their centred rows to a triangle R by QR, block after block, and triangles are stacked and reduced again in a
tree: no covariance matrix is formed, so no digits are lost to squaring. Householder reflections bring R to an upper bidiagonal
matrix, whose singular values the differential qd algorithm with shifts finds to high relative accuracy. For each wanted
direction, the forward and the backward factorisation of B'B minus the squared value meet in a twist where the remainder is
smallest; two recurrences from there give the vector, and the reflections take it back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residua.functions.materialize import materialize
from residua.llm.common import column, packed, unpacked
from residua.llm.topk import padded

COMPUTED = ("deviation", "whitened")
#: Triangles that are stacked in one task.
FAN = 8
#: Quantised components have to stay below this.
RANGE = 1 << 40
EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Whitening:
    """``fit`` finds the directions over every distinct quantised vector once, ``transform`` projects all rows.

    components  most directions, by falling variance
    scale       a component c becomes the long floor(scale * c)

    Defined results: vectors that are null or hold null or non-finite entries take no part; an empty vector, like a shorter one, counts as
    filled up with zeros; equal vectors are one in the fit, and rows of their own in the result; a row without id takes part; of
    equal variances any orthonormal directions are taken; directions without variance (one vector only, dependent dimensions)
    have null instead of a projection; no vectors, or only empty ones, have no components; quantised entries of 2**40 and more raise an
    error; a deviation that no long holds is null; an empty table gives an empty table. Computed columns replace input columns of the same name.
    """

    vector: str = "embedding"
    components: int = 4
    scale: int = 256

    def quantised(self, rows: DataFrame) -> DataFrame:
        """(row, x): the input columns and the long vector of every row that takes part."""
        doubled = packed(rows, COMPUTED, x=F.transform(column(self.vector), lambda c: c.cast("double"))).where("x is not null")
        fine = ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
        whole = F.transform("x", lambda c: F.when(F.abs(c * self.scale) < RANGE, F.floor(c * self.scale)).otherwise(F.raise_error(F.lit("a quantised component of 2^40 or more: outside the range"))).cast("long"))
        return doubled.where(F.coalesce(fine, F.lit(False))).select("row", whole.alias("x"))

    def fit(self, rows: DataFrame) -> WhiteningModel:
        distinct = materialize(self.quantised(rows).select("x").distinct(), "distinct-vectors")
        n, width = distinct.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
        width = max(width, 0)
        # a vector filled up with zeros may equal another one
        if width and distinct.agg(F.min(F.size("x"))).first()[0] < width:
            filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
            distinct = materialize(distinct.select(filled.alias("x")).distinct(), "distinct-vectors")
            n = distinct.count()
        if not n or not width:
            return WhiteningModel(self, n, np.zeros(width, object), np.zeros(0), np.zeros((0, width)), 0.0, None)
        sums = self._sums(distinct, width)
        triangle = self._triangle(distinct, n, sums, width)
        values, vectors = right_singular(triangle, self.components)
        fitted = WhiteningModel(self, n, sums, values**2 / n, vectors, float((triangle**2).sum() / n), None)
        error = fitted.check(distinct)
        return WhiteningModel(self, n, sums, fitted.variances, vectors, fitted.total, error)

    def _sums(self, distinct: DataFrame, width: int) -> np.ndarray:
        """Exact sums per dimension, as Python numbers: ``width`` of them come to the driver."""

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width, object)
            for batch in batches:
                total += padded(batch.column("x"), width).sum(axis=0)  # |x| < 2**40 and far fewer than 2**23 rows a batch
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([str(t) for t in total])], names=["d", "total"])

        partial = distinct.mapInArrow(add, "d int, total string").groupBy("d").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        out = np.zeros(width, object)
        for r in partial.collect():
            out[r["d"]] = int(r["total"])
        return out

    def _triangle(self, distinct: DataFrame, n: int, sums: np.ndarray, width: int) -> np.ndarray:
        """R of the centred distinct vectors: R'R is n times their covariance."""
        shared = distinct.sparkSession.sparkContext.broadcast((n, sums))  # a number per dimension

        def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            r, waiting, rows = np.zeros((0, width)), [], 0
            for batch in batches:
                waiting.append(centred(padded(batch.column("x"), width), *shared.value))
                rows += batch.num_rows
                if rows >= 2 * width:
                    r, waiting, rows = np.linalg.qr(np.vstack([r, *waiting]), mode="r"), [], 0
            r = np.linalg.qr(np.vstack([r, *waiting]), mode="r")
            part = pa.array([TaskContext.get().partitionId()] * len(r), pa.int64())
            yield pa.RecordBatch.from_arrays([part, pa.array(list(r), pa.list_(pa.float64()))], names=["part", "r"])

        def stack(rows: pa.Table) -> pa.Table:
            r = np.linalg.qr(rows.column("r").combine_chunks().flatten().to_numpy().reshape(-1, width), mode="r")
            return pa.table({"part": pa.array([rows.column("part")[0].as_py()] * len(r), pa.int64()), "r": pa.array(list(r), pa.list_(pa.float64()))})

        schema = "part long, r array<double>"
        triangles = materialize(distinct.mapInArrow(block, schema), "triangles")
        parts = (triangles.agg(F.max("part")).first()[0] or 0) + 1
        while parts > 1:
            triangles = materialize(triangles.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("part").applyInArrow(stack, schema), "triangles")
            parts = -(-parts // FAN)
        r = np.array([row["r"] for row in triangles.collect()]).reshape(-1, width)  # one triangle
        return np.vstack([r, np.zeros((width - len(r), width))])


@dataclass(frozen=True)
class WhiteningModel:
    """Directions (one per row of ``vectors``) with their variances, the total variance, and the worst entry of the fit's check."""

    rules: Whitening
    n: int
    sums: np.ndarray = field(repr=False)
    variances: np.ndarray
    vectors: np.ndarray = field(repr=False)
    total: float
    identity_error: float | None

    @property
    def explained(self) -> list[float | None]:
        return [float(v / self.total) if self.total else None for v in self.variances]

    def transform(self, rows: DataFrame) -> DataFrame:
        """All rows that take part, all columns, with ``deviation`` and the array ``whitened``."""
        ready = self.rules.quantised(rows)
        schema = T.StructType([ready.schema["row"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
        shared = rows.sparkSession.sparkContext.broadcast(self)  # numbers per dimension and component

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                model = shared.value
                x = padded(batch.column("x"), len(model.sums))
                arrays = [batch.column("row"), pa.array(model.deviations(x), pa.int64()), pa.array(model.project(x), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", *COMPUTED])

        return unpacked(ready.mapInArrow(run, schema), COMPUTED)

    def project(self, x: np.ndarray) -> list[list[float | None]]:
        if not len(self.variances):
            return [[]] * len(x)
        with np.errstate(divide="ignore", invalid="ignore"):
            out = centred(x, self.n, self.sums) @ self.vectors.T / np.sqrt(self.variances)
        return [[float(v) if e else None for v, e in zip(row, self.variances, strict=True)] for row in out]

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sum)**2 in whole numbers, null where no long holds it."""
        n, sums = self.n, self.sums
        most = n * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0)
        if most**2 * max(len(sums), 1) < 1 << 63:
            return ((n * x - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
        found = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
        return [v if v < 1 << 63 else None for v in found]

    def check(self, distinct: DataFrame) -> float | None:
        """Largest entry of the covariance of the whitened fit vectors less the identity, over directions with variance."""
        k = int((self.variances > 0).sum())
        if not k:
            return None
        shared = distinct.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = shared.value.project(padded(batch.column("x"), len(shared.value.sums)))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.float64()) for j in range(k)], names=[f"w{j}" for j in range(k)])

        whitened = materialize(distinct.mapInArrow(run, ", ".join(f"w{j} double" for j in range(k))), "whitened")
        means = whitened.agg(*[F.avg(f"w{j}") for j in range(k)]).first()
        off = [F.col(f"w{j}") - F.lit(means[j]) for j in range(k)]
        entries = whitened.agg(*[F.avg(off[i] * off[j]) for i in range(k) for j in range(i + 1)]).first()
        return max(abs(v - (i == j)) for v, (i, j) in zip(entries, [(i, j) for i in range(k) for j in range(i + 1)], strict=True))


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x less the mean: the whole part of the mean is taken off in whole numbers, so that no digits of x get lost."""
    whole = np.array([int(s) // n for s in sums], np.int64)
    rest = np.array([int(s) % n / n for s in sums])
    return (x - whole).astype(float) - rest


def right_singular(triangle: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values, falling, zeros where a value is rounding only, and their unit right vectors as rows; of each vector the largest entry is positive."""
    width = triangle.shape[1]
    scale = np.abs(triangle).max(initial=0.0)
    if not scale:
        return np.zeros(min(most, width)), np.eye(width)[:most]
    diagonal, above, reflectors = bidiagonal(triangle / scale)
    squares = sorted(qd_values(diagonal**2, above**2), reverse=True)
    found: list[np.ndarray] = []
    for square in squares[:most]:
        found.append(twisted(diagonal, above, square, found))
    vectors = np.array(found).T
    for k, v in reversed(reflectors):
        vectors[k:] -= 2 * np.outer(v, v @ vectors[k:])
    vectors = vectors.T
    vectors *= np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])[:, None]
    values = np.sqrt(np.array(squares[:most]))
    values[values <= values[0] * 4 * width * EPS] = 0.0
    return values * scale, vectors


def bidiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal and superdiagonal of an upper bidiagonal matrix, and the reflections from the right that lead there."""
    a = a.copy()
    width = len(a)
    right = []
    for k in range(width):
        v = reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        v = reflector(a[k, k + 1 :])
        if v is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            right.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit vector whose reflection takes x to its first axis; none where x lies there."""
    if len(x) < 2 or not np.abs(x[1:]).max():
        return None
    v = x / np.abs(x).max()
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def qd_values(q, e) -> list[float]:
    """Squared singular values of a bidiagonal matrix with squared diagonal ``q`` and superdiagonal ``e``: differential qd with shifts."""
    tiny = EPS * EPS
    out: list[float] = []
    windows = [([float(v) for v in q], [float(v) for v in e], 0.0)]
    while windows:
        q, e, shifted = windows.pop()
        while len(q) > 1:
            if e[-1] <= tiny * (shifted + q[-1]):
                out.append(shifted + q.pop())
                e.pop()
                continue
            split = next((k for k in range(len(e) - 1) if e[k] <= tiny * (shifted + q[k])), None)
            if split is not None:
                windows.append((q[: split + 1], e[:split], shifted))
                q, e = q[split + 1 :], e[split + 1 :]
                continue
            if q[0] * 1.5 < q[-1]:  # graded the wrong way round
                q, e = q[::-1], e[::-1]
            # least eigenvalue of the last two rows: nearly the least of all once the last superdiagonal is small
            a, b, c = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
            half = (a + b) / 2
            root = np.sqrt(((a - b) / 2) ** 2 + c)
            shift = max((a * b - c) / (half + root), 0.0) if half + root else 0.0
            for _ in range(6):
                step = transformed(q, e, shift)
                if step[0]:
                    break
                # too far; if only the last entry says so, it also says by how much
                shift = max(shift + step[3], 0.0) * (1 - 8 * EPS) if step[4] else shift / 4
            else:
                shift = 0.0
                step = transformed(q, e, 0.0)
            q, e, shifted = step[1], step[2], shifted + shift
        out.append(shifted + q[0])
    return out


def transformed(q: list[float], e: list[float], shift: float) -> tuple[bool, list[float], list[float], float, bool]:
    """One differential qd step: whether all stayed non-negative, the new arrays, the last remainder, and whether only that is negative."""
    new_q, new_e = [], []
    d = q[0] - shift
    for k in range(len(e)):
        if d < 0:
            return False, new_q, new_e, d, False
        total = d + e[k]
        new_q.append(total)
        if total:
            ratio = q[k + 1] / total
            new_e.append(e[k] * ratio)
            d = d * ratio - shift
        else:
            new_e.append(0.0)
            d = q[k + 1] - shift
    new_q.append(d)
    return d >= 0, new_q, new_e, d, True


def twisted(diagonal: np.ndarray, above: np.ndarray, square: float, earlier: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of B'B for an eigenvalue, orthogonal to the earlier ones, from twisted factorisations of B'B - square."""
    n = len(diagonal)
    top = float((diagonal**2).max() + (above**2).max(initial=0.0))
    floor = EPS * np.sqrt(top)
    a = np.where(np.abs(diagonal) < floor, floor, diagonal)
    above = np.where(np.abs(above) < floor, 0.0, above)  # the matrix falls apart there
    for _ in range(3):
        low, high, remainder = factors(a, above, square, top)
        best, kept, moved = None, -1.0, 0.0
        for r in np.argsort(np.abs(remainder), kind="stable"):
            z = np.zeros(n)
            z[r] = 1.0
            for i in range(r - 1, -1, -1):
                z[i] = -low[i] * z[i + 1]
            for i in range(r, n - 1):
                z[i + 1] = -high[i] * z[i]
            size = np.linalg.norm(z)
            if not np.isfinite(size):
                continue
            # of tied values, a twist elsewhere gives another vector: take the first that is not one of the earlier ones
            rest = z / size
            for other in [*earlier, *earlier]:
                rest -= (other @ rest) * other
            left = np.linalg.norm(rest)
            if left > kept:
                best, kept, moved = rest / left if left else z / size, left, remainder[r] / size**2
            if kept > 0.5:
                break
        if abs(moved) <= 4 * EPS * top:
            break
        square += moved  # the Rayleigh quotient of the vector
    return best


def factors(a: np.ndarray, b: np.ndarray, square: float, top: float) -> tuple[list[float], list[float], list[float]]:
    """Multipliers of the factorisation from above and of that from below, and the remainder where both meet, for each row."""
    n, least = len(a), EPS * EPS * top
    away = lambda p: p if abs(p) > least else (-least if p < 0 else least)
    low, high, s, p = [0.0] * (n - 1), [0.0] * (n - 1), [0.0] * n, [0.0] * n
    s[0] = -square
    for i in range(n - 1):
        pivot = away(s[i] + a[i] ** 2)
        low[i] = a[i] * b[i] / pivot
        s[i + 1] = low[i] * (b[i] / a[i]) * s[i] - square
    p[-1] = a[-1] ** 2 - square
    for i in range(n - 2, -1, -1):
        if not b[i]:
            p[i] = a[i] ** 2 - square
            continue
        pivot = away(b[i] ** 2 + p[i + 1])
        high[i] = a[i] * b[i] / pivot
        p[i] = p[i + 1] * (a[i] ** 2 / pivot) - square
    return low, high, [s[i] + p[i] + square for i in range(n)]
