"""Reconstruction models: score a row by the mean squared difference to its reconstruction.

A model is anything with ``with_score`` and ``dimension_errors``; an estimator is anything with ``fit``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residua.functions.columns import no_nan, total
from residua.functions.materialize import materialize, spread_small
from residua.operators.dense_net import slot_sums
from residua.operators.encode import EncoderModel

#: Widest encoder whose network weights one task and the driver hold, some 1 kB a dimension and state.
MAX_WEIGHTS_WIDTH = 250_000
#: Widest encoder PCA accepts: the driver holds a few dozen vectors of this length.
MAX_PCA_WIDTH = 2_000_000
#: Encoders wider than this are scored without writing out their one-hot part.
DENSE_WIDTH = 2_048
#: Numbers of the search space that PCA keeps on the driver, and its least and most columns in blocks.
SPACE = 1 << 26
#: Numbers of a block of sums that travel as one row.
CHUNK = 65_536


class ReconstructionModel(Protocol):
    encoder: EncoderModel

    def with_score(self, df: DataFrame, name: str = "mse_score") -> DataFrame: ...

    def with_dimension_errors(self, df: DataFrame, name: str = "errors") -> DataFrame: ...


class Reconstructor(Protocol):
    def fit(self, train: DataFrame, validation: DataFrame, encoder: EncoderModel) -> ReconstructionModel: ...


def reconstruction_mse(x: Column, x_hat: Column) -> Column:
    """Mean squared difference of two equally long arrays."""
    squared = F.zip_with(x, x_hat, lambda a, b: (a - b) * (a - b))
    return F.aggregate(squared, F.lit(0.0), lambda acc, e: acc + e) / F.size(x)


def compact_arrays(num: pa.Array, cat: pa.Array, n_num: int, n_cat: int) -> tuple[np.ndarray, np.ndarray]:
    """Arrow list columns as two matrices, without a Python object per row."""
    rows = len(num)
    z = num.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, n_num)
    c = cat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, n_cat)
    return z, c


def densify(z: np.ndarray, cat: np.ndarray, width: int) -> np.ndarray:
    x = np.zeros((len(z), width))
    x[:, : z.shape[1]] = z
    for column in cat.T:
        seen = np.flatnonzero(column >= 0)
        x[seen, column[seen]] = 1.0
    return x


def require_weights(encoder: EncoderModel, purpose: str, most: int = MAX_WEIGHTS_WIDTH) -> None:
    if encoder.width > most:
        raise ValueError(
            f"{purpose} keeps weights per encoded dimension and {encoder.width} is too wide; "
            "drop or coarsen high-cardinality columns, or use the mean reconstructor"
        )


def complete_rows(encoded: DataFrame) -> DataFrame:
    """Rows without a missing number: what models with weights are fitted on. Others get no score."""
    return encoded.filter(~F.exists("enc_num", lambda z: z.isNull() | F.isnan(z)))


def _block_errors(shares: Column, slot: Column) -> Column:
    """Squared difference of a one-hot block to its training shares."""
    return F.transform(shares, lambda p, k: F.pow(F.when(k == slot, 1.0).otherwise(0.0) - p, F.lit(2.0)))


@dataclass(frozen=True)
class MeanModel:
    """Every dimension is reconstructed by its benign training mean.

    The mean of a standard score is 0 and the mean of a one-hot slot is the training share p of its
    value, so a categorical block costs ``1 - 2 p + sum p^2`` for a seen value and ``sum p^2`` otherwise.
    """

    encoder: EncoderModel

    def feature_errors(self) -> dict[str, Column]:
        """Squared error per original column, over a row that carries its slots."""
        e = self.encoder
        errors = {c: z * z for c, z in zip(e.numeric, e.scaled(), strict=True)}
        for i, (c, sq) in enumerate(zip(e.categorical, e.sum_share_sq, strict=True)):
            share = F.col(f"_share_{i}")
            errors[c] = F.when(share.isNull(), F.lit(sq)).otherwise(F.lit(1.0) - F.lit(2.0) * share + F.lit(sq))
        return errors

    def with_score(self, df: DataFrame, name: str = "mse_score") -> DataFrame:
        slotted = self.encoder.with_slots(df)
        mse = total(list(self.feature_errors().values())) / F.lit(float(self.encoder.width))
        return self.encoder.drop_slots(slotted.withColumn(name, mse))

    def with_dimension_errors(self, df: DataFrame, name: str = "errors") -> DataFrame:
        e = self.encoder
        e._require_collected("the error of every dimension")
        slotted = e.with_slots(df)
        parts = [F.array(*[z * z for z in e.scaled()])] if e.numeric else []
        for i, values in enumerate(e.categories):
            shares = F.array(*[F.lit(p) for _, p in values])
            parts.append(_block_errors(shares, F.coalesce(F.col(f"_slot_{i}"), F.lit(-1))))
        return e.drop_slots(slotted.withColumn(name, F.concat(*parts)))

    def with_feature_errors(self, df: DataFrame, name: str = "feature_errors") -> DataFrame:
        """Array of (feature, error), one entry per original column."""
        slotted = self.encoder.with_slots(df)
        entries = [F.struct(F.lit(c).alias("feature"), e.alias("error")) for c, e in self.feature_errors().items()]
        return self.encoder.drop_slots(slotted.withColumn(name, F.array(*entries)))


@dataclass(frozen=True)
class MeanReconstructor:
    def fit(self, train: DataFrame, validation: DataFrame, encoder: EncoderModel) -> MeanModel:
        return MeanModel(encoder)


class NumpyModel:
    """Base of models whose reconstruction runs in NumPy on Arrow batches with broadcast weights.

    Subclasses give ``reconstruct(weights, z, cat)`` for full rows and ``wide_errors(weights, z, cat)`` for the errors summed over
    a row without its one-hot part written out, as static functions; weights are bounded by ``require_weights`` at fit time.
    """

    encoder: EncoderModel

    def weights(self) -> dict[str, np.ndarray]:
        raise NotImplementedError

    @staticmethod
    def reconstruct(weights: dict[str, np.ndarray], z: np.ndarray, cat: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    @staticmethod
    def wide_errors(weights: dict[str, np.ndarray], z: np.ndarray, cat: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def _row_errors(self, spark, dense_width: int = DENSE_WIDTH):
        """Mean squared error per row of Arrow columns."""
        if self.encoder.width <= dense_width:
            squared = self._squared_errors(spark)
            return lambda num, cat: squared(num, cat).mean(axis=1)
        shared = spark.sparkContext.broadcast(self.weights())
        n_num, n_cat, width = len(self.encoder.numeric), len(self.encoder.categorical), self.encoder.width
        errors = type(self).wide_errors

        def mean_errors(num: pa.Array, cat: pa.Array) -> np.ndarray:
            return errors(shared.value, *compact_arrays(num, cat, n_num, n_cat)) / width

        return mean_errors

    def _squared_errors(self, spark):
        shared = spark.sparkContext.broadcast(self.weights())
        n_num, n_cat, width = len(self.encoder.numeric), len(self.encoder.categorical), self.encoder.width
        reconstruct = type(self).reconstruct

        def squared(num: pa.Array, cat: pa.Array) -> np.ndarray:
            z, c = compact_arrays(num, cat, n_num, n_cat)
            return np.square(densify(z, c, width) - reconstruct(shared.value, z, c))

        return squared

    def with_score(self, df: DataFrame, name: str = "mse_score", dense_width: int = DENSE_WIDTH) -> DataFrame:
        errors = self._row_errors(df.sparkSession, dense_width)

        @F.arrow_udf("double")
        def score(num: pa.Array, cat: pa.Array) -> pa.Array:
            return pa.array(errors(num, cat))

        scored = self.encoder.transform(spread_small(df)).withColumn(name, no_nan(score("enc_num", "enc_cat")))
        return scored.drop("enc_num", "enc_cat")

    def with_dimension_errors(self, df: DataFrame, name: str = "errors") -> DataFrame:
        squared = self._squared_errors(df.sparkSession)

        @F.arrow_udf("array<double>")
        def errors(num: pa.Array, cat: pa.Array) -> pa.Array:
            e = squared(num, cat)
            starts = np.arange(0, e.size + 1, e.shape[1], dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(starts), pa.array(e.ravel()))

        return self.encoder.transform(df).withColumn(name, errors("enc_num", "enc_cat")).drop("enc_num", "enc_cat")


@dataclass(frozen=True)
class PCAModel(NumpyModel):
    """Linear autoencoder: project on the leading components around the training mean and back."""

    encoder: EncoderModel
    components: np.ndarray
    center: np.ndarray

    def weights(self) -> dict[str, np.ndarray]:
        return {"components": self.components, "center": self.center}

    @staticmethod
    def code(weights: dict[str, np.ndarray], z: np.ndarray, cat: np.ndarray) -> np.ndarray:
        """Coordinates along the components; a row of the components is gathered per category."""
        components, center = weights["components"], weights["center"]
        code = z @ components[: z.shape[1]] - center @ components
        for column in cat.T:
            seen = column >= 0
            code[seen] += components[column[seen]]
        return code

    @staticmethod
    def reconstruct(weights: dict[str, np.ndarray], z: np.ndarray, cat: np.ndarray) -> np.ndarray:
        return PCAModel.code(weights, z, cat) @ weights["components"].T + weights["center"]

    @staticmethod
    def wide_errors(weights: dict[str, np.ndarray], z: np.ndarray, cat: np.ndarray) -> np.ndarray:
        """Components are orthonormal: what they leave of the centred row is its length less that of its coordinates."""
        center = weights["center"]
        n_num = z.shape[1]
        length = np.square(z - center[:n_num]).sum(axis=1) + np.square(center[n_num:]).sum()
        for column in cat.T:
            seen = np.flatnonzero(column >= 0)
            length[seen] += 1.0 - 2.0 * center[column[seen]]
        left = length - np.square(PCAModel.code(weights, z, cat)).sum(axis=1)
        return np.where(left < 0, 0.0, left)


@dataclass(frozen=True)
class PCAReconstructor:
    """Leading directions of the benign training rows, by a block method that only ever multiplies the rows with a few vectors.

    ``k`` defaults to the bottleneck width of the autoencoder. Each pass over the compact rows returns one sum of width x block
    numbers (rows times their coordinates), merged on the executors; the search space grows by a block of residuals a pass, is cut back to
    the leading directions when it is full, and is done when all residuals are within ``tolerance`` of the largest variance. Neither a
    row nor a width x width matrix is ever written out. Rows with a missing number are left out of the fit.
    """

    k: int = 16
    tolerance: float = 1e-9
    max_passes: int = 300
    seed: int = 42

    def fit(self, train: DataFrame, validation: DataFrame, encoder: EncoderModel) -> PCAModel:
        require_weights(encoder, "PCA", MAX_PCA_WIDTH)
        rows = materialize(complete_rows(encoder.transform(train)).select("enc_num", "enc_cat"), "pca-rows")
        n = rows.count()
        if not n:
            raise ValueError("no benign training row without a missing number")
        center = encoder.center()
        width, k = encoder.width, min(self.k, encoder.width)
        block = min(k + 8, width)
        most = min(width, max(3 * block, min(12 * block, SPACE // width)))
        mean = _row_sums(rows, width, None, np.zeros(1))[0][:, 0] / n  # of the complete rows alone
        product = lambda q: _covariance_times(rows, n, mean, q)
        return PCAModel(encoder, leading_directions(product, width, k, block, most, self.tolerance, self.max_passes, self.seed), center)


def leading_directions(product, width: int, k: int, block: int, most: int, tolerance: float, passes: int, seed: int) -> np.ndarray:
    """The ``k`` leading eigenvectors, as columns, of a symmetric matrix known by its ``product`` with a block of vectors.

    ``space`` is an orthonormal basis that grows by what the matrix does to it, ``image`` its product; the best vectors inside it
    come from a small eigenproblem.
    """
    new = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, block)))[0]
    space, image = np.zeros((width, 0)), np.zeros((width, 0))
    for _ in range(passes):
        space, image = np.hstack([space, new]), np.hstack([image, product(new)])
        small = space.T @ image
        values, inner = np.linalg.eigh((small + small.T) / 2)
        values, inner = values[::-1], inner[:, ::-1]
        lead = inner[:, : min(block, inner.shape[1])]
        vectors, images = space @ lead, image @ lead
        residual = images - vectors * values[: lead.shape[1]]
        wrong = np.linalg.norm(residual[:, :k], axis=0) > tolerance * max(values[0], 1e-300)
        if not wrong.any() or space.shape[1] == width:
            break
        if space.shape[1] + block > most:
            kept = inner[:, : min(2 * block, inner.shape[1])]
            space, image = space @ kept, image @ kept
        new = _beside(space, residual, width)
        if not new.shape[1]:
            break
    return vectors[:, :k]


def _beside(space: np.ndarray, candidates: np.ndarray, width: int) -> np.ndarray:
    """An orthonormal basis of what the candidates add to the space, at most as much as there is room."""
    for _ in range(2):
        candidates = candidates - space @ (space.T @ candidates)
    q, r = np.linalg.qr(candidates)
    size = np.abs(np.diag(r))
    q = q[:, size > 1e-13 * max(size.max(initial=0.0), 1e-300)]
    q = q - space @ (space.T @ q)
    q = np.linalg.qr(q)[0] if q.shape[1] else q
    return q[:, : width - space.shape[1]]


def _covariance_times(rows: DataFrame, n: int, mean: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Covariance of the encoded rows times ``q``."""
    total, codes = _row_sums(rows, len(mean), q, mean @ q)
    return (total - np.outer(mean, codes)) / n


def _row_sums(rows: DataFrame, width: int, q: np.ndarray | None, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of rows times their coordinates, and of the coordinates: along ``q`` less ``offset``, or 1 for every row."""
    shared = rows.sparkSession.sparkContext.broadcast((q, offset))
    columns = len(offset)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, off = shared.value
        total, codes, seen = np.zeros((width, columns)), np.zeros(columns), 0
        for batch in batches:
            num, cat = batch.column("enc_num"), batch.column("enc_cat")
            if not len(num):
                continue
            # the encoder gives every row as many numbers and slots as every other
            z, slots = compact_arrays(num, cat, len(num[0]), len(cat[0]))
            code = np.ones((len(z), 1)) if factors is None else z @ factors[: z.shape[1]] - off
            for column in slots.T if factors is not None else ():
                there = column >= 0
                code[there] += factors[column[there]]
            total[: z.shape[1]] += z.T @ code
            for column in slots.T:
                slot, sums = slot_sums(column, code)
                total[slot] += sums
            codes += code.sum(axis=0)
            seen += len(code)
        if seen:
            flat = np.concatenate([total.ravel(), codes])
            pieces = [flat[at : at + CHUNK].tobytes() for at in range(0, len(flat), CHUNK)]
            task = pa.array([TaskContext.get().partitionId()] * len(pieces), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), task, pa.array(pieces, pa.binary())], names=["chunk", "at", "sums"])

    try:
        partial = rows.mapInArrow(run, _SUMS)
        for branch in (F.floor(F.col("at") / 64), F.lit(0).cast("long")):
            partial = partial.withColumn("branch", branch).groupBy("chunk", "branch").applyInArrow(_added, _SUMS)
        found = partial.toArrow().sort_by("chunk")
    finally:
        shared.destroy()
    flat = np.concatenate([np.frombuffer(s, float) for s in found["sums"].to_pylist()])
    return flat[: width * columns].reshape(width, columns), flat[width * columns :]


_SUMS = "chunk int, at long, sums binary"


def _added(group: pa.Table) -> pa.Table:
    """The sum of the chunks of a group, in the order of their tasks."""
    ordered = group.sort_by("at")
    total = sum(np.frombuffer(s.as_buffer(), float) for s in ordered["sums"].combine_chunks())
    return pa.table({"chunk": ordered["chunk"].slice(0, 1), "at": ordered["at"].slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})
