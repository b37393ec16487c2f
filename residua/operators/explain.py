"""Which features made a row anomalous: reconstruction errors per feature and expected gradients."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from residua.functions.materialize import materialize
from residua.operators import dense_net as net
from residua.operators.autoencoder import AutoencoderModel
from residua.operators.encode import EncoderModel
from residua.operators.reconstruct import MeanModel, ReconstructionModel, compact_arrays, densify
from residua.operators.results import KEY, SCORE, top_anomalies

# How many rows are explained, background size and its seed.
EXPLAINED_ROWS, BACKGROUND_ROWS, SEED = 10, 50, 42
#: Background rows that an explained row meets in one task, and dimensions of a partial sum that travel as one row.
BLOCK, PIECE = 16, 65_536


def feature_errors(model: ReconstructionModel, flagged: DataFrame, names: list[str], top_n: int, key: str = KEY) -> DataFrame:
    """(key, rank, feature, error): the largest squared errors of every given row.

    The ranking happens inside the row's own array, so no window and no shuffle is needed.
    """
    with_errors = model.with_dimension_errors(flagged, "_errors")
    name_array = F.array(*[F.lit(n) for n in names])
    entries = F.transform(
        "_errors", lambda e, i: F.struct((-e).alias("_neg"), F.get(name_array, i).alias("feature"), e.alias("error"))
    )
    top = F.slice(F.array_sort(entries), 1, top_n)
    return with_errors.select(key, F.posexplode(top).alias("_p", "_e")).select(
        key, (F.col("_p") + 1).alias("rank"), F.col("_e.feature").alias("feature"), F.col("_e.error").alias("error")
    )


def separable_attributions(model: MeanModel, explained: DataFrame, background: DataFrame, key: str = KEY) -> DataFrame:
    """(key, feature, phi) for a model whose score is a sum over features.

    The expected gradient of a separable score is exact: the feature's own error minus its mean error over the
    background, divided by the width.
    """
    errors = model.feature_errors()
    slotted = model.encoder.with_slots(background)
    mean_row = slotted.agg(*[F.avg(e).alias(f"_m{i}") for i, e in enumerate(errors.values())]).first()
    width = float(model.encoder.width)
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), ((e - F.lit(mean_row[i])) / F.lit(width)).alias("phi"))
            for i, (c, e) in enumerate(errors.items())
        ]
    )
    return model.encoder.with_slots(explained).select(key, F.inline(entries))


def background_sample(rows: DataFrame, n: int, key: str = KEY, seed: int = SEED) -> DataFrame:
    """``n`` rows drawn with replacement.

    Which of ``n`` draws coincide is decided by seeded integers; the distinct draws are the rows with the lowest
    hashes. This has the law of drawing row numbers, without numbering rows.
    """
    available = rows.count()
    if available == 0:
        raise ValueError("no rows to draw a background from")
    draws = np.random.default_rng(seed).integers(0, available, size=min(n, available))
    multiplicity = np.unique(draws, return_counts=True)[1]
    order = F.xxhash64(F.lit(seed), F.col(key))
    picked = rows.orderBy(order, key).limit(len(multiplicity))
    numbered = [(r, int(m)) for r, m in zip(picked.collect(), multiplicity, strict=True)]
    return rows.sparkSession.createDataFrame([r for r, m in numbered for _ in range(m)], rows.schema)


def expected_gradients(
    model: AutoencoderModel,
    scored: DataFrame,
    background: DataFrame,
    n_explain: int = EXPLAINED_ROWS,
    steps: int = 8,
    key: str = KEY,
    seed: int = SEED,
) -> DataFrame:
    """(key, mse_score, phi): attribution of a row's error to every encoded dimension.

    Explains the flagged rows with the highest scores. Gradients are averaged along seeded points between the row and each background
    row. Every explained row meets blocks of ``BLOCK`` background rows, a task's work each, whose partial sums are added up per
    record and piece of the vector; a task holds a few points of a block at a time, so neither rows nor background nor steps
    grow what it keeps. Points are drawn by the number of the background row, so any dealing gives the same sums.
    """
    encoder = model.encoder
    n_num, n_cat, width = len(encoder.numeric), len(encoder.categorical), encoder.width
    shared = scored.sparkSession.sparkContext.broadcast((model.trained, model.running))
    explained = encoder.transform(top_anomalies(scored, n_explain, flagged_only=True, key=key))
    explained = materialize(explained.select(F.col(key).alias("_key"), F.col(SCORE).alias("_score"), "enc_num", "enc_cat"), "explained")
    # the background is numbered in the order of its own content
    order = Window.orderBy(F.xxhash64("enc_num", "enc_cat"), "enc_num", "enc_cat")
    numbered = encoder.transform(background).select("enc_num", "enc_cat").withColumn("_at", F.row_number().over(order) - 1)
    reference = numbered.groupBy(F.floor(F.col("_at") / BLOCK).alias("_block")).agg(
        F.min("_at").alias("_first"), F.sort_array(F.collect_list(F.struct("_at", "enc_num", "enc_cat"))).alias("_rows")
    )
    reference = materialize(reference.select("_block", "_first", F.col("_rows.enc_num").alias("_num"), F.col("_rows.enc_cat").alias("_cat")), "background")
    blocks, rows = reference.agg(F.count(F.lit(1)), F.sum(F.size("_num"))).first()
    if not blocks:
        raise ValueError("no background rows")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_block")
    pairs = explained.select("*", every).join(F.broadcast(reference), "_block")  # a row per explained row and block
    pairs = pairs.repartition(max(1, min(n_explain * blocks, 4096)), "_key", "_block")
    kind = explained.schema["_key"].dataType.simpleString()

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained, running = shared.value
        for batch in batches:
            x = densify(*compact_arrays(batch.column("enc_num"), batch.column("enc_cat"), n_num, n_cat), width)
            for i in range(batch.num_rows):
                num, cat = batch.column("_num")[i].values, batch.column("_cat")[i].values
                base = densify(*compact_arrays(num, cat, n_num, n_cat), width)
                total = np.zeros(width)
                for j, b in enumerate(base):
                    at = batch.column("_first")[i].as_py() + j
                    alpha = (np.arange(steps) + np.random.default_rng([seed, at]).random(steps)) / steps
                    delta = x[i] - b
                    _, grad = net.mse_input_gradient(trained, running, b + alpha[:, None] * delta)
                    total += grad.mean(axis=0) * delta
                starts = range(0, width, PIECE)
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(batch.column("_key").slice(i, 1).to_pylist() * n, batch.column("_key").type),
                        pa.array(batch.column("_score").slice(i, 1).to_pylist() * n, pa.float64()),
                        pa.array(range(n), pa.int32()),
                        batch.column("_block").take(pa.array([i] * n)),
                        pa.array([total[k : k + PIECE] / rows for k in starts], pa.list_(pa.float64())),
                    ],
                    names=["_key", "_score", "_piece", "_block", "_phi"],
                )

    def add(group: pa.Table) -> pa.Table:
        ordered = group.sort_by("_block")
        total = sum(v.values.to_numpy() for v in ordered["_phi"])
        return ordered.slice(0, 1).set_column(4, "_phi", pa.array([total], pa.list_(pa.float64())))

    schema = f"_key {kind}, _score double, _piece int, _block long, _phi array<double>"
    parts = pairs.mapInArrow(attribute, schema).groupBy("_key", "_piece").applyInArrow(add, schema)
    pieces = F.sort_array(F.collect_list(F.struct("_piece", "_phi")))
    whole = parts.groupBy("_key", "_score").agg(F.flatten(F.transform(pieces, lambda p: p["_phi"])).alias("phi"))
    return whole.select(F.col("_key").alias(key), F.col("_score").alias(SCORE), "phi")


def base_value(model: ReconstructionModel, background: DataFrame) -> DataFrame:
    """Mean score of the background, of a reconstruction model or a fitted detector."""
    return model.with_score(background).agg(F.avg(SCORE).alias("base_value"))


def aggregate_attributions(attributions: DataFrame, encoder: EncoderModel | dict[str, list[int]], key: str = KEY) -> DataFrame:
    """Sum encoded dimensions back to original columns: (key, feature, phi), by an encoder or its feature groups. Blocks are contiguous slices."""
    entries = []
    for feature, indices in (encoder if isinstance(encoder, dict) else encoder.feature_groups()).items():
        block = F.slice("phi", indices[0] + 1, len(indices)) if indices else F.array().cast("array<double>")
        entries.append(
            F.struct(F.lit(feature).alias("feature"), F.aggregate(block, F.lit(0.0), lambda a, v: a + v).alias("phi"))
        )
    return attributions.select(key, F.inline(F.array(*entries)))


def global_importance(attributions: DataFrame, top_n: int = 20) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    return (
        attributions.groupBy("feature")
        .agg(F.avg(F.abs("phi")).alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
        .limit(top_n)
    )


def row_waterfall(attributions: DataFrame, key_value, top_n: int = 15, key: str = KEY) -> DataFrame:
    """One record's contributions by absolute size, with a signed label."""
    text = F.when(F.col("phi") > 0, F.format_string("+%.5f", "phi")).otherwise(F.format_string("%.5f", "phi"))
    one = attributions.filter(F.col(key) == key_value)
    return one.orderBy(F.abs("phi").desc(), "feature").limit(top_n).select("feature", "phi", text.alias("text"))


def attribution_table(
    attributions: DataFrame, scored: DataFrame, features: tuple[str, ...], key: str = KEY, label: str = "label"
) -> DataFrame:
    """One row per explained record: label, score and one column per feature."""
    wide = attributions.groupBy(key).pivot("feature", list(features)).agg(F.first("phi"))
    return scored.select(key, label, SCORE).join(wide, key, "inner").select(label, SCORE, key, *features)
