"""Saving and loading fitted detectors: JSON parameters and Parquet tables, nothing pickled."""

from __future__ import annotations

import dataclasses
import json

import numpy as np
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import DataFrame, SparkSession

from residua.operators.autoencoder import AutoencoderModel
from residua.operators.encode import EncoderModel
from residua.operators.reconstruct import MeanModel, PCAModel
from residua.operators.split import SplitModel
from residua.plans.detection import DetectorModel
from residua.roles import Roles

_ARRAYS = "name string, shape array<int>, position int, chunk array<double>"
CHUNK = 65_536


class DetectorWriter(MLWriter):
    """Spark ML's metadata beside the detector's own tables, so that pipelines find the class again."""

    def __init__(self, detector: DetectorModel) -> None:
        super().__init__()
        self.detector = detector

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.detector, path, self.sparkSession)
        save_detector(self.sparkSession, self.detector, f"{path}/detector")


class DetectorReader(MLReader):
    def load(self, path: str) -> DetectorModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        detector = load_detector(self.sparkSession, f"{path}/detector")
        detector._resetUid(metadata["uid"])
        return detector


def save_detector(spark: SparkSession, detector: DetectorModel, path: str, mode: str = "errorifexists") -> None:
    encoder, split, model = detector.encoder, detector.split_model, detector.model
    params = {
        "roles": dataclasses.asdict(detector.roles),
        "threshold": detector.threshold,
        "score_places": detector.score_places,
        "model": type(model).__name__,
        "wide": encoder.vocabulary is not None,
        "encoder": {f: getattr(encoder, f) for f in ("numeric", "categorical", "means", "scales", "widths", "sum_share_sq")},
        "split": {f: getattr(split, f) for f in ("label", "key", "seed", "cuts", "table_rows")},
    }
    spark.createDataFrame([(json.dumps(params),)], "value string").coalesce(1).write.mode(mode).text(f"{path}/params")
    vocabulary = encoder.vocabulary
    if vocabulary is None:
        rows = [
            (c, v, i, p)
            for c, values in zip(encoder.categorical, encoder.categories, strict=True)
            for i, (v, p) in enumerate(values)
        ]
        vocabulary = spark.createDataFrame(rows, "feature string, value string, slot int, share double")
    vocabulary.write.mode(mode).parquet(f"{path}/vocabulary")
    if split.table is not None:
        split.table.write.mode(mode).parquet(f"{path}/split")
    _array_rows(spark, _arrays(model)).write.mode(mode).parquet(f"{path}/arrays")


def load_detector(spark: SparkSession, path: str) -> DetectorModel:
    params = json.loads(spark.read.text(f"{path}/params").first()["value"])
    roles = {k: tuple(v) if isinstance(v, list) else v for k, v in params["roles"].items()}
    e, s = params["encoder"], params["split"]
    vocabulary = spark.read.parquet(f"{path}/vocabulary")
    wide = params["wide"]
    categories = None
    if not wide:
        found = vocabulary.orderBy("slot").collect()
        categories = tuple(tuple((r["value"], r["share"]) for r in found if r["feature"] == c) for c in e["categorical"])
    encoder = EncoderModel(**{k: tuple(v) for k, v in e.items()}, categories=categories, vocabulary=vocabulary if wide else None)
    cuts = None if s["cuts"] is None else tuple(tuple(c) for c in s["cuts"])
    table = None if cuts is not None else spark.read.parquet(f"{path}/split")
    split = SplitModel(s["label"], s["key"], s["seed"], cuts, table, s["table_rows"])
    arrays = _read_arrays(spark.read.schema(_ARRAYS).parquet(f"{path}/arrays"))
    model = _model(params["model"], encoder, arrays)
    return DetectorModel(Roles(**roles), split, encoder, model, params["threshold"], params["score_places"])


def _arrays(model) -> dict[str, np.ndarray]:
    if isinstance(model, PCAModel):
        return model.weights()
    if isinstance(model, AutoencoderModel):
        return {f"{group}.{n}": a for group, arrays in model.weights().items() for n, a in arrays.items()}
    return {}


def _model(kind: str, encoder: EncoderModel, arrays: dict[str, np.ndarray]):
    if kind == "MeanModel":
        return MeanModel(encoder)
    if kind == "PCAModel":
        return PCAModel(encoder, arrays["components"], arrays["center"])
    if kind == "AutoencoderModel":
        groups = {"trained": {}, "running": {}}
        for name, a in arrays.items():
            group, _, parameter = name.partition(".")
            groups[group][parameter] = a
        return AutoencoderModel(encoder, groups["trained"], groups["running"])
    raise ValueError(f"unknown model {kind!r}")


def _array_rows(spark: SparkSession, arrays: dict[str, np.ndarray]) -> DataFrame:
    rows = []
    for name, a in arrays.items():
        flat = a.ravel()
        for position, at in enumerate(range(0, len(flat), CHUNK)):
            rows.append((name, list(a.shape), position, flat[at : at + CHUNK].tolist()))
    return spark.createDataFrame(rows, _ARRAYS)


def _read_arrays(df: DataFrame) -> dict[str, np.ndarray]:
    parts: dict[str, list] = {}
    for r in df.orderBy("name", "position").collect():
        parts.setdefault(r["name"], [r["shape"], []])[1].append(np.array(r["chunk"]))
    return {n: np.concatenate(chunks).reshape(shape) for n, (shape, chunks) in parts.items()}
