"""Fit a detector on benign training rows, score any table with it, evaluate it on held-out rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions.columns import half_even, is_malicious
from residua.functions.materialize import materialize
from residua.operators.compare import model_comparison
from residua.operators.confusion import full_report
from residua.operators.encode import EncoderModel, FeatureEncoder
from residua.operators.forest import IsolationForest
from residua.operators.labels import benign_rows, require_columns, with_flag
from residua.operators.reconstruct import MeanReconstructor, ReconstructionModel, Reconstructor
from residua.operators.split import SplitModel, StratifiedSplit
from residua.operators.thresholds import THRESHOLD_PERCENTILE, fit_threshold, per_class_detection, threshold_sweep
from residua.roles import Roles


def active_threshold(saved: float, override: float | None = None) -> float:
    """An override counts only when it is finite and positive."""
    usable = override is not None and math.isfinite(override) and override > 0
    return float(override) if usable else float(saved)


def validate_for_scoring(df: DataFrame, features: tuple[str, ...]) -> None:
    """Schema checks made before any job runs; extra columns are ignored."""
    repeated = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if repeated:
        raise ValueError(f"duplicate column names: {repeated[:20]}")
    require_columns(df, features, "features the detector was fitted on")


class DetectorModel(Model, MLWritable, MLReadable):
    """Fitted split, encoder, reconstruction model and threshold. ``transform`` keeps every input column.

    A stage like any other: it saves and loads by ``write()`` and ``load()``, alone or inside a ``PipelineModel``.
    """

    def __init__(
        self,
        roles: Roles,
        split_model: SplitModel,
        encoder: EncoderModel,
        model: ReconstructionModel,
        threshold: float,
        score_places: int | None = None,
    ) -> None:
        super().__init__()
        self.roles = roles
        self.split_model = split_model
        self.encoder = encoder
        self.model = model
        self.threshold = threshold
        self.score_places = score_places

    def write(self):
        from residua.sources.model_store import DetectorWriter

        return DetectorWriter(self)

    @classmethod
    def read(cls):
        from residua.sources.model_store import DetectorReader

        return DetectorReader()

    def with_score(self, df: DataFrame) -> DataFrame:
        return _scored(self.model, df, self.score_places)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.score(dataset)

    def score(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        """Add ``mse_score``, ``flagged`` and, when a label is present, ``is_malicious``."""
        validate_for_scoring(df, self.encoder.features)
        flagged = with_flag(self.with_score(df), active_threshold(self.threshold, threshold))
        if self.roles.label in df.columns:
            flagged = flagged.withColumn("is_malicious", is_malicious(self.roles.label))
        return flagged

    def assign_split(self, df: DataFrame) -> DataFrame:
        return self.split_model.transform(df)

    def split_rows(self, df: DataFrame, split: str) -> DataFrame:
        return self.split_model.rows(df, split)

    def holdout(self, df: DataFrame, split: str = "test") -> DataFrame:
        """Scored rows of one split."""
        return self.score(self.split_rows(df, split))

    def benign_reference(self, df: DataFrame, split: str = "val") -> DataFrame:
        return self.with_score(self.split_rows(benign_rows(df, self.roles), split))


def _scored(model: ReconstructionModel, df: DataFrame, places: int | None) -> DataFrame:
    scored = model.with_score(df)
    return scored if places is None else scored.withColumn("mse_score", half_even(F.col("mse_score"), places))


class AnomalyDetector(Estimator):
    """Stratified split, encoder and reconstruction model on benign training rows, threshold on benign validation rows."""

    def __init__(
        self,
        roles: Roles,
        reconstructor: Reconstructor | None = None,
        percentile: float = THRESHOLD_PERCENTILE,
        test_size: float = 0.15,
        val_size: float = 0.15,
        seed: int = 42,
        score_places: int | None = None,
    ) -> None:
        super().__init__()
        self.roles = roles
        self.reconstructor = reconstructor or MeanReconstructor()
        self.percentile = percentile
        self.splitter = StratifiedSplit(roles.label, roles.key, test_size, val_size, seed)
        self.score_places = score_places

    def _fit(self, dataset: DataFrame) -> DetectorModel:
        roles = self.roles.resolve(dataset)
        require_columns(dataset, (roles.label, roles.key), "label and key")
        split = self.splitter.fit(dataset)
        fitting = split.transform(benign_rows(dataset, roles)).filter(F.col("split") != "test")
        # read by every pass below; executors that are lost recompute their part
        fitting = fitting.select(roles.key, *roles.features, "split").persist()
        try:
            train = fitting.filter(F.col("split") == "train").drop("split")
            validation = fitting.filter(F.col("split") == "val").drop("split")
            encoder = FeatureEncoder(roles.numeric, roles.categorical).fit(train)
            model = self.reconstructor.fit(train, validation, encoder)
            scores = _scored(model, validation, self.score_places).select("mse_score")
            threshold = fit_threshold(materialize(scores, "validation-scores"), self.percentile)  # scored once, read per pass
        finally:
            fitting.unpersist()
        return DetectorModel(roles, split, encoder, model, threshold, self.score_places)


@dataclass(frozen=True)
class HoldoutEvaluation:
    """Tables of a held-out evaluation; all lazy over the scored test rows."""

    scored: DataFrame
    report: DataFrame
    sweep: DataFrame
    per_class: DataFrame | None
    forest_report: DataFrame | None
    comparison: DataFrame | None


def evaluate_holdout(
    df: DataFrame, detector: DetectorModel, forest: IsolationForest | None = None, scored: DataFrame | None = None
) -> HoldoutEvaluation:
    """Score the test split, sweep thresholds, break down by class and compare with an isolation forest.

    Every set of rows is scored once and written; all tables read from there. ``scored`` may bring stored test rows along.
    """
    roles = detector.roles
    scored = materialize(detector.holdout(df), "holdout") if scored is None else scored
    report = full_report(scored)
    sweep = threshold_sweep(scored, materialize(detector.benign_reference(df).select("mse_score"), "reference"))
    detailed = roles.detail_label is not None and roles.detail_label in df.columns
    per_class = per_class_detection(scored, roles.detail_label) if detailed else None
    if forest is None:
        return HoldoutEvaluation(scored, report, sweep, per_class, None, None)
    train = detector.split_rows(benign_rows(df, roles), "train")
    fitted = forest.fit(train, detector.encoder, roles.key)
    test = detector.split_rows(df, "test")
    forest_scored = fitted.transform(test).withColumn("is_malicious", is_malicious(roles.label))
    forest_scored = materialize(forest_scored.select("mse_score", "flagged", "is_malicious"), "forest-scores")
    forest_report = full_report(forest_scored, "test_isolation_forest")
    comparison = model_comparison(report, forest_report, ("detector", "isolation_forest"))
    return HoldoutEvaluation(scored, report, sweep, per_class, forest_report, comparison)
