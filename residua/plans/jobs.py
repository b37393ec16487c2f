"""The three batch jobs: parse a log, build a detector, evaluate a saved detector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from residua.operators.forest import IsolationForest
from residua.operators.reconstruct import Reconstructor
from residua.plans.detection import AnomalyDetector, DetectorModel, HoldoutEvaluation, evaluate_holdout
from residua.roles import Roles
from residua.sources.conn_log import read_conn_log
from residua.sources.model_store import load_detector, save_detector
from residua.sources.record_index import with_record_index
from residua.sources.sinks import read_scored, write_metrics, write_processed, write_scored
from residua.sources.tables import infer_types


def preprocess(spark: SparkSession, log_path: str | list[str], out: str, mode: str = "FAILFAST", fmt: str = "parquet") -> None:
    """Labelled logs to one flat table."""
    write_processed(read_conn_log(spark, log_path, mode), out, fmt)


def load_processed(spark: SparkSession, path: str) -> DataFrame:
    """A processed Parquet table with inferred column types and record numbers in file order."""
    return infer_types(with_record_index(spark.read.parquet(path)))


def build_detector(
    df: DataFrame,
    roles: Roles,
    out: str,
    reconstructor: Reconstructor | None = None,
    forest: IsolationForest | None = None,
) -> DetectorModel:
    """Fit, save under ``<out>/detector`` and evaluate. Saved before evaluation, so a failure there loses nothing."""
    spark = df.sparkSession
    detector = AnomalyDetector(roles, reconstructor).fit(df)
    save_detector(spark, detector, f"{out}/detector")
    write_evaluation(df, detector, out, forest)
    return detector


def evaluate_saved(df: DataFrame, detector_path: str, out: str, forest: IsolationForest | None = None) -> HoldoutEvaluation:
    return write_evaluation(df, load_detector(df.sparkSession, detector_path), out, forest)


def write_evaluation(
    df: DataFrame, detector: DetectorModel, out: str, forest: IsolationForest | None = None
) -> HoldoutEvaluation:
    """Store the scored test rows once; every report is computed from the stored rows."""
    write_scored(detector.holdout(df), f"{out}/scored")
    evaluation = evaluate_holdout(df, detector, forest, read_scored(df.sparkSession, f"{out}/scored"))
    reports = {
        "report": evaluation.report,
        "sweep": evaluation.sweep,
        "per_class": evaluation.per_class,
        "forest_report": evaluation.forest_report,
        "comparison": evaluation.comparison,
    }
    for name, report in reports.items():
        if report is not None:
            write_metrics(report, f"{out}/{name}")
    return evaluation
