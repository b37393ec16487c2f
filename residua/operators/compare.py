"""Two scorers side by side, and metrics next to a saved baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.operators.bootstrap import METRICS
from residua.operators.confusion import metrics_long

# Display names of metrics and the canonical keys they stand for.
METRIC_KEYS = {
    "Precision": "precision",
    "Recall": "recall",
    "F1-score": "f1_score",
    "PR-AUC": "pr_auc",
    "ROC-AUC": "roc_auc",
}


def canonical_metric(df: DataFrame, column: str = "metric") -> DataFrame:
    """Display names become canonical keys, so reports with either spelling join."""
    key = F.col(column)
    for shown, canonical in METRIC_KEYS.items():
        key = F.when(F.col(column) == shown, canonical).otherwise(key)
    return df.withColumn(column, key)


def model_comparison(first_report: DataFrame, second_report: DataFrame, names: tuple[str, str]) -> DataFrame:
    """(metric, <first>, <second>, difference) over one-row reports."""
    left = metrics_long(first_report, METRICS).withColumnRenamed("value", names[0])
    right = metrics_long(second_report, METRICS).withColumnRenamed("value", names[1])
    joined = left.join(F.broadcast(right), "metric")  # five rows
    return joined.withColumn("difference", F.col(names[0]) - F.col(names[1]))


def shown(comparison: DataFrame, columns: tuple[str, ...], missing: str = "n/a") -> DataFrame:
    """Metric columns as text with four decimals; missing values as ``n/a``."""
    text = {c: F.when(F.col(c).isNotNull(), F.format_string("%.4f", c)).otherwise(missing) for c in columns}
    return comparison.withColumns(text)


def with_baseline(metrics: DataFrame, baseline: DataFrame) -> DataFrame:
    """Left join of (metric, value) with (metric, baseline_value) on the canonical key."""
    known = canonical_metric(baseline).select("metric", "baseline_value")
    return canonical_metric(metrics).join(F.broadcast(known), "metric", "left")  # one row per metric
