"""Confusion counts and the reports derived from them.

Scored tables carry ``is_malicious`` and ``flagged`` as columns, so every report is one partial/final
aggregate over the rows and projections of its single output row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residua.functions.columns import count_where, half_even, ratio
from residua.operators.curves import RankedScores, auc_of, rank_scores

CELLS = ("tp", "fp", "tn", "fn")
REPORT_SCHEMA_VERSION = 1


def cell_counts(flagged: Column, malicious: Column) -> dict[str, Column]:
    return {
        "tp": count_where(flagged & malicious),
        "fp": count_where(flagged & ~malicious),
        "tn": count_where(~flagged & ~malicious),
        "fn": count_where(~flagged & malicious),
    }


def confusion_counts(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    cells = cell_counts(F.col("flagged"), F.col("is_malicious"))
    return scored.groupBy(*by).agg(*[c.alias(n) for n, c in cells.items()])


def precision_recall_f1(undefined: str = "null") -> dict[str, Column]:
    """Over columns tp, fp, fn. Undefined values are null, or 0 with ``undefined='zero'``."""
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    f1 = ratio(F.lit(2.0) * precision * recall, precision + recall)
    metrics = {"precision": precision, "recall": recall, "f1_score": f1}
    if undefined == "zero":
        return {n: F.coalesce(c, F.lit(0.0)) for n, c in metrics.items()}
    if undefined != "null":
        raise ValueError("undefined must be 'null' or 'zero'")
    return metrics


def with_metrics(counts: DataFrame, undefined: str = "null") -> DataFrame:
    return counts.withColumns(precision_recall_f1(undefined))


def classification_metrics(scored: DataFrame, by: tuple[str, ...] = (), undefined: str = "zero") -> DataFrame:
    return with_metrics(confusion_counts(scored, by), undefined).select(
        *by, "precision", "recall", "f1_score", *CELLS
    )


def _counted_ranking(scored: DataFrame, score: str) -> tuple[DataFrame, RankedScores]:
    """Confusion counts as a one-row table and the ranking, from one sizing scan and one ranking pass."""
    cells = cell_counts(F.col("flagged"), F.col("is_malicious"))
    ranked = rank_scores(scored, score, extra=cells)
    counts = [F.lit(ranked.totals[c]).cast("bigint").alias(c) for c in CELLS]
    return scored.sparkSession.range(1).select(*counts), ranked


def full_report(scored: DataFrame, split_name: str = "test", score: str = "mse_score") -> DataFrame:
    """Classification and ranking metrics of one split in one row."""
    counts, ranked = _counted_ranking(scored, score)
    auc = auc_of(ranked).select(F.struct("pr_auc", "roc_auc")).scalar()
    measured = with_metrics(counts, "zero").withColumn("_auc", auc)
    return measured.select(
        F.lit(split_name).alias("split"), "precision", "recall", "f1_score", *CELLS, "_auc.pr_auc", "_auc.roc_auc"
    )


def metrics_report(
    scored: DataFrame, threshold: float, data_source: str, labelled: bool = True, score: str = "mse_score"
) -> DataFrame:
    """The 14-field report of a scoring run; supervised fields are null without labels."""
    head = [F.lit(REPORT_SCHEMA_VERSION).alias("report_schema_version"), F.lit(data_source).alias("data_source")]
    bound = F.lit(float(threshold)).alias("threshold_mse")
    if not labelled:
        none = {n: F.lit(None).cast("bigint").alias(n) for n in ("true_malicious_label_count", *CELLS)}
        metrics = [F.lit(None).cast("double").alias(n) for n in ("precision", "recall", "f1_score", "pr_auc")]
        return scored.agg(
            count_where(F.lit(True)).alias("rows_scored"), count_where(F.col("flagged")).alias("flagged_count")
        ).select(
            *head,
            "rows_scored",
            "flagged_count",
            none["true_malicious_label_count"],
            bound,
            *[none[c] for c in CELLS],
            *metrics,
        )
    counts, ranked = _counted_ranking(scored, score)
    tp, fp, tn, fn = (F.col(c) for c in CELLS)
    return with_metrics(counts).select(
        *head,
        (tp + fp + tn + fn).alias("rows_scored"),
        (tp + fp).alias("flagged_count"),
        (tp + fn).alias("true_malicious_label_count"),
        bound,
        *CELLS,
        "precision",
        "recall",
        "f1_score",
        auc_of(ranked).select("pr_auc").scalar().alias("pr_auc"),
    )


def contingency_matrix(scored: DataFrame | None, spark=None) -> DataFrame:
    """Flagged or not by malicious or benign; null cells when there are no labels."""
    flagged, calm = F.lit("Flagged (anomaly)"), F.lit("Not flagged (normal)")
    if scored is None:
        counts = spark.range(1).select(*[F.lit(None).cast("bigint").alias(c) for c in CELLS])
    else:
        counts = confusion_counts(scored)
    rows = F.array(
        F.struct(flagged.alias("prediction"), F.col("tp").alias("malicious"), F.col("fp").alias("benign")),
        F.struct(calm.alias("prediction"), F.col("fn").alias("malicious"), F.col("tn").alias("benign")),
    )
    return counts.select(F.inline(rows))


def confusion_long(scored: DataFrame | None, spark=None) -> DataFrame:
    """Four rows (actual, predicted, count) and the chart label of the cell."""
    if scored is None:
        counts = spark.range(1).select(*[F.lit(None).cast("bigint").alias(c) for c in CELLS])
    else:
        counts = confusion_counts(scored)
    layout = (
        ("Malicious", "Flagged", "tp"),
        ("Malicious", "Not flagged", "fn"),
        ("Benign", "Flagged", "fp"),
        ("Benign", "Not flagged", "tn"),
    )
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("count"))
            for a, p, c in layout
        ]
    )
    return counts.select(F.inline(rows)).withColumn("cell", F.concat_ws(" | ", "actual", "predicted"))


def false_positive_negative(scored: DataFrame) -> DataFrame:
    return confusion_counts(scored).select(
        F.col("fp").alias("false_positives"), F.col("fn").alias("false_negatives")
    )


def metrics_long(report: DataFrame, metrics: tuple[str, ...] = ("precision", "recall", "f1_score", "pr_auc")) -> DataFrame:
    """One row per metric under its canonical key."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
    return report.select(F.inline(rows))


def flag_rate(scored: DataFrame) -> DataFrame:
    n, flagged = count_where(F.lit(True)), count_where(F.col("flagged"))
    rate = half_even(F.lit(100.0) * flagged / F.greatest(n, F.lit(1)), 4)
    return scored.agg(
        n.alias("rows"), flagged.alias("flagged"), rate.alias("flagged_pct"), (n - flagged).alias("not_flagged")
    )


def flag_rate_sentence(rate: DataFrame) -> DataFrame:
    """``flag_rate`` as one line of text."""
    share = F.concat(F.format_number("flagged_pct", 1), F.lit(" %"))
    line = F.concat(F.format_number("flagged", 0), F.lit(" of "), F.format_number("rows", 0), F.lit(" records flagged ("), share, F.lit(")"))
    return rate.select(line.alias("summary"))
