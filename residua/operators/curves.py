"""Average precision, ROC AUC and the two curves over distinct scores.

Scores are grouped first (a hot score is one row), then running positives and negatives are taken from the
highest score down with bucketed running totals. Neighbour differences are group counts, so no second window is
needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.functions.running import ROWS_PER_BUCKET, OrderSketch, running_totals, sketch_order

def score_groups(scored: DataFrame, score: str = "mse_score", positive: str = "is_malicious") -> DataFrame:
    """One row per distinct score with its positives and negatives."""
    return scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(positive)).alias("pos"), F.count_if(~F.col(positive)).alias("neg")
    )


@dataclass(frozen=True)
class RankedScores:
    """Score groups with running ``tp`` and ``fp`` from the highest score down, and totals over all rows."""

    groups: DataFrame
    sketch: OrderSketch
    totals: dict[str, int]

    @property
    def defined(self) -> bool:
        """Both classes present and every score a finite number."""
        return bool(self.totals["pos"] and self.totals["neg"] and not self.totals["undefined"])


def rank_scores(
    scored: DataFrame,
    score: str = "mse_score",
    positive: str = "is_malicious",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    extra: dict[str, Column] | None = None,
) -> RankedScores:
    """One scan sizes the table (and takes any ``extra`` aggregates along), the ranking itself stays lazy."""
    s = F.col(score).cast("double")
    counts = {"pos": F.count_if(F.col(positive)), "neg": F.count_if(~F.col(positive)), "undefined": _undefined(s)}
    sketch, totals = sketch_order(scored, s, rows_per_bucket, counts | (extra or {}))
    return RankedScores(_running(score_groups(scored, score, positive), sketch), sketch, totals)


def rank_groups(groups: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> RankedScores:
    """The same from a stored table of score groups."""
    s = F.col("score")
    counts = {"pos": F.coalesce(F.sum("pos"), F.lit(0)), "neg": F.coalesce(F.sum("neg"), F.lit(0)), "undefined": _undefined(s)}
    sketch, totals = sketch_order(groups, s, rows_per_bucket, counts)
    return RankedScores(_running(groups, sketch), sketch, totals)


def _undefined(s: Column) -> Column:
    return F.count_if(s.isNull() | F.isnan(s) | (F.abs(s) == float("inf")))


def _running(groups: DataFrame, sketch: OrderSketch) -> DataFrame:
    return running_totals(groups, "score", {"tp": F.col("pos"), "fp": F.col("neg")}, sketch, descending=True, keep_bucket=True)


def ranking_metrics(scored: DataFrame, score: str = "mse_score", **options) -> DataFrame:
    """One row: ``pr_auc`` (average precision) and ``roc_auc``; null for a single class or undefined scores."""
    return auc_of(rank_scores(scored, score, **options))


def auc_of(ranked: RankedScores) -> DataFrame:
    if not ranked.defined:
        none = F.lit(None).cast("double")
        return ranked.groups.sparkSession.range(1).select(none.alias("pr_auc"), none.alias("roc_auc"))
    p, n = F.lit(float(ranked.totals["pos"])), F.lit(float(ranked.totals["neg"]))
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    above = F.col("tp") - F.col("pos")
    return ranked.groups.agg(
        (F.sum(F.col("pos") * precision) / p).alias("pr_auc"),
        (F.sum(F.col("neg") * (above + F.col("pos") / F.lit(2.0))) / (p * n)).alias("roc_auc"),
    )


def pr_curve(scored: DataFrame, score: str = "mse_score", **options) -> DataFrame:
    """(threshold, precision, recall) per distinct score plus the closing point (null, 1, 0)."""
    ranked = rank_scores(scored, score, **options)
    points = ranked.groups.select(
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.lit(float(ranked.totals["pos"] or 1))).alias("recall"),
    )
    closing = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(closing)


def pr_curve_area(scored: DataFrame, score: str = "mse_score", **options) -> DataFrame:
    """Trapezoid area under the PR curve (not average precision) and the prevalence baseline."""
    ranked = rank_scores(scored, score, **options)
    positives = ranked.totals["pos"]
    pos, rows = float(positives or 1), float((positives + ranked.totals["neg"]) or 1)
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    before_tp, before = F.col("tp") - F.col("pos"), F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg")
    previous = F.when(before > 0, before_tp / before).otherwise(1.0)
    strip = F.col("pos") / F.lit(pos) * (precision + previous) / F.lit(2.0)
    return ranked.groups.agg(F.sum(strip).alias("pr_area"), F.lit(positives / rows).alias("prevalence"))


def roc_curve(
    scored: DataFrame, score: str = "mse_score", drop_collinear: bool = True, **options
) -> DataFrame:
    """(threshold, fpr, tpr) from the origin; points on a straight line between neighbours are left out."""
    ranked = rank_scores(scored, score, **options)
    totals = ranked.totals
    groups = _drop_collinear(ranked.groups) if drop_collinear else ranked.groups
    points = groups.select(
        F.col("score").alias("threshold"),
        (F.col("fp") / F.lit(float(totals["neg"] or 1))).alias("fpr"),
        (F.col("tp") / F.lit(float(totals["pos"] or 1))).alias("tpr"),
    )
    origin = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def _drop_collinear(bucketed: DataFrame) -> DataFrame:
    """Keep a point when the step to the next one differs from its own step, and both end points.

    The next step of a bucket's last row is the first row of the bucket below, taken from a table of one row
    per bucket.
    """
    inside = Window.partitionBy("_bucket").orderBy(F.col("score").desc())
    heads = bucketed.groupBy("_bucket").agg(F.max_by(F.struct("pos", "neg"), "score").alias("_head"))
    below = heads.select("_bucket", F.lead("_head").over(Window.orderBy(F.col("_bucket").desc())).alias("_below"))
    step = F.struct("pos", "neg")
    joined = bucketed.join(F.broadcast(below), "_bucket").withColumn(
        "_next", F.coalesce(F.lead(step).over(inside), F.col("_below"))
    )
    first = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")
    differs = (F.col("_next.pos") != F.col("pos")) | (F.col("_next.neg") != F.col("neg"))
    return joined.filter(first | F.col("_next").isNull() | differs).select(*bucketed.columns)


def roc_curve_area(scored: DataFrame, score: str = "mse_score", **options) -> DataFrame:
    """Trapezoid area under the ROC curve, which equals the tie-aware AUC."""
    return ranking_metrics(scored, score, **options).select(F.col("roc_auc").alias("roc_area"))
