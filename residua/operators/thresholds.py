"""Percentile thresholds, the sweep over them, and detection by class."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions.columns import count_where, exceeds, half_even, label_text, no_nan
from residua.functions.lookup import lookup_join
from residua.functions.materialize import materialize
from residua.functions.quantiles import exact_quantile, exact_quantiles
from residua.functions.running import ROWS_PER_BUCKET, running_totals, sketch_rows
from residua.operators.confusion import CELLS, cell_counts, with_metrics

# Percentiles of the benign score distribution the sweep visits, and the one in use.
SWEEP_PERCENTILES = (90.0, 95.0, 97.0, 98.0, 99.0, 99.5, 99.9)
THRESHOLD_PERCENTILE = 99.0

COLLECTED_GROUPS = 10_000


def fit_threshold(reference: DataFrame, percentile: float = THRESHOLD_PERCENTILE, score: str = "mse_score") -> float:
    """Interpolated percentile of the reference rows' scores (benign validation rows; all rows as a fallback)."""
    threshold = exact_quantile(reference, score, percentile / 100.0)
    if threshold is None:
        raise ValueError("no reference scores to take a threshold from")
    return threshold


def threshold_context(scored: DataFrame, threshold: float, score: str = "mse_score") -> DataFrame:
    """Rows above the threshold, share above 110 % of it, share within 5 % of it (closed band)."""
    s, t = F.col(score), float(threshold)
    band = F.coalesce(~F.isnan(s) & (s >= t * 0.95) & (s <= t * 1.05), F.lit(False))
    n = F.greatest(count_where(F.lit(True)), F.lit(1))
    return scored.agg(
        count_where(exceeds(s, F.lit(t))).alias("above"),
        (count_where(exceeds(s, F.lit(t * 1.10))) / n).alias("above_margin"),
        (count_where(band) / n).alias("near_band"),
    )


def threshold_sweep(
    scored: DataFrame,
    benign_reference: DataFrame | None = None,
    percentiles: tuple[float, ...] = SWEEP_PERCENTILES,
    score: str = "mse_score",
) -> DataFrame:
    """Metrics at each percentile threshold. All thresholds are counted in one scan, without repeating rows."""
    reference = scored.filter(~F.col("is_malicious")) if benign_reference is None else benign_reference
    cuts = exact_quantiles(reference, {"s": F.col(score)}, [p / 100.0 for p in percentiles])["s"]
    if cuts[0] is None:
        raise ValueError("no benign scores to take thresholds from")
    counted = scored.agg(
        *[
            c.alias(f"{cell}_{i}")
            for i, t in enumerate(cuts)
            for cell, c in cell_counts(exceeds(F.col(score), F.lit(t)), F.col("is_malicious")).items()
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("percentile"),
                F.lit(t).alias("threshold"),
                *[F.col(f"{cell}_{i}").alias(cell) for cell in CELLS],
            )
            for i, (p, t) in enumerate(zip(percentiles, cuts, strict=True))
        ]
    )
    return with_metrics(counted.select(F.inline(rows)), undefined="zero").select(
        "percentile", "threshold", "precision", "recall", "f1_score", *CELLS
    )


def sweep_series(sweep: DataFrame) -> DataFrame:
    """Long form of the sweep: one row per percentile and metric."""
    return sweep.unpivot("percentile", ["precision", "recall", "f1_score"], "metric", "value")


def grouped_median(
    df: DataFrame, by: str, value: str, name: str = "median", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Exact median per group. A hot group is spread over value buckets, a hot value is one counted row."""
    rows = df.select(by, no_nan(F.col(value).cast("double")).alias("_v"))
    sizes = _small(rows.groupBy(by).agg(F.count("_v").alias("_n")))
    return _medians(rows, sizes, by, name, rows_per_bucket)


@dataclass(frozen=True)
class _GroupSizes:
    """One row per group with its number ``_n`` of values."""

    table: DataFrame
    groups: int
    values: int


def _small(table: DataFrame) -> _GroupSizes:
    """A local copy of a per-group table, or a written one when there are many groups."""
    rows = table.limit(COLLECTED_GROUPS + 1).collect()
    if len(rows) <= COLLECTED_GROUPS:
        local = table.sparkSession.createDataFrame(rows, table.schema)
        return _GroupSizes(local, len(rows), sum(r["_n"] for r in rows))
    stored = materialize(table, "groups")
    return _GroupSizes(stored, *stored.agg(F.count(F.lit(1)), F.sum("_n")).first())


def _medians(rows: DataFrame, sizes: _GroupSizes, by: str, name: str, rows_per_bucket: int) -> DataFrame:
    """Median of ``_v`` per group. Missing values form a group of count 0 and hold no rank."""
    sketch = sketch_rows(sizes.values, rows_per_bucket)
    counted = rows.groupBy(by, "_v").agg(F.count("_v").alias("_c"))
    ranked = running_totals(counted, "_v", {"_upto": F.col("_c")}, sketch, by=(by,))
    placed = lookup_join(ranked, sizes.table.select(by, "_n"), [by], sizes.groups)
    position = (F.col("_n") - 1) / F.lit(2.0)
    holds = lambda rank: (rank >= F.col("_upto") - F.col("_c")) & (rank < F.col("_upto"))
    middle = [F.max(F.when(holds(f(position)), F.col("_v"))) for f in (F.floor, F.ceil)]
    return placed.groupBy(by).agg(((middle[0] + middle[1]) / F.lit(2.0)).alias(name))


def per_class_detection(
    scored: DataFrame,
    detail: str = "detailed_label",
    benign_from: str = "detail",
    score: str = "mse_score",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Detection per detail label, best rate first.

    Rows are benign when their detail label reads ``benign``; with ``benign_from='label'`` when they are not
    ``is_malicious``, which also leaves out benign rows whose detail label is a dash.
    """
    detail_text = label_text(detail)
    benign = F.lower(detail_text) == "benign" if benign_from == "detail" else ~F.col("is_malicious")
    attacks = scored.filter(~benign).select(
        detail_text.alias("attack_type"), no_nan(F.col(score).cast("double")).alias("_v"), "flagged"
    )
    counts = _small(
        attacks.groupBy("attack_type").agg(
            count_where(F.lit(True)).alias("count"),
            count_where(F.col("flagged")).alias("detected"),
            F.avg("_v").alias("avg_mse"),
            F.count("_v").alias("_n"),
        )
    )
    medians = _medians(attacks.drop("flagged"), counts, "attack_type", "median_mse", rows_per_bucket)
    return (
        counts.table.join(medians, "attack_type", "left")
        .select(
            "attack_type",
            "count",
            "detected",
            half_even(F.col("detected") / F.col("count"), 4).alias("detection_rate"),
            half_even(F.col("avg_mse"), 6).alias("avg_mse"),
            half_even(F.col("median_mse"), 6).alias("median_mse"),
        )
        .orderBy(F.col("detection_rate").desc(), "attack_type")
    )


def class_breakdown(per_class: DataFrame) -> DataFrame:
    """Ascending by rate with the text shown next to each bar."""
    text = F.format_string("n=%d  (%d%%)", "count", F.rint(F.col("detection_rate") * 100).cast("bigint"))
    return per_class.select("*", text.alias("text")).orderBy("detection_rate", "attack_type")
