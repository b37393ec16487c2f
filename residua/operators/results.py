"""Ranked anomalies, filters, display and export views, replay windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.functions.columns import no_nan, strip
from residua.functions.running import ROWS_PER_BUCKET, running_totals, sketch_order
from residua.roles import Roles, safe_name

KEY, SCORE = "record_index", "mse_score"

# Preview sizes, replay window lengths and reader-friendly export names.
PREVIEW_COLUMNS, PREVIEW_ROWS = 40, 20
TOP_CONTEXT, FIRST_FLAGGED, FALLBACK_BACKGROUND, RECENT_ALERTS, REPLAY_WINDOW = 10, 5, 500, 15, 300
IDENTIFIER_COLUMNS = ("ts", "uid", "id.orig_h", "id.resp_h")
EXPORT_LEAD = ("record_index", "ts", "uid", "id.orig_h", "id.orig_p", "id.resp_h", "id.resp_p")
EXPORT_NAMES = {
    "record_index": "csv_row_index",
    "ts": "timestamp",
    "uid": "connection_uid",
    "id.orig_h": "origin_host_ip",
    "id.orig_p": "origin_port",
    "id.resp_h": "response_host_ip",
    "id.resp_p": "response_port",
    "label": "true_label",
    "detailed-label": "true_label_detail",
    "reconstruction_mse": "anomaly_score_reconstruction_mse",
    "anomaly_flag": "anomaly_flag",
}
ALERT_COLUMNS = ("label", "proto", "service", "conn_state", "detailed_label")


def _ranking(key: str, score: str) -> list[Column]:
    return [no_nan(F.col(score)).desc_nulls_last(), F.col(key)]


def filter_flagged(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("flagged"))


def filter_label(scored: DataFrame, value: str, label: str = "label") -> DataFrame:
    return scored.filter(strip(F.col(label).cast("string")) == value)


def filter_score_range(scored: DataFrame, lo: float, hi: float, score: str = SCORE) -> DataFrame:
    return scored.filter(F.col(score).between(lo, hi))


def top_anomalies(
    scored: DataFrame, n: int, flagged_only: bool = False, at_least_one: bool = True, key: str = KEY, score: str = SCORE
) -> DataFrame:
    """Highest scores first, ties by record number; missing and NaN scores come last. ``n`` is raised to 1, or to 0 without ``at_least_one``."""
    rows = filter_flagged(scored) if flagged_only else scored
    return rows.orderBy(*_ranking(key, score)).limit(max(1 if at_least_one else 0, int(n)))


def top_anomalies_then_filter(
    scored: DataFrame,
    n: int,
    label: str | None = None,
    score_range: tuple[float, float] | None = None,
    flagged_only: bool = False,
    filter_first: bool = False,
    key: str = KEY,
    score: str = SCORE,
) -> DataFrame:
    """The cap comes before the label and range filters; ``filter_first`` swaps the two."""

    def narrowed(df: DataFrame) -> DataFrame:
        df = df if label is None else filter_label(df, label)
        return df if score_range is None else filter_score_range(df, *score_range, score=score)

    if filter_first:
        return top_anomalies(narrowed(scored), n, flagged_only, False, key, score)
    return narrowed(top_anomalies(scored, n, flagged_only, False, key, score))


def ranked(scored: DataFrame, n: int, key: str = KEY, score: str = SCORE) -> DataFrame:
    """Top ``n`` with their position; the window sees the ``n`` kept rows only."""
    position = F.row_number().over(Window.orderBy(*_ranking(key, score)))
    return top_anomalies(scored, n, key=key, score=score).withColumn("position", position)


def first_flagged(scored: DataFrame, n: int = FIRST_FLAGGED, key: str = KEY) -> DataFrame:
    return filter_flagged(scored).orderBy(key).limit(n)


def recent_alerts(scored: DataFrame, n: int = RECENT_ALERTS, key: str = KEY) -> DataFrame:
    return filter_flagged(scored).orderBy(F.col(key).desc()).limit(n)


def lowest_error_rows(scored: DataFrame, n: int = FALLBACK_BACKGROUND, key: str = KEY, score: str = SCORE) -> DataFrame:
    return scored.orderBy(no_nan(F.col(score)).asc_nulls_last(), key).limit(n)


def head(df: DataFrame, n: int, key: str = KEY) -> DataFrame:
    return df.orderBy(key).limit(n)


def alert_columns(scored: DataFrame, key: str = KEY, score: str = SCORE) -> DataFrame:
    """Alert record: number, score and whichever descriptive columns the table has."""
    present = [c for c in ALERT_COLUMNS if c in scored.columns]
    return scored.select(F.col(key).alias("idx"), F.col(score).alias("mse_score"), *present)


def feature_preview(df: DataFrame, roles: Roles, max_columns: int = PREVIEW_COLUMNS, rows: int = PREVIEW_ROWS) -> DataFrame:
    """First feature columns (labels appended when columns were cut), first rows in record order."""
    hidden = {*roles.labels, *roles.ids, roles.key}
    features = [c for c in df.columns if c not in hidden]
    shown = features or [c for c in df.columns if c != roles.key]
    if len(features) > max_columns:
        shown = features[:max_columns] + [c for c in roles.labels if c in df.columns]
    return head(df, rows, roles.key).select(roles.key, *shown)


def record_drilldown(df: DataFrame, key_value, key: str = KEY) -> DataFrame:
    """Every field of one record as (field, value) text."""
    one = df.filter(F.col(key) == key_value)
    fields = F.array(
        *[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns]
    )
    return one.select(F.inline(fields))


def _layout(columns: list[str], leading: tuple[str, ...], roles: Roles, key: str, results: tuple[str, ...], by_name: bool = False) -> list[str]:
    """The columns by class: record number, leading ones in their own order, labels, all others (as they come or by name), results."""
    known = {key: (0, 0)}
    for rank, names in enumerate((map(safe_name, leading), roles.labels, results)):
        for place, name in enumerate(names):
            known.setdefault(name, ((1, 2, 4)[rank], place))
    others = sorted(columns) if by_name else columns
    return sorted(columns, key=lambda c: known.get(c, (3, others.index(c))))


def display_view(scored: DataFrame, roles: Roles, key: str = KEY, score: str = SCORE) -> DataFrame:
    """Record number, identifiers, labels, the other columns in table order, then score and flag."""
    shown = {score: "reconstruction_mse", "flagged": "anomaly_flag"}
    order = _layout(scored.columns, IDENTIFIER_COLUMNS, roles, key, tuple(shown))
    return scored.select(*[F.col(c).alias(shown.get(c, c)) for c in order])


def export_view(scored: DataFrame, roles: Roles, key: str = KEY, score: str = SCORE) -> DataFrame:
    """Export layout: friendly names, other columns sorted, the flag as Yes or No."""
    renamed = {safe_name(c): shown for c, shown in EXPORT_NAMES.items()}
    for own, standard in ((key, "record_index"), (roles.label, "label"), (roles.detail_label, "detailed-label"), (score, "reconstruction_mse"), ("flagged", "anomaly_flag")):
        renamed[own] = EXPORT_NAMES[standard]
    order = _layout(scored.columns, EXPORT_LEAD, roles, key, (score, "flagged"), by_name=True)
    value = lambda c: F.when(F.col(c), "Yes").otherwise("No") if c == "flagged" else F.col(c)
    return scored.select(*[value(c).alias(renamed.get(c, safe_name(c))) for c in order])


def anomaly_export(scored: DataFrame, n: int, flagged_only: bool, roles: Roles, key: str = KEY, score: str = SCORE):
    """Content of the ranked anomaly file."""
    return export_view(top_anomalies(scored, n, flagged_only, key=key, score=score), roles, key, score)


def cumulative_alerts(scored: DataFrame, key: str = KEY, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Running number of alerts in record order."""
    rows = scored.select(key, F.col("flagged").cast("int").alias("_alert"))
    sketch, _ = sketch_order(rows, F.col(key), rows_per_bucket)
    totals = running_totals(rows, key, {"cumulative_alerts": F.col("_alert")}, sketch)
    return totals.select(key, F.col("cumulative_alerts").cast("bigint").alias("cumulative_alerts"))


def last_window(scored: DataFrame, n: int = REPLAY_WINDOW, key: str = KEY, score: str = SCORE) -> DataFrame:
    """The last ``n`` records as normal and alert series."""
    series = F.when(F.col("flagged"), "Anomaly").otherwise("Normal")
    return scored.orderBy(F.col(key).desc()).limit(n).select(key, score, series.alias("series"))


def align(left: DataFrame, right: DataFrame, key: str = KEY) -> DataFrame:
    """Re-attach columns kept in another table by record number."""
    return left.join(right, key, "inner")
