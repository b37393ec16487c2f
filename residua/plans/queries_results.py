"""Queries over scored rows: rankings, filters, views, replay windows, explanations, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions.columns import half_even
from residua.functions.materialize import scratch_path
from residua.operators import explain, results
from residua.operators.labels import benign_rows
from residua.plans import bindings as b
from residua.plans.oracle import (
    EVENTS_SCORED,
    LINEITEM_CATEGORICAL,
    LINEITEM_NUMERIC,
    LINEITEM_SCORED,
    even,
)
from residua.plans.queries_detection import rounded
from residua.plans.registry import query
from residua.sources import sinks
from residua.streaming import alerts as streaming

LINE = "record_key, label, detailed_label, mse_score, flagged"
LINE_COLUMNS = ("record_key", "label", "detailed_label", "mse_score", "flagged")
KEY = "record_key"


def _holdout(spark, folder) -> DataFrame:
    return b.lineitem_holdout(spark, folder)


# ---- rankings and filters --------------------------------------------------------------------------------------

RANK = "ORDER BY mse_score DESC, record_key"


@query("top_anomalies", f"{LINEITEM_SCORED} SELECT {LINE} FROM test {RANK} LIMIT 100")
def top_anomalies(spark, folder) -> DataFrame:
    return results.top_anomalies(_holdout(spark, folder), 100, key=KEY).select(*LINE_COLUMNS)


@query("top_flagged", f"{LINEITEM_SCORED} SELECT {LINE} FROM test WHERE flagged {RANK} LIMIT 25")
def top_flagged(spark, folder) -> DataFrame:
    return results.top_anomalies(_holdout(spark, folder), 25, flagged_only=True, key=KEY).select(*LINE_COLUMNS)


@query(
    "top_then_filter",
    f"""{LINEITEM_SCORED} SELECT * FROM (SELECT {LINE} FROM test {RANK} LIMIT 200)
WHERE label = 'Malicious' AND mse_score BETWEEN 0.5 AND 0.6""",
)
def top_then_filter(spark, folder) -> DataFrame:
    scored = _holdout(spark, folder)
    return results.top_anomalies_then_filter(scored, 200, "Malicious", (0.5, 0.6), key=KEY).select(*LINE_COLUMNS)


@query(
    "filter_then_top",
    f"{LINEITEM_SCORED} SELECT {LINE} FROM test WHERE label = 'Malicious' AND mse_score BETWEEN 0.5 AND 0.6 {RANK} LIMIT 50",
)
def filter_then_top(spark, folder) -> DataFrame:
    scored = _holdout(spark, folder)
    narrowed = results.top_anomalies_then_filter(scored, 50, "Malicious", (0.5, 0.6), filter_first=True, key=KEY)
    return narrowed.select(*LINE_COLUMNS)


@query("top_context", f"{LINEITEM_SCORED} SELECT {LINE} FROM test {RANK} LIMIT 10")
def top_context(spark, folder) -> DataFrame:
    return results.top_anomalies(_holdout(spark, folder), results.TOP_CONTEXT, key=KEY).select(*LINE_COLUMNS)


@query(
    "ranked",
    f"""{LINEITEM_SCORED} SELECT * FROM (SELECT {LINE}, row_number() OVER ({RANK}) AS position FROM test)
WHERE position <= 50""",
)
def ranked(spark, folder) -> DataFrame:
    top = results.ranked(_holdout(spark, folder), 50, key=KEY).select(*LINE_COLUMNS, "position")
    return top.withColumn("position", F.col("position").cast("bigint"))


@query("first_flagged", f"{EVENTS_SCORED} SELECT event_id, mse_score FROM fl WHERE flagged ORDER BY event_id LIMIT 5")
def first_flagged(spark, folder) -> DataFrame:
    return results.first_flagged(b.events_scored(spark, folder), key="event_id").select("event_id", "mse_score")


@query(
    "recent_alerts",
    f"""{EVENTS_SCORED} SELECT event_id AS idx, mse_score, label, detailed_label FROM fl WHERE flagged
ORDER BY event_id DESC LIMIT 15""",
)
def recent_alerts(spark, folder) -> DataFrame:
    recent = results.recent_alerts(b.events_scored(spark, folder), key="event_id")
    return results.alert_columns(recent, "event_id")


@query("lowest_error", f"{LINEITEM_SCORED} SELECT record_key, mse_score FROM fl ORDER BY mse_score, record_key LIMIT 500")
def lowest_error(spark, folder) -> DataFrame:
    df = b.lineitem(spark, folder)
    scored = b.fit(df, b.LINEITEM).transform(df)
    return results.lowest_error_rows(scored, key=KEY).select("record_key", "mse_score")


@query("label_filter", f"{LINEITEM_SCORED} SELECT {LINE} FROM test WHERE trim(label) = 'Malicious'")
def label_filter(spark, folder) -> DataFrame:
    return results.filter_label(_holdout(spark, folder), "Malicious").select(*LINE_COLUMNS)


@query("mse_range", f"{LINEITEM_SCORED} SELECT {LINE} FROM test WHERE mse_score >= 0.4 AND mse_score <= 0.5")
def mse_range(spark, folder) -> DataFrame:
    return results.filter_score_range(_holdout(spark, folder), 0.4, 0.5).select(*LINE_COLUMNS)


@query(
    "aligned_labels",
    f"""{LINEITEM_SCORED} SELECT t.record_key, t.mse_score, f.detailed_label FROM test t JOIN fl f USING (record_key)""",
)
def aligned_labels(spark, folder) -> DataFrame:
    """Scores of the held-out rows joined back to their detail labels by record."""
    df = b.lineitem(spark, folder)
    scored = b.fit(df, b.LINEITEM).holdout(df).select("record_key", "mse_score")
    return results.align(scored, df.select("record_key", "detailed_label"), "record_key")


# ---- views -----------------------------------------------------------------------------------------------------


@query(
    "display_view",
    f"""{EVENTS_SCORED} SELECT event_id, label, detailed_label, user_id, value, k, hour_of_day, user_bucket, is_malicious,
mse_score AS reconstruction_mse, flagged AS anomaly_flag FROM fl ORDER BY mse_score DESC, event_id LIMIT 50""",
)
def display_view(spark, folder) -> DataFrame:
    top = results.top_anomalies(b.events_scored(spark, folder), 50, key="event_id")
    return results.display_view(top, b.EVENTS, key="event_id")


EXPORT = """SELECT event_id AS csv_row_index, label AS true_label, detailed_label AS true_label_detail, hour_of_day,
is_malicious, k, user_bucket, user_id, value, mse_score AS anomaly_score_reconstruction_mse,
CASE WHEN flagged THEN 'Yes' ELSE 'No' END AS anomaly_flag FROM fl"""


@query("export_view", f"{EVENTS_SCORED} {EXPORT}")
def export_view(spark, folder) -> DataFrame:
    return results.export_view(b.events_scored(spark, folder), b.EVENTS, key="event_id")


@query("anomaly_export", f"{EVENTS_SCORED} {EXPORT} WHERE flagged ORDER BY mse_score DESC, event_id LIMIT 100")
def anomaly_export(spark, folder) -> DataFrame:
    """The ranked anomaly file, written as CSV and read back."""
    content = results.anomaly_export(b.events_scored(spark, folder), 100, True, b.EVENTS, key="event_id")
    path = scratch_path(spark, "export")
    sinks.write_processed(content, path, "csv")
    return spark.read.schema(content.schema).option("header", True).csv(path)


@query(
    "drilldown",
    f"""{EVENTS_SCORED}, one AS (SELECT * FROM fl ORDER BY mse_score DESC, event_id LIMIT 1)
SELECT 'event_id' AS field, CAST(event_id AS VARCHAR) AS value FROM one
UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR) FROM one UNION ALL SELECT 'label', label FROM one
UNION ALL SELECT 'detailed_label', detailed_label FROM one UNION ALL SELECT 'value', CAST(value AS VARCHAR) FROM one
UNION ALL SELECT 'k', CAST(k AS VARCHAR) FROM one UNION ALL SELECT 'hour_of_day', CAST(hour_of_day AS VARCHAR) FROM one
UNION ALL SELECT 'user_bucket', user_bucket FROM one UNION ALL SELECT 'mse_score', CAST(mse_score AS VARCHAR) FROM one
UNION ALL SELECT 'flagged', CAST(flagged AS VARCHAR) FROM one
UNION ALL SELECT 'is_malicious', CAST(is_malicious AS VARCHAR) FROM one""",
)
def drilldown(spark, folder) -> DataFrame:
    """Every field of the record with the highest score."""
    top = results.top_anomalies(b.events_scored(spark, folder), 1, key="event_id")
    return results.record_drilldown(top, F.col("event_id"), key="event_id")


@query(
    "scored_roundtrip",
    f"""{EVENTS_SCORED} SELECT event_id, label, detailed_label, value, mse_score FROM test WHERE flagged""",
)
def scored_roundtrip(spark, folder) -> DataFrame:
    """Held-out rows written by flag; alerts are read from their own folder."""
    df = b.events(spark, folder)
    path = scratch_path(spark, "scored")
    sinks.write_scored(b.fit(df, b.EVENTS).holdout(df), path)
    return sinks.read_scored(spark, path).filter("flagged").select("event_id", "label", "detailed_label", "value", "mse_score")


# ---- replay windows --------------------------------------------------------------------------------------------


@query(
    "cumulative_alerts",
    f"""{EVENTS_SCORED} SELECT event_id, (sum(CASE WHEN flagged THEN 1 ELSE 0 END)
OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS cumulative_alerts FROM fl""",
)
def cumulative_alerts(spark, folder) -> DataFrame:
    return results.cumulative_alerts(b.events_scored(spark, folder), key="event_id")


@query(
    "last_300",
    f"""{EVENTS_SCORED} SELECT event_id, mse_score, CASE WHEN flagged THEN 'Anomaly' ELSE 'Normal' END AS series
FROM fl ORDER BY event_id DESC LIMIT 300""",
)
def last_300(spark, folder) -> DataFrame:
    return results.last_window(b.events_scored(spark, folder), key="event_id")


# ---- explanations ----------------------------------------------------------------------------------------------

DIMENSIONS = " UNION ALL ".join(
    [f"SELECT record_key, '{c}' AS feature, err_{c} AS error FROM test WHERE flagged" for c in LINEITEM_NUMERIC]
    + [
        f"""SELECT record_key, '{c}_' || v, pow((CASE WHEN {c} = v THEN 1.0 ELSE 0.0 END)::DOUBLE - p, 2)
FROM test CROSS JOIN cat_{c} WHERE flagged"""
        for c in LINEITEM_CATEGORICAL
    ]
)


@query(
    "feature_errors",
    f"""{LINEITEM_SCORED}, dims AS ({DIMENSIONS}),
rnk AS (SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY error DESC, feature) AS "rank" FROM dims)
SELECT record_key, "rank", feature, {even("error", 6)} AS error FROM rnk WHERE "rank" <= 5""",
)
def feature_errors(spark, folder) -> DataFrame:
    """The five dimensions every flagged row was reconstructed worst in."""
    df = b.lineitem(spark, folder)
    detector = b.fit(df, b.LINEITEM)
    flagged = detector.holdout(df).filter("flagged")
    errors = explain.feature_errors(detector.model, flagged, detector.encoder.dimension_names(), 5, key=KEY)
    return rounded(errors.withColumn("rank", F.col("rank").cast("bigint")))


FEATURES = LINEITEM_NUMERIC + LINEITEM_CATEGORICAL
PHI = f"""{LINEITEM_SCORED},
bg AS (SELECT {", ".join(f"avg(err_{c}) AS bg_{c}" for c in FEATURES)} FROM feat WHERE split = 'train' AND label = 'Benign'),
phi AS ({" UNION ALL ".join(
    f"SELECT record_key, '{c}' AS feature, (err_{c} - bg_{c}) / (SELECT d FROM width) AS phi FROM test CROSS JOIN bg WHERE flagged"
    for c in FEATURES)}),
top1 AS (SELECT record_key FROM test WHERE flagged ORDER BY mse_score DESC, record_key LIMIT 1)"""


def _attributions(spark, folder):
    df = b.lineitem(spark, folder)
    detector = b.fit(df, b.LINEITEM)
    flagged = detector.holdout(df).filter("flagged")
    background = detector.split_rows(benign_rows(df, b.LINEITEM), "train")
    return flagged, explain.separable_attributions(detector.model, flagged, background, key=KEY)


@query("attribution_by_feature", f"{PHI} SELECT record_key, feature, {even('phi', 6)} AS phi FROM phi")
def attribution_by_feature(spark, folder) -> DataFrame:
    return rounded(_attributions(spark, folder)[1])


@query("global_importance", f"{PHI} SELECT feature, {even('avg(abs(phi))', 6)} AS importance FROM phi GROUP BY 1")
def global_importance(spark, folder) -> DataFrame:
    return rounded(explain.global_importance(_attributions(spark, folder)[1]))


@query(
    "waterfall",
    f"""{PHI} SELECT feature, {even("phi", 6)} AS phi, CASE WHEN phi > 0 THEN '+' ELSE '-' END AS sign
FROM phi JOIN top1 USING (record_key) ORDER BY abs(phi) DESC LIMIT 5""",
)
def waterfall(spark, folder) -> DataFrame:
    """The record with the highest score, its five largest contributions."""
    flagged, phi = _attributions(spark, folder)
    top = results.top_anomalies(flagged, 1, key=KEY).first()[KEY]
    row = explain.row_waterfall(phi, top, 5, key=KEY)
    return rounded(row.select("feature", "phi", F.when(F.substring("text", 1, 1) == "+", "+").otherwise("-").alias("sign")))


@query(
    "attribution_table",
    f"""{PHI} SELECT record_key, label, mse_score, {", ".join(
        f"{even(f'max(phi) FILTER (feature = {chr(39)}{c}{chr(39)})', 6)} AS {c}" for c in FEATURES)}
FROM phi JOIN test USING (record_key) GROUP BY ALL""",
)
def attribution_table(spark, folder) -> DataFrame:
    flagged, phi = _attributions(spark, folder)
    table = explain.attribution_table(phi, flagged, FEATURES, key=KEY)
    return rounded(table, keep=("mse_score",))


# ---- streams ---------------------------------------------------------------------------------------------------


def _scored_stream(spark, folder) -> DataFrame:
    """The events table as a stream, scored by a detector fitted on the table."""
    raw = b.table(spark, folder, "events")
    detector = b.fit(b.event_columns(raw), b.EVENTS)
    if raw.inputFiles()[0].endswith("/events.parquet"):  # one file: a stream reads its folder by name
        stream = streaming.parquet_stream(spark, folder, raw.schema, file_glob="events.parquet")
    else:
        stream = streaming.parquet_stream(spark, f"{folder}/events.parquet", raw.schema)
    return streaming.score_stream(b.event_columns(stream), detector)


@query("stream_alerts", f"{EVENTS_SCORED} SELECT event_id AS idx, mse_score, label, detailed_label FROM fl WHERE flagged")
def stream_alerts(spark, folder) -> DataFrame:
    scored = _scored_stream(spark, folder)
    alerts = streaming.alert_stream(scored, "event_id")
    path = scratch_path(spark, "alerts")
    streaming.write_alerts(alerts, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(alerts.schema).parquet(f"{path}/data")


@query(
    "stream_kpis",
    f"""{EVENTS_SCORED} SELECT count(*) AS processed, count(*) FILTER (flagged) AS alerts,
{even("100.0::DOUBLE * count(*) FILTER (flagged) / count(*)", 4)} AS alert_rate_pct FROM fl""",
)
def stream_kpis(spark, folder) -> DataFrame:
    kpis = streaming.running_kpis(_scored_stream(spark, folder))
    path = scratch_path(spark, "kpis")
    streaming.publish_kpis(kpis, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return streaming.latest(spark.read.parquet(f"{path}/data"))


@query("stream_threshold", f"{EVENTS_SCORED} SELECT count(mse_score) AS scores, TRUE AS within_bound FROM fl")
def stream_threshold(spark, folder) -> DataFrame:
    """The threshold that a stream without a saved one falls back to, from its sketch: its rank among all scores is near 99 %."""
    sketch = streaming.score_sketch(_scored_stream(spark, folder))
    path = scratch_path(spark, "sketch")
    streaming.publish_kpis(sketch, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    found = streaming.sketched_threshold(streaming.latest(spark.read.parquet(f"{path}/data")))
    scores = b.events_scored(spark, folder).select("mse_score")
    # of equal scores the rank is a range
    low, high = (F.avg(c.cast("double")) for c in (F.col("mse_score") < F.col("threshold"), F.col("mse_score") <= F.col("threshold")))
    off, share = streaming.rank_error() + 1e-9, 0.99
    return scores.crossJoin(F.broadcast(found)).groupBy("scores").agg(((low <= share + off) & (high >= share - off)).alias("within_bound"))


@query(
    "batch_kpis",
    f"""{EVENTS_SCORED} SELECT count(*) AS processed, count(*) FILTER (flagged) AS alerts,
{even("100.0::DOUBLE * count(*) FILTER (flagged) / count(*)", 4)} AS alert_rate_pct FROM fl""",
)
def batch_kpis(spark, folder) -> DataFrame:
    return streaming.running_kpis(b.events_scored(spark, folder))
