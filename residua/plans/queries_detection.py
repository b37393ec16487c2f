"""Queries over splits, encoding, scores, thresholds and detection quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions.columns import half_even
from residua.functions.quantiles import exact_quantiles
from residua.operators import compare, confusion, curves, distribution, split, thresholds
from residua.operators.labels import benign_counts, benign_rows
from residua.operators.reconstruct import reconstruction_mse as mse
from residua.plans import bindings as b
from residua.plans.oracle import (
    CONFUSION,
    EVENTS_SCORED,
    EVENTS_SPLIT,
    LINEITEM_BASE,
    LINEITEM_CATEGORICAL,
    LINEITEM_NUMERIC,
    LINEITEM_SCORED,
    even,
    ranking_ctes,
    scored_ctes,
)
from residua.plans.registry import query
from residua.roles import Roles
from residua.sources import sinks

PRF = ("precision", "recall", "f1_score")
PRF_SQL = ", ".join(f'{even(f"""{q}""", 6)} AS {q}' for q in ('"precision"', "recall", "f1_score"))
CELLS_SQL = "tp, fp, tn, fn"


def rounded(df: DataFrame, places: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every double column rounded, so engines that sum in another order agree."""
    doubles = [c for c, t in df.dtypes if t == "double" and c not in keep]
    return df.withColumns({c: half_even(F.col(c), places) for c in doubles}) if doubles else df


# ---- splits ----------------------------------------------------------------------------------------------------


def _events_split(spark, folder) -> DataFrame:
    df = b.events(spark, folder)
    return split.StratifiedSplit(key="event_id").fit(df).transform(df)


@query("split_assignment", f"{EVENTS_SPLIT} SELECT event_id, label, split FROM sp")
def split_assignment(spark, folder) -> DataFrame:
    return _events_split(spark, folder).select("event_id", "label", "split")


@query(
    "split_by_detail_label",
    EVENTS_SPLIT.replace("label AS cl", "detailed_label AS cl")
    .replace("PARTITION BY label", "PARTITION BY detailed_label")
    .replace("p.label = q.cl", "p.detailed_label = q.cl")
    + " SELECT event_id, detailed_label, split FROM sp",
)
def split_by_detail_label(spark, folder) -> DataFrame:
    """Stratified over several classes, with quotas rounded by largest remainder."""
    df = b.events(spark, folder)
    model = split.StratifiedSplit(label="detailed_label", key="event_id").fit(df)
    return model.transform(df).select("event_id", "detailed_label", "split")


@query(
    "split_counts",
    f"""{EVENTS_SPLIT} SELECT split, count(*) AS "rows" FROM sp GROUP BY 1
UNION ALL SELECT 'total', count(*) FROM sp""",
)
def split_counts(spark, folder) -> DataFrame:
    return split.split_counts(_events_split(spark, folder))


@query(
    "split_invariants",
    "SELECT 0::BIGINT AS unassigned, 0::BIGINT AS in_two_splits, (count(*) - count(DISTINCT event_id))::BIGINT AS "
    "repeated_keys, count(DISTINCT event_id) AS keys FROM events",
)
def split_invariants(spark, folder) -> DataFrame:
    return split.split_invariants(_events_split(spark, folder), "event_id")


@query(
    "benign_rows_per_split",
    f"{EVENTS_SPLIT} SELECT split, count(*) FILTER (label = 'Benign') AS benign_rows FROM sp GROUP BY 1",
)
def benign_rows_per_split(spark, folder) -> DataFrame:
    return benign_counts(_events_split(spark, folder), b.EVENTS)


@query("benign_training_rows", f"{EVENTS_SPLIT} SELECT event_id FROM sp WHERE split = 'train' AND label = 'Benign'")
def benign_training_rows(spark, folder) -> DataFrame:
    df = b.events(spark, folder)
    return split.StratifiedSplit(key="event_id").fit(df).rows(benign_rows(df, b.EVENTS), "train").select("event_id")


# ---- encoding and scores ---------------------------------------------------------------------------------------


def _fitted(spark, folder):
    df = b.lineitem(spark, folder)
    return df, b.fit(df, b.LINEITEM)


@query(
    "encode_numeric",
    f"{LINEITEM_SCORED} SELECT record_key, "
    + ", ".join(f"{even(f'({c} - m_{c}) / s_{c}', 6)} AS {c}" for c in LINEITEM_NUMERIC)
    + " FROM sp CROSS JOIN st",
)
def encode_numeric(spark, folder) -> DataFrame:
    df, detector = _fitted(spark, folder)
    encoder = detector.encoder
    scaled = [half_even(z, 6).alias(c) for c, z in zip(encoder.numeric, encoder.scaled(), strict=True)]
    return df.select("record_key", *scaled)


ORDINALS = ", ".join(f"o_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS o FROM cat_{c})" for c in LINEITEM_CATEGORICAL)
SECOND = f"(SELECT count(*) FROM cat_{LINEITEM_CATEGORICAL[0]})"
FIRST_SLOT = len(LINEITEM_NUMERIC)


@query(
    "encode_categorical",
    f"""{LINEITEM_SCORED}, {ORDINALS}
SELECT record_key, ({FIRST_SLOT} + a.o)::BIGINT AS l_linestatus, ({FIRST_SLOT} + {SECOND} + b.o)::BIGINT AS ship_month
FROM sp LEFT JOIN o_l_linestatus a ON sp.l_linestatus = a.v LEFT JOIN o_ship_month b ON sp.ship_month = b.v""",
)
def encode_categorical(spark, folder) -> DataFrame:
    """Vector index of the slot every categorical value takes."""
    df, detector = _fitted(spark, folder)
    encoded = detector.encoder.transform(df)
    return encoded.select(
        "record_key",
        *[F.get("enc_cat", F.lit(i)).cast("bigint").alias(c) for i, c in enumerate(detector.encoder.categorical)],
    )


@query(
    "feature_groups",
    f"""{LINEITEM_SCORED}, {ORDINALS}
{" UNION ALL ".join(f"SELECT '{c}' AS feature, {i} AS idx" for i, c in enumerate(LINEITEM_NUMERIC))}
UNION ALL SELECT 'l_linestatus', ({FIRST_SLOT} + o)::INTEGER FROM o_l_linestatus
UNION ALL SELECT 'ship_month', ({FIRST_SLOT} + {SECOND} + o)::INTEGER FROM o_ship_month""",
)
def feature_groups(spark, folder) -> DataFrame:
    _, detector = _fitted(spark, folder)
    return detector.encoder.feature_groups_table(spark)


@query("mean_reconstruction_score", f"{LINEITEM_SCORED} SELECT record_key, mse_score FROM scored")
def mean_reconstruction_score(spark, folder) -> DataFrame:
    df, detector = _fitted(spark, folder)
    return detector.with_score(df).select("record_key", "mse_score")


@query("score_events", f"{EVENTS_SCORED} SELECT event_id, mse_score, flagged, is_malicious FROM fl")
def score_events(spark, folder) -> DataFrame:
    return b.events_scored(spark, folder).select("event_id", "mse_score", "flagged", "is_malicious")


SQUARES = " + ".join(f"pow(({c} - m_{c}) / s_{c}, 2)" for c in LINEITEM_NUMERIC)


@query(
    "reconstruction_mse",
    f"""{LINEITEM_SCORED}
SELECT record_key, {even(f"({SQUARES}) / {len(LINEITEM_NUMERIC)}", 6)} AS mse
FROM sp CROSS JOIN st""",
)
def reconstruction_mse(spark, folder) -> DataFrame:
    """Array form of the error: the scaled numbers against their training mean, zero."""
    df, detector = _fitted(spark, folder)
    encoded = detector.encoder.transform(df)
    zeros = F.array(*[F.lit(0.0) for _ in LINEITEM_NUMERIC])
    return encoded.select("record_key", half_even(mse(F.col("enc_num"), zeros), 6).alias("mse"))


@query("fit_threshold", f"{LINEITEM_SCORED} SELECT {even('t', 6)} AS threshold FROM thr")
def fit_threshold(spark, folder) -> DataFrame:
    _, detector = _fitted(spark, folder)
    return spark.range(1).select(half_even(F.lit(detector.threshold), 6).alias("threshold"))


@query(
    "threshold_fallback",
    f"{EVENTS_SCORED} SELECT {even('quantile_cont(mse_score, 0.99)', 6)} AS threshold FROM scored",
)
def threshold_fallback(spark, folder) -> DataFrame:
    """Without a saved threshold: the 99th percentile of all scores."""
    threshold = thresholds.fit_threshold(b.events_scored(spark, folder))
    return spark.range(1).select(half_even(F.lit(threshold), 6).alias("threshold"))


@query("flagged_rows", f"{LINEITEM_SCORED} SELECT record_key, mse_score FROM test WHERE flagged")
def flagged_rows(spark, folder) -> DataFrame:
    return b.lineitem_holdout(spark, folder).filter("flagged").select("record_key", "mse_score")


@query(
    "flag_rate",
    f"""{LINEITEM_SCORED} SELECT count(*) AS "rows", count(*) FILTER (flagged) AS flagged,
{even("100.0::DOUBLE * count(*) FILTER (flagged) / count(*)", 4)} AS flagged_pct,
count(*) FILTER (NOT flagged) AS not_flagged FROM test""",
)
def flag_rate(spark, folder) -> DataFrame:
    return confusion.flag_rate(b.lineitem_holdout(spark, folder))


@query(
    "threshold_context",
    f"""{LINEITEM_SCORED} SELECT count(*) FILTER (mse_score > t) AS above,
{even("count(*) FILTER (mse_score > t * 1.10) / count(*)", 6)} AS above_margin,
{even("count(*) FILTER (mse_score >= t * 0.95 AND mse_score <= t * 1.05) / count(*)", 6)} AS near_band
FROM test CROSS JOIN thr""",
)
def threshold_context(spark, folder) -> DataFrame:
    df, detector = _fitted(spark, folder)
    return rounded(thresholds.threshold_context(detector.holdout(df), detector.threshold))


# ---- confusion and reports -------------------------------------------------------------------------------------


@query("confusion_counts", f"{LINEITEM_SCORED}, {CONFUSION} SELECT {CELLS_SQL} FROM conf")
def confusion_counts(spark, folder) -> DataFrame:
    return confusion.confusion_counts(b.lineitem_holdout(spark, folder))


@query(
    "contingency",
    f"""{LINEITEM_SCORED}, {CONFUSION} SELECT 'Flagged (anomaly)' AS prediction, tp AS malicious, fp AS benign FROM conf
UNION ALL SELECT 'Not flagged (normal)', fn, tn FROM conf""",
)
def contingency(spark, folder) -> DataFrame:
    return confusion.contingency_matrix(b.lineitem_holdout(spark, folder))


@query(
    "confusion_long",
    f"""{LINEITEM_SCORED}, {CONFUSION}
SELECT actual, predicted, "count", actual || ' | ' || predicted AS cell FROM (
SELECT 'Malicious' AS actual, 'Flagged' AS predicted, tp AS "count" FROM conf
UNION ALL SELECT 'Malicious', 'Not flagged', fn FROM conf UNION ALL SELECT 'Benign', 'Flagged', fp FROM conf
UNION ALL SELECT 'Benign', 'Not flagged', tn FROM conf)""",
)
def confusion_long(spark, folder) -> DataFrame:
    return confusion.confusion_long(b.lineitem_holdout(spark, folder))


@query("fp_fn", f"{LINEITEM_SCORED}, {CONFUSION} SELECT fp AS false_positives, fn AS false_negatives FROM conf")
def fp_fn(spark, folder) -> DataFrame:
    return confusion.false_positive_negative(b.lineitem_holdout(spark, folder))


def _month_sql(undefined: str) -> str:
    ratio = "CASE WHEN {d} > 0 THEN {n} / ({d}) ELSE " + undefined + " END"
    p, r = ratio.format(n="tp", d="tp + fp"), ratio.format(n="tp", d="tp + fn")
    return f"""{LINEITEM_SCORED}, m AS (SELECT ship_month, l_linestatus, l_quantity,
  count(*) FILTER (flagged AND is_malicious) AS tp, count(*) FILTER (flagged AND NOT is_malicious) AS fp,
  count(*) FILTER (NOT flagged AND NOT is_malicious) AS tn, count(*) FILTER (NOT flagged AND is_malicious) AS fn
  FROM test GROUP BY ALL),
pr AS (SELECT *, {p} AS p, {r} AS r FROM m)
SELECT ship_month, l_linestatus, l_quantity, tp, fp, tn, fn, {even("p", 6)} AS "precision", {even("r", 6)} AS recall,
       {even(f"CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE {undefined} END", 6)} AS f1_score FROM pr"""


GROUPS = ("ship_month", "l_linestatus", "l_quantity")


@query("prf_null", _month_sql("NULL"))
def prf_null(spark, folder) -> DataFrame:
    """Small groups, many without flags: undefined values are null."""
    scored = b.lineitem_holdout(spark, folder)
    return rounded(confusion.classification_metrics(scored, GROUPS, undefined="null"), keep=("l_quantity",))


@query("prf_zero", _month_sql("0.0"))
def prf_zero(spark, folder) -> DataFrame:
    scored = b.lineitem_holdout(spark, folder)
    return rounded(confusion.classification_metrics(scored, GROUPS, undefined="zero"), keep=("l_quantity",))


RANKED = f"{LINEITEM_SCORED}, {CONFUSION}, {ranking_ctes('test')}"
AUC_SQL = f"{even('pr_auc', 6)} AS pr_auc, {even('roc_auc', 6)} AS roc_auc"


@query("holdout_report", f"{RANKED} SELECT 'test' AS split, {PRF_SQL}, {CELLS_SQL}, {AUC_SQL} FROM met CROSS JOIN auc")
def holdout_report(spark, folder) -> DataFrame:
    """Fit on benign training rows, score the held-out rows, report detection quality."""
    return rounded(confusion.full_report(b.lineitem_holdout(spark, folder)))


@query(
    "metrics_report",
    f"""{RANKED} SELECT 1 AS report_schema_version, 'lineitem' AS data_source, (tp + fp + tn + fn)::BIGINT AS rows_scored,
(tp + fp)::BIGINT AS flagged_count, (tp + fn)::BIGINT AS true_malicious_label_count, {even("t", 6)} AS threshold_mse,
{CELLS_SQL}, {PRF_SQL}, {even("pr_auc", 6)} AS pr_auc FROM met CROSS JOIN auc CROSS JOIN thr""",
)
def metrics_report(spark, folder) -> DataFrame:
    df, detector = _fitted(spark, folder)
    return rounded(confusion.metrics_report(detector.holdout(df), detector.threshold, "lineitem"))


@query(
    "metrics_report_unlabelled",
    f"""{EVENTS_SCORED} SELECT 1 AS report_schema_version, 'events' AS data_source, count(*) AS rows_scored,
count(*) FILTER (flagged) AS flagged_count, NULL::BIGINT AS true_malicious_label_count, {even("max(t)", 6)} AS threshold_mse,
NULL::BIGINT AS tp, NULL::BIGINT AS fp, NULL::BIGINT AS tn, NULL::BIGINT AS fn, NULL::DOUBLE AS "precision",
NULL::DOUBLE AS recall, NULL::DOUBLE AS f1_score, NULL::DOUBLE AS pr_auc FROM fl CROSS JOIN thr""",
)
def metrics_report_unlabelled(spark, folder) -> DataFrame:
    df = b.events(spark, folder)
    detector = b.fit(df, b.EVENTS)
    scored = detector.transform(df.drop("label", "detailed_label"))
    return rounded(confusion.metrics_report(scored, detector.threshold, "events", labelled=False))


@query(
    "metrics_long",
    f"""{RANKED} SELECT metric, {even("value", 6)} AS value FROM (
SELECT 'precision' AS metric, "precision" AS value FROM met UNION ALL SELECT 'recall', recall FROM met
UNION ALL SELECT 'f1_score', f1_score FROM met UNION ALL SELECT 'pr_auc', pr_auc FROM auc)""",
)
def metrics_long(spark, folder) -> DataFrame:
    return rounded(confusion.metrics_long(confusion.full_report(b.lineitem_holdout(spark, folder))))


@query(
    "metrics_json",
    f"""{RANKED} SELECT 'test' AS split, {CELLS_SQL}, {PRF_SQL}, {AUC_SQL} FROM met CROSS JOIN auc""",
)
def metrics_json(spark, folder) -> DataFrame:
    """The report as strict JSON text, parsed back."""
    report = confusion.full_report(b.lineitem_holdout(spark, folder))
    schema = "split string, tp bigint, fp bigint, tn bigint, fn bigint, precision double, recall double, f1_score double, pr_auc double, roc_auc double"
    return rounded(sinks.report_json(report).select(F.from_json("json", schema).alias("r")).select("r.*"))


# ---- thresholds, classes, distributions ------------------------------------------------------------------------

def _sweep_sql(scored: str) -> str:
    return f"""{scored},
pct AS (SELECT unnest([90.0, 95.0, 97.0, 98.0, 99.0, 99.5, 99.9]::DOUBLE[]) AS percentile),
ref AS (SELECT quantile_cont(mse_score, [0.90, 0.95, 0.97, 0.98, 0.99, 0.995, 0.999]) AS q
        FROM scored WHERE split = 'val' AND label = 'Benign'),
cuts AS (SELECT percentile, (SELECT q FROM ref)[row_number() OVER (ORDER BY percentile)] AS threshold FROM pct),
cnt AS (SELECT percentile, threshold, count(*) FILTER (mse_score > threshold AND is_malicious) AS tp,
               count(*) FILTER (mse_score > threshold AND NOT is_malicious) AS fp,
               count(*) FILTER (mse_score <= threshold AND NOT is_malicious) AS tn,
               count(*) FILTER (mse_score <= threshold AND is_malicious) AS fn
        FROM test CROSS JOIN cuts GROUP BY ALL),
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r FROM cnt),
swp AS (SELECT percentile, {even("threshold", 6)} AS threshold, {even("p", 6)} AS "precision", {even("r", 6)} AS recall,
        {even("CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END", 6)} AS f1_score, tp, fp, tn, fn FROM pr)"""


SWEEP = _sweep_sql(LINEITEM_SCORED)


def _sweep(spark, folder) -> DataFrame:
    df, detector = _fitted(spark, folder)
    return rounded(thresholds.threshold_sweep(detector.holdout(df), detector.benign_reference(df)))


@query("threshold_sweep", f"{SWEEP} SELECT * FROM swp")
def threshold_sweep(spark, folder) -> DataFrame:
    return _sweep(spark, folder)


@query(
    "sweep_series",
    f"""{SWEEP} SELECT percentile, 'precision' AS metric, "precision" AS value FROM swp
UNION ALL SELECT percentile, 'recall', recall FROM swp UNION ALL SELECT percentile, 'f1_score', f1_score FROM swp""",
)
def sweep_series(spark, folder) -> DataFrame:
    return thresholds.sweep_series(_sweep(spark, folder))


def _per_class_sql(source: str, where: str) -> str:
    return f"""pc AS (SELECT detailed_label AS attack_type, count(*) AS "count", count(*) FILTER (flagged) AS detected,
{even("count(*) FILTER (flagged) / count(*)", 4)} AS detection_rate, {even("avg(mse_score)", 6)} AS avg_mse,
{even("quantile_cont(mse_score, 0.5)", 6)} AS median_mse FROM {source} WHERE {where} GROUP BY 1)"""


PER_CLASS = _per_class_sql("test", "lower(detailed_label) <> 'benign'")


@query("per_class_detection", f"{LINEITEM_SCORED}, {PER_CLASS} SELECT * FROM pc")
def per_class_detection(spark, folder) -> DataFrame:
    return thresholds.per_class_detection(b.lineitem_holdout(spark, folder))


@query(
    "per_class_detection_by_label",
    f"{LINEITEM_SCORED}, {_per_class_sql('test', 'is_malicious')} SELECT * FROM pc",
)
def per_class_detection_by_label(spark, folder) -> DataFrame:
    """Benign rows left out by their label, not by their detail label."""
    return thresholds.per_class_detection(b.lineitem_holdout(spark, folder), benign_from="label")


@query(
    "class_breakdown",
    f"""{EVENTS_SCORED}, {_per_class_sql("fl", "TRUE")}
SELECT *, 'n=' || "count" || '  (' || CAST(round_even(detection_rate * 100, 0) AS BIGINT) || '%)' AS text FROM pc""",
)
def class_breakdown(spark, folder) -> DataFrame:
    return thresholds.class_breakdown(thresholds.per_class_detection(b.events_scored(spark, folder)))


QUANTILE_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS statistic, {even(f'quantile_cont(mse_score, {p})', 6)} AS score FROM fl"
    for name, p in distribution.SHOWN_QUANTILES.items()
)


@query("score_quantiles", f"{LINEITEM_SCORED} {QUANTILE_ROWS}")
def score_quantiles(spark, folder) -> DataFrame:
    df, detector = _fitted(spark, folder)
    return rounded(distribution.score_quantiles(detector.transform(df)))


@query(
    "score_summary",
    f"""{LINEITEM_SCORED} SELECT {even("avg(mse_score)", 6)} AS mean, {even("stddev_pop(mse_score)", 6)} AS std,
{even("min(mse_score)", 6)} AS min, {even("quantile_cont(mse_score, 0.5)", 6)} AS median, {even("max(mse_score)", 6)} AS max
FROM scored WHERE split = 'val' AND label = 'Benign'""",
)
def score_summary(spark, folder) -> DataFrame:
    df, detector = _fitted(spark, folder)
    return rounded(distribution.score_summary(detector.benign_reference(df)))


def _histogram_sql(source: str, bins: int, by: str = "") -> str:
    """``h``: bin counts by numbering rows against the printed edges."""
    keys = f"{by}, " if by else ""
    return f"""rg AS (SELECT min(mse_score) AS lo, max(mse_score) AS hi, {bins} AS nb FROM {source}),
edges AS (SELECT i::INTEGER AS bin, i * ((hi - lo) / nb) + lo AS bin_start,
                 CASE WHEN i = nb - 1 THEN hi ELSE (i + 1) * ((hi - lo) / nb) + lo END AS bin_end, nb
          FROM rg, range(0, nb) AS r(i)),
h AS (SELECT {keys}e.bin, count(*) AS n FROM {source} s JOIN edges e
      ON s.mse_score >= e.bin_start AND (s.mse_score < e.bin_end OR (e.bin = e.nb - 1 AND s.mse_score <= e.bin_end))
      GROUP BY ALL)"""


@query(
    "score_histogram",
    f"""{LINEITEM_SCORED}, {_histogram_sql("fl", 40)}
SELECT bin, {even("bin_start", 6)} AS bin_start, {even("bin_end", 6)} AS bin_end, coalesce(n, 0) AS "count"
FROM edges LEFT JOIN h USING (bin)""",
)
def score_histogram(spark, folder) -> DataFrame:
    df, detector = _fitted(spark, folder)
    return rounded(distribution.score_histogram(detector.transform(df)))


@query(
    "score_histogram_sampled",
    f"""{EVENTS_SCORED}, sample AS (SELECT mse_score FROM fl ORDER BY event_id LIMIT 12000),
{_histogram_sql("sample", 0).replace("0 AS nb", "least(28, greatest(8, floor(sqrt(count(*)))))::BIGINT AS nb")}
SELECT bin, {even("(bin_start + bin_end) / 2", 6)} AS mid, coalesce(n, 0) AS "count" FROM edges LEFT JOIN h USING (bin)""",
)
def score_histogram_sampled(spark, folder) -> DataFrame:
    scored = b.events_scored(spark, folder)
    return rounded(distribution.score_histogram_sampled(scored, order="event_id"))


@query(
    "score_histogram_by_class",
    f"""{LINEITEM_SCORED}, {_histogram_sql("test", 80, "label")},
tot AS (SELECT label, sum(n) AS total FROM h GROUP BY 1)
SELECT t.label AS "class", e.bin, {even("bin_start", 6)} AS bin_start, {even("bin_end", 6)} AS bin_end,
       coalesce(n, 0) AS "count", {even("coalesce(n, 0) / (total * ((SELECT hi - lo FROM rg) / 80))", 6)} AS density
FROM edges e CROSS JOIN tot t LEFT JOIN h ON h.bin = e.bin AND h.label = t.label""",
)
def score_histogram_by_class(spark, folder) -> DataFrame:
    return rounded(distribution.score_histogram_by_class(b.lineitem_holdout(spark, folder)))


# ---- curves and comparison -------------------------------------------------------------------------------------


UNTIED = f"{LINEITEM_SCORED}, {ranking_ctes('test')}"
TIED = f"{LINEITEM_SCORED}, tied AS (SELECT is_malicious, {even('mse_score', 2)} AS mse_score FROM test), {ranking_ctes('tied')}"


@query("average_precision", f"{UNTIED} SELECT {even('pr_auc', 6)} AS pr_auc FROM auc")
def average_precision(spark, folder) -> DataFrame:
    return rounded(curves.ranking_metrics(b.lineitem_holdout(spark, folder)).select("pr_auc"))


@query("roc_auc", f"{UNTIED} SELECT {even('roc_auc', 6)} AS roc_auc FROM auc")
def roc_auc(spark, folder) -> DataFrame:
    return rounded(curves.ranking_metrics(b.lineitem_holdout(spark, folder)).select("roc_auc"))


@query("ranking_metrics_tied", f"{TIED} SELECT {AUC_SQL} FROM auc")
def ranking_metrics_tied(spark, folder) -> DataFrame:
    """Scores with two decimals: most rows share their score with others."""
    scored = b.lineitem_holdout(spark, folder).withColumn("mse_score", half_even(F.col("mse_score"), 2))
    return rounded(curves.ranking_metrics(scored))


@query("roc_auc_buckets", f"{UNTIED} SELECT {AUC_SQL} FROM auc")
def roc_auc_buckets(spark, folder) -> DataFrame:
    """The same ranking cut into many buckets."""
    return rounded(curves.ranking_metrics(b.lineitem_holdout(spark, folder), rows_per_bucket=500))


@query("threshold_sweep_bins", f"{SWEEP} SELECT percentile, threshold FROM swp")
def threshold_sweep_bins(spark, folder) -> DataFrame:
    """The sweep's thresholds through coarse bins that have to be refined."""
    df, detector = _fitted(spark, folder)
    shares = [p / 100.0 for p in thresholds.SWEEP_PERCENTILES]
    cuts = exact_quantiles(detector.benign_reference(df), {"s": F.col("mse_score")}, shares, bins=16, pick_rows=20)["s"]
    rows = list(zip(thresholds.SWEEP_PERCENTILES, cuts, strict=True))
    return rounded(spark.createDataFrame(rows, "percentile double, threshold double"))


@query(
    "pr_curve",
    f"""{UNTIED} SELECT score AS threshold, {even("tp / (tp + fp)", 6)} AS "precision", {even("tp / all_pos", 6)} AS recall
FROM rk UNION ALL SELECT NULL, 1.0, 0.0""",
)
def pr_curve(spark, folder) -> DataFrame:
    return rounded(curves.pr_curve(b.lineitem_holdout(spark, folder)), keep=("threshold",))


@query(
    "pr_curve_area",
    f"""{UNTIED}, pts AS (SELECT score, tp / (tp + fp) AS p, tp / all_pos AS r FROM rk),
stp AS (SELECT r - lag(r, 1, 0.0::DOUBLE) OVER w AS dr, p + lag(p, 1, 1.0::DOUBLE) OVER w AS pp FROM pts
        WINDOW w AS (ORDER BY score DESC))
SELECT {even("sum(dr * pp / 2)", 6)} AS pr_area,
       (SELECT {even("max(all_pos) / (max(all_pos) + max(all_neg))", 6)} FROM rk) AS prevalence FROM stp""",
)
def pr_curve_area(spark, folder) -> DataFrame:
    return rounded(curves.pr_curve_area(b.lineitem_holdout(spark, folder)))


@query(
    "roc_curve",
    f"""{UNTIED}, stp AS (SELECT *, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, row_number() OVER w AS i
FROM rk WINDOW w AS (ORDER BY score DESC))
SELECT score AS threshold, {even("fp / all_neg", 6)} AS fpr, {even("tp / all_pos", 6)} AS tpr FROM stp
WHERE i = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT NULL, 0.0, 0.0""",
)
def roc_curve(spark, folder) -> DataFrame:
    return rounded(curves.roc_curve(b.lineitem_holdout(spark, folder)), keep=("threshold",))


@query(
    "roc_curve_area",
    f"""{UNTIED}, pts AS (SELECT score, fp / all_neg AS x, tp / all_pos AS y FROM rk),
stp AS (SELECT x - lag(x, 1, 0.0::DOUBLE) OVER w AS dx, y + lag(y, 1, 0.0::DOUBLE) OVER w AS yy FROM pts
        WINDOW w AS (ORDER BY score DESC))
SELECT {even("sum(dx * yy / 2)", 6)} AS roc_area FROM stp""",
)
def roc_curve_area(spark, folder) -> DataFrame:
    return rounded(curves.roc_curve_area(b.lineitem_holdout(spark, folder)))


NUMBERS_ONLY = Roles(key="record_key", ids=(), numeric=LINEITEM_NUMERIC, categorical=())
PLAIN_SCORED = "WITH " + scored_ctes(LINEITEM_BASE, "record_key", LINEITEM_NUMERIC, ())
FIVE = ("precision", "recall", "f1_score", "pr_auc", "roc_auc")


def _five_sql(scored: str) -> str:
    """The five metrics of the test rows in long form."""
    source = {m: "auc" if m.endswith("auc") else "met" for m in FIVE}
    rows = " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, CAST(coalesce("{m}", 0.0) AS DOUBLE) AS v FROM {t}""" for m, t in source.items()
    )
    return f"({scored}, {CONFUSION}, {ranking_ctes('test')} {rows})"


def _reports(spark, folder) -> tuple[DataFrame, DataFrame]:
    df = b.lineitem(spark, folder)
    full = confusion.full_report(b.fit(df, b.LINEITEM).holdout(df))
    plain = confusion.full_report(b.fit(df, NUMBERS_ONLY).holdout(df))
    return full, plain


@query(
    "model_comparison",
    f"""SELECT metric, {even("a.v", 6)} AS all_features, {even("b.v", 6)} AS numbers_only, {even("a.v - b.v", 6)} AS difference
FROM {_five_sql(LINEITEM_SCORED)} a JOIN {_five_sql(PLAIN_SCORED)} b USING (metric)""",
)
def model_comparison(spark, folder) -> DataFrame:
    """The detector with all features next to one with numbers only."""
    return rounded(compare.model_comparison(*_reports(spark, folder), ("all_features", "numbers_only")))


@query(
    "baseline_join",
    f"""SELECT metric, {even("a.v", 6)} AS value, {even("b.v", 6)} AS baseline_value
FROM (SELECT * FROM {_five_sql(LINEITEM_SCORED)} WHERE metric <> 'roc_auc') a
LEFT JOIN (SELECT * FROM {_five_sql(PLAIN_SCORED)} WHERE metric <> 'roc_auc') b USING (metric)""",
)
def baseline_join(spark, folder) -> DataFrame:
    """Metrics under display names joined to a baseline under plain keys."""
    report, baseline = _reports(spark, folder)
    accuracy = baseline.withColumn("accuracy", F.lit(None).cast("double"))
    metrics = confusion.metrics_long(report)
    display = {key: name for name, key in compare.METRIC_KEYS.items()}
    shown = F.element_at(F.create_map(*[F.lit(x) for pair in display.items() for x in pair]), F.col("metric"))
    return rounded(compare.with_baseline(metrics.withColumn("metric", shown), sinks.baseline_table(accuracy)))
