"""Queries of models and stores. Seeded draws and trained weights have no SQL twin: properties of theirs, which SQL can state from
the tables, are queries of their own, and tests check the rest by other means."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions.columns import is_malicious
from residua.functions.materialize import scratch_path
from residua.operators import explain
from residua.operators.autoencoder import Autoencoder
from residua.operators.bootstrap import bootstrap_all, bootstrap_ci
from residua.operators.compare import model_comparison
from residua.operators.confusion import full_report, metrics_report
from residua.operators.forest import IsolationForest
from residua.operators.labels import benign_rows
from residua.operators.reconstruct import PCAReconstructor
from residua.operators.results import top_anomalies
from residua.operators.thresholds import per_class_detection, threshold_sweep
from residua.plans import bindings as b
from residua.plans import jobs
from residua.plans.detection import AnomalyDetector, evaluate_holdout
from residua.plans.oracle import CONFUSION, EVENTS_SCORED, LINEITEM_SCORED, even, ranking_ctes
from residua.plans.queries_detection import _five_sql, _per_class_sql, _sweep_sql, rounded
from residua.plans.registry import query
from residua.sources import sinks
from residua.roles import Roles
from residua.sources.record_index import with_record_index


@query("bootstrap_intervals")
def bootstrap_intervals(spark, folder) -> DataFrame:
    """1000 resamples of five metrics over the held-out rows."""
    return bootstrap_all(b.lineitem_holdout(spark, folder))


@query(
    "bootstrap_values",
    f"""SELECT metric, {even("v", 6)} AS value, TRUE AS inside, TRUE AS ordered FROM {_five_sql(LINEITEM_SCORED)}""",
)
def bootstrap_values(spark, folder) -> DataFrame:
    """Point values, and that every interval is ordered and holds its value."""
    table = bootstrap_all(b.lineitem_holdout(spark, folder), replicates=200)
    inside = F.col("value").between(F.col("lower"), F.col("upper"))
    ordered = (F.col("lower") <= F.col("upper")) & (F.abs(F.col("upper") - F.col("lower") - F.col("width")) < 1e-12)
    return rounded(table.select("metric", "value", inside.alias("inside"), ordered.alias("ordered")))


@query("bootstrap_f1")
def bootstrap_f1(spark, folder) -> DataFrame:
    return bootstrap_ci(b.lineitem_holdout(spark, folder), "f1_score", ci=0.9)


@query(
    "bootstrap_f1_check",
    f"""SELECT metric, {even("v", 6)} AS value, TRUE AS inside, TRUE AS narrower FROM {_five_sql(LINEITEM_SCORED)} WHERE metric = 'f1_score'""",
)
def bootstrap_f1_check(spark, folder) -> DataFrame:
    """The 90 % interval holds the value, and lies inside the 95 % interval of the same draws."""
    scored = b.lineitem_holdout(spark, folder)
    every = bootstrap_all(scored, replicates=1000).filter("metric = 'f1_score'").select("metric", "value", F.col("lower").alias("low"), F.col("upper").alias("high"))
    both = every.join(bootstrap_ci(scored, "f1_score", ci=0.9), "metric")
    inside = F.col("value").between(F.col("lower"), F.col("upper"))
    narrower = (F.col("low") <= F.col("lower")) & (F.col("upper") <= F.col("high"))
    return rounded(both.select("metric", "value", inside.alias("inside"), narrower.alias("narrower")))


@query("pca_score")
def pca_score(spark, folder) -> DataFrame:
    df = b.embeddings(spark, folder)
    detector = b.fit(df, b.EMBEDDINGS, PCAReconstructor())
    return detector.transform(df).select("vec_id", "mse_score", "flagged")


@query("pca_properties", "SELECT count(*) AS rows, count(*) AS scored, TRUE AS never_negative FROM embeddings")
def pca_properties(spark, folder) -> DataFrame:
    """Every vector has a score, and no score is below 0."""
    scored = pca_score(spark, folder)
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.count("mse_score").alias("scored"), (F.min("mse_score") >= 0).alias("never_negative"))


@query("autoencoder_properties", "SELECT count(*) AS rows, count(*) AS scored, TRUE AS never_negative, TRUE AS learned, TRUE AS threshold_agrees FROM lineitem")
def autoencoder_properties(spark, folder) -> DataFrame:
    """Every row has a score of 0 or more, the best validation loss is far below the first, 1 % of the validation rows, to a row, lie over the threshold."""
    df = b.lineitem(spark, folder)
    detector = b.fit(df, b.LINEITEM, Autoencoder())
    losses = detector.model.losses
    over, n = detector.benign_reference(df).agg(F.avg((F.col("mse_score") > detector.threshold).cast("double")), F.count("mse_score")).first()
    scored = detector.transform(df).agg(F.count(F.lit(1)).alias("rows"), F.count("mse_score").alias("scored"), (F.min("mse_score") >= 0).alias("never_negative"))
    return scored.select("*", F.lit(min(losses) < 0.2 * losses[0]).alias("learned"), F.lit(abs(over - 0.01) < max(0.002, 1 / n)).alias("threshold_agrees"))


@query("isolation_forest_properties", "SELECT count(*) AS rows, count(*) AS scored, TRUE AS in_range, TRUE AS flags_agree FROM lineitem")
def isolation_forest_properties(spark, folder) -> DataFrame:
    """Every row has a score between -0.5 and 0.5, and the flag is its sign."""
    scored = isolation_forest_score(spark, folder)
    in_range = (F.min("mse_score") >= -0.5) & (F.max("mse_score") <= 0.5)
    agree = F.count_if(F.col("flagged") != (F.col("mse_score") > 0)) == 0
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.count("mse_score").alias("scored"), in_range.alias("in_range"), agree.alias("flags_agree"))


@query(
    "top_anomalies_with_missing",
    f"""{EVENTS_SCORED}, m AS (SELECT event_id, CASE WHEN user_id % 3 <> 0 THEN mse_score END AS mse_score FROM fl)
SELECT * FROM m ORDER BY mse_score DESC NULLS LAST, event_id LIMIT 200""",
)
def top_anomalies_with_missing(spark, folder) -> DataFrame:
    """Scores of a third of the users are missing, as NaN or null: they rank last."""
    gap = F.when(F.col("user_id") % 2 == 0, F.lit(float("nan")))
    scored = b.events_scored(spark, folder).withColumn("mse_score", F.when(F.col("user_id") % 3 == 0, gap).otherwise(F.col("mse_score")))
    return top_anomalies(scored, 200, key="event_id").select("event_id", "mse_score")


@query("record_index_csv", "SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS record_index FROM events")
def record_index_csv(spark, folder) -> DataFrame:
    """Events in several CSV files in the order of their ids, numbered as they stand there."""
    path = scratch_path(spark, "events-csv")
    ids = b.table(spark, folder, "events").select("event_id")
    ids.repartitionByRange(5, "event_id").sortWithinPartitions("event_id").write.option("header", True).csv(path)
    return with_record_index(spark.read.option("header", True).schema("event_id long").csv(path))


@query("autoencoder_score")
def autoencoder_score(spark, folder) -> DataFrame:
    """Train the autoencoder on benign order lines and score all lines."""
    df = b.lineitem(spark, folder)
    detector = b.fit(df, b.LINEITEM, Autoencoder())
    return detector.transform(df).select("record_key", "mse_score", "flagged")


@query("autoencoder_report")
def autoencoder_report(spark, folder) -> DataFrame:
    """Held-out report of the trained autoencoder next to the isolation forest."""
    df = b.lineitem(spark, folder)
    detector = b.fit(df, b.LINEITEM, Autoencoder())
    return evaluate_holdout(df, detector, IsolationForest()).comparison


def _forest_scored(spark, folder, split: str | None) -> DataFrame:
    df = b.lineitem(spark, folder)
    detector = b.fit(df, b.LINEITEM)
    train = detector.split_rows(benign_rows(df, b.LINEITEM), "train")
    forest = IsolationForest().fit(train, detector.encoder, "record_key")
    rows = df if split is None else detector.split_rows(df, split)
    return forest.transform(rows).withColumn("is_malicious", is_malicious("label"))


@query("isolation_forest_score")
def isolation_forest_score(spark, folder) -> DataFrame:
    return _forest_scored(spark, folder, None).select("record_key", "mse_score", "flagged")


@query("isolation_forest_report")
def isolation_forest_report(spark, folder) -> DataFrame:
    return full_report(_forest_scored(spark, folder, "test"), "test_isolation_forest")


@query("detector_versus_forest")
def detector_versus_forest(spark, folder) -> DataFrame:
    detector = full_report(b.lineitem_holdout(spark, folder))
    forest = full_report(_forest_scored(spark, folder, "test"), "test_isolation_forest")
    return model_comparison(detector, forest, ("mean", "isolation_forest"))


@query("expected_gradients")
def expected_gradients(spark, folder) -> DataFrame:
    """Attributions of the highest flagged vectors under a trained autoencoder."""
    df = b.embeddings(spark, folder)
    detector = b.fit(df, b.EMBEDDINGS, Autoencoder())
    scored = detector.transform(df)
    benign = benign_rows(scored, b.EMBEDDINGS).select("vec_id", *b.EMBEDDINGS.numeric)
    background = explain.background_sample(benign, explain.BACKGROUND_ROWS, "vec_id")
    phi = explain.expected_gradients(detector.model, scored, background, key="vec_id")
    return explain.aggregate_attributions(phi, detector.encoder, key="vec_id")


@query("expected_gradients_check", "SELECT TRUE AS complete, TRUE AS same_rows")
def expected_gradients_check(spark, folder) -> DataFrame:
    """Attributions of a record add up to its score less the mean score of the background, within 5 % of the score."""
    df = b.embeddings(spark, folder)
    detector = b.fit(df, b.EMBEDDINGS, Autoencoder())
    scored = detector.transform(df)
    benign = benign_rows(scored, b.EMBEDDINGS).select("vec_id", *b.EMBEDDINGS.numeric)
    background = explain.background_sample(benign, explain.BACKGROUND_ROWS, "vec_id")
    phi = explain.expected_gradients(detector.model, scored, background, steps=32, key="vec_id")
    base = explain.base_value(detector.model, background).first()[0]
    off = F.abs(F.aggregate("phi", F.lit(0.0), lambda a, v: a + v) - (F.col("mse_score") - F.lit(base)))
    flagged = scored.agg(F.least(F.count_if("flagged"), F.lit(explain.EXPLAINED_ROWS))).first()[0]
    complete = F.coalesce(F.max(off / F.greatest("mse_score", F.lit(1e-9))), F.lit(0.0)) < 0.05
    return phi.agg(complete.alias("complete"), (F.count(F.lit(1)) == flagged).alias("same_rows"))


@query("base_value", f"{LINEITEM_SCORED} SELECT {even('avg(mse_score)', 6)} AS base_value FROM test WHERE label = 'Benign'")
def base_value(spark, folder) -> DataFrame:
    """Mean score of a background, here the benign held-out rows: where a waterfall starts."""
    df = b.lineitem(spark, folder)
    detector = b.fit(df, b.LINEITEM)
    background = benign_rows(detector.split_rows(df, "test"), b.LINEITEM)
    return rounded(explain.base_value(detector, background))


@query(
    "attributions_of_dimensions",
    f"""SELECT vec_id, feature, {even("raw", 6)} AS phi FROM (
SELECT vec_id, unnest(['numbers', 'odd', 'rest']) AS feature, unnest([
  list_sum([CAST(x AS DOUBLE) FOR x IN embedding[1:3]]), CAST(embedding[4] AS DOUBLE), list_sum([CAST(x AS DOUBLE) FOR x IN embedding[5:64]])]) AS raw FROM embeddings)""",
)
def attributions_of_dimensions(spark, folder) -> DataFrame:
    """Given attributions per encoded dimension, here the vectors themselves, summed back to the columns they encode."""
    phi = b.table(spark, folder, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("phi"))
    blocks = {"numbers": [0, 1, 2], "odd": [3], "rest": list(range(4, b.EMBEDDING_WIDTH))}
    return rounded(explain.aggregate_attributions(phi, blocks, key="vec_id"))


@query(
    "log_job",
    "SELECT count(*) AS rows, CAST(ceil(count(*) * 0.15) AS BIGINT) AS test_rows, TRUE AS saved_agrees, TRUE AS forest_compared FROM events",
)
def log_job(spark, folder) -> DataFrame:
    """From log files to a table, a saved detector and its reports, and the saved detector evaluated again."""
    path = b.write_lines(b.event_log_lines(spark, folder))
    out = scratch_path(spark, "job")
    jobs.preprocess(spark, f"{path}/*", f"{out}/table")
    df = jobs.load_processed(spark, f"{out}/table")
    jobs.build_detector(df, Roles(ids=("uid",), categorical=("tunnel_parents",), numeric=("id_resp_p",)), f"{out}/first", forest=IsolationForest(n_trees=20))
    jobs.evaluate_saved(df, f"{out}/first/detector", f"{out}/second")
    cells = ("tp", "fp", "tn", "fn")
    first, second = (sinks.read_metrics_json(spark, f"{out}/{n}/report").select(*cells) for n in ("first", "second"))
    compared = sinks.read_metrics_json(spark, f"{out}/first/comparison").count() == 5
    total = first.select(sum((F.col(c) for c in cells), F.lit(0)).cast("bigint").alias("test_rows"))
    agrees = first.first() == second.first()
    return total.select(F.lit(df.count()).cast("bigint").alias("rows"), "test_rows", F.lit(agrees).alias("saved_agrees"), F.lit(compared).alias("forest_compared"))


@query("metrics_roundtrip", f"{_sweep_sql(EVENTS_SCORED)} SELECT percentile, threshold, \"precision\", recall, f1_score FROM swp")
def metrics_roundtrip(spark, folder) -> DataFrame:
    """The sweep written as JSON and read back."""
    df = b.events(spark, folder)
    detector = b.fit(df, b.EVENTS)
    path = scratch_path(spark, "sweep")
    sinks.write_metrics(threshold_sweep(detector.holdout(df), detector.benign_reference(df)), path)
    return rounded(sinks.read_metrics_json(spark, path).select("percentile", "threshold", "precision", "recall", "f1_score"))


def _markdown_sql() -> str:
    """The report's fields as lines of a Markdown table."""
    number = {"threshold_mse": ("t", 6), "precision": ('"precision"', 4), "recall": ("recall", 4), "f1_score": ("f1_score", 4), "pr_auc": ("pr_auc", 4)}
    count = {"rows_scored": "tp + fp + tn + fn", "flagged_count": "tp + fp", "true_malicious_label_count": "tp + fn"}
    value = lambda c: f"printf('%.{number[c][1]}f', {number[c][0]})" if c in number else f"CAST({count.get(c, c)} AS VARCHAR)"
    fields = [c for c, _ in sinks.MARKDOWN_FIELDS if c != "data_source"]
    lines = " UNION ALL ".join(f"SELECT '| {c} | ' || coalesce({value(c)}, '-') || ' |' FROM met CROSS JOIN auc CROSS JOIN thr" for c in fields)
    return (
        f"{EVENTS_SCORED}, {CONFUSION}, {ranking_ctes('test')}, md(line) AS (SELECT '| field | value |' UNION ALL SELECT '|---|---|' "
        f"UNION ALL SELECT '| data_source | events |' UNION ALL {lines}) SELECT line FROM md"
    )


@query("report_markdown", _markdown_sql())
def report_markdown(spark, folder) -> DataFrame:
    df = b.events(spark, folder)
    detector = b.fit(df, b.EVENTS)
    return sinks.report_markdown(metrics_report(detector.holdout(df), detector.threshold, "events"))


@query("detector_roundtrip", f"{EVENTS_SCORED}, {_per_class_sql('fl', 'TRUE')} SELECT * FROM pc")
def detector_roundtrip(spark, folder) -> DataFrame:
    """A detector as the stage of a pipeline: fitted, saved, loaded and applied to the whole table."""
    df = b.events(spark, folder)
    path = scratch_path(spark, "detector")
    Pipeline(stages=[AnomalyDetector(b.EVENTS, score_places=b.SCORE_PLACES)]).fit(df).save(path)
    return per_class_detection(PipelineModel.load(path).transform(df))
