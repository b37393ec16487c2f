import numpy as np
import pytest
from pyspark.sql import functions as F

from residua.operators import dense_net as net
from residua.operators import explain
from residua.operators.autoencoder import Autoencoder
from residua.operators.curves import ranking_metrics
from residua.operators.encode import FeatureEncoder
from residua.operators.forest import IsolationForest, average_path
from residua.operators.labels import benign_rows
from residua.operators.reconstruct import MeanReconstructor, densify
from residua.plans.detection import AnomalyDetector, evaluate_holdout
from residua.roles import Roles
from residua.sources.model_store import load_detector, save_detector
from residua.streaming import alerts as streaming

ROLES = Roles(ids=(), numeric=("a", "b", "c"), categorical=("proto",))


@pytest.fixture(scope="module")
def trained(spark, planted):
    return AnomalyDetector(ROLES, Autoencoder(max_epochs=30)).fit(planted)


def loss_of(trained, running, z, cat):
    out, _ = net.forward(trained, {k: v.copy() for k, v in running.items()}, z, cat, np.random.default_rng(0))
    return np.mean(np.square(net.residual(out, z, cat)))


def test_training_gradient_matches_finite_differences():
    rng = np.random.default_rng(1)
    z, cat = rng.normal(size=(40, 3)), rng.integers(-1, 4, size=(40, 1)) + 3
    cat[cat == 2] = -1
    trained, running = net.initial(7, 3)
    for name in trained:
        trained[name] = trained[name] + 0.05 * rng.normal(size=trained[name].shape)
    loss, grads = net.gradients(trained, {k: v.copy() for k, v in running.items()}, z, cat, np.random.default_rng(0))
    assert loss == pytest.approx(loss_of(trained, running, z, cat))
    assert grads.keys() == trained.keys()
    for name, g in grads.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        kept, h = trained[name][at], 1e-6
        trained[name][at] = kept + h
        up = loss_of(trained, running, z, cat)
        trained[name][at] = kept - h
        down = loss_of(trained, running, z, cat)
        trained[name][at] = kept
        assert g[at] == pytest.approx((up - down) / (2 * h), rel=2e-3, abs=1e-7), name


def test_wide_output_gives_the_same_gradients():
    """The output layer's one-hot part through W W' against writing it out."""
    rng = np.random.default_rng(8)
    z, cat = rng.normal(size=(50, 2)), np.stack([rng.integers(-1, 6, 50), rng.integers(-1, 4, 50)], axis=1)
    cat = np.where(cat < 0, -1, cat + [2, 8])
    trained, running = net.initial(12, 3)
    fresh = lambda: {k: v.copy() for k, v in running.items()}
    loss, grads = net.gradients(trained, fresh(), z, cat, np.random.default_rng(0))
    again, other = net.gradients(trained, fresh(), z, cat, np.random.default_rng(0), dense=0)
    assert loss == pytest.approx(again) and grads.keys() == other.keys()
    for name, g in grads.items():
        np.testing.assert_allclose(other[name], g, atol=1e-12)
    h = net.hidden(trained, running, z, cat)[0]
    direct = np.square(net.residual(net.forward(trained, running, z, cat)[0], z, cat)).sum(axis=1)
    np.testing.assert_allclose(net.block_errors(trained, net.output_squares(trained, 2), h, z, cat), direct, atol=1e-12)


def test_slot_sums():
    slots, values = np.array([4, -1, 2, 4, 2, 9, -1]), np.arange(14.0).reshape(7, 2)
    seen, sums = net.slot_sums(slots, values)
    assert seen.tolist() == [2, 4, 9] and sums.tolist() == [[12, 14], [6, 8], [10, 11]]
    assert len(net.slot_sums(np.array([-1]), np.ones((1, 2)))[0]) == 0


def test_weights_follow_from_the_rows_alone(spark, planted, monkeypatch):
    """Other partitions and other numbers of tasks: the same weights, bit by bit. Averaged on the executors: nearly the same."""
    from residua.operators import autoencoder

    encoder = FeatureEncoder(("a", "b", "c"), ("proto",)).fit(planted)
    monkeypatch.setattr(autoencoder, "MERGE_WAYS", 3)
    seen = []
    for parts, collected in ((1, 1 << 30), (13, 1 << 30), (5, 0)):
        monkeypatch.setattr(autoencoder, "COLLECTED_BYTES", collected)
        rows = planted.repartition(parts)
        maker = Autoencoder(max_epochs=2, round_batches=2, batch_size=64, shards=11)
        seen.append(maker.fit(rows, rows.filter("record_index < 900"), encoder))
    assert seen[0].losses == seen[1].losses
    for name, value in seen[0].trained.items():
        assert np.array_equal(value, seen[1].trained[name])
        np.testing.assert_allclose(value, seen[2].trained[name], atol=1e-5)


def test_blocks_are_bounded_and_whole(spark, planted):
    """Every row is in one block of one shard and segment, and equal rows do not make a block grow."""
    from residua.operators.reconstruct import complete_rows

    encoder = FeatureEncoder(("a", "b", "c"), ("proto",)).fit(planted)
    same = planted.select(F.lit(1).alias("record_index"), *[F.lit(0.5).alias(c) for c in "abc"], F.lit("tcp").alias("proto"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    for rows in (planted, same):
        maker = Autoencoder(batch_size=32, round_batches=2)
        blocks = maker._stage(complete_rows(encoder.transform(rows)), rows.columns, 7, 5, encoder, "train").toPandas()
        assert blocks["rows"].sum() == 3000 and blocks["rows"].max() <= 2 * 64 + 50
        assert not blocks.duplicated(["segment", "shard", "part"]).any()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_segments_are_even(spark):
    """Whatever their number, so that every round trains its share of the rows."""
    rows = spark.range(8000).select("id", F.array(F.lit(0.5)).alias("enc_num"), F.array().cast("array<int>").alias("enc_cat"))
    encoder = FeatureEncoder(("a",), ()).fit(spark.createDataFrame([(1.0,), (2.0,)], "a double"))
    for shards, segments in ((17, 16), (5, 2), (3, 7)):
        blocks = Autoencoder()._stage(rows, ["id"], shards, segments, encoder, "train")
        seen = {r["segment"]: r["n"] for r in blocks.groupBy("segment").agg(F.sum("rows").alias("n")).collect()}
        assert len(seen) == segments and sum(seen.values()) == 8000
        assert max(seen.values()) < 1.3 * 8000 / segments


def test_a_larger_table_is_merged_more_often(spark, planted, monkeypatch):
    """Four times the blocks: twice the blocks side by side and twice the rounds of an epoch; a task a block."""
    encoder = FeatureEncoder(("a", "b", "c"), ("proto",)).fit(planted)
    seen, real = [], Autoencoder._round
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    monkeypatch.setattr(Autoencoder, "_round", lambda self, tasks, *a: seen.append((tasks[0].count(), a[-1])) or real(self, tasks, *a))
    for batches, shards in ((12, 3), (3, 6)):
        seen.clear()
        Autoencoder(max_epochs=1, batch_size=32, round_batches=batches).fit(planted, planted, encoder)
        rounds = [x for x in seen[:-1]]
        assert {n for _, n in rounds} == {shards} and abs(len(rounds) - 3000 / (32 * batches * shards)) < 1 + 1e-9
        assert all(blocks <= shards for blocks, _ in rounds)
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before


def test_input_gradient_matches_finite_differences():
    rng = np.random.default_rng(2)
    trained, running = net.initial(6, 5)
    x = rng.normal(size=(3, 6))
    score, grad = net.mse_input_gradient(trained, running, x)
    for j in range(6):
        step = np.zeros(6)
        step[j] = 1e-6
        up, down = (net.mse_input_gradient(trained, running, x + d)[0] for d in (step, -step))
        np.testing.assert_allclose(grad[:, j], (up - down) / 2e-6, atol=1e-5)
    dense = net.forward(trained, running, densify(x[:, :4], np.array([[5], [-1], [4]]), 6), None)[0]
    gathered = net.forward(trained, running, x[:, :4], np.array([[5], [-1], [4]]))[0]
    np.testing.assert_allclose(dense, gathered, atol=1e-12)


def test_packing_keeps_every_parameter():
    trained, running = net.initial(9, 1)
    back = net.unpack(net.pack([trained, running]), list(net.shapes(9)))
    for before, after in zip((trained, running), back):
        assert all(np.array_equal(before[k], after[k]) for k in before)


def test_autoencoder_learns_and_beats_the_mean(spark, planted, trained):
    losses = trained.model.losses
    assert min(losses) < 0.5 * losses[0]
    mean = AnomalyDetector(ROLES, MeanReconstructor()).fit(planted)
    auc = {
        name: ranking_metrics(d.holdout(planted)).first()["roc_auc"] for name, d in (("net", trained), ("mean", mean))
    }
    assert auc["net"] > auc["mean"] and auc["net"] > 0.9


def test_training_stops_early(spark, planted):
    encoder = FeatureEncoder(("a",), ()).fit(planted)
    with pytest.raises(ValueError, match="training rows"):
        Autoencoder(max_epochs=1).fit(planted.limit(0), planted, encoder)
    model = Autoencoder(max_epochs=50, patience=1).fit(planted, planted.filter("a > 100 or label = 'Malicious'"), encoder)
    assert len(model.losses) < 50


def test_saved_autoencoder_scores_the_same(spark, planted, trained, tmp_path):
    save_detector(spark, trained, str(tmp_path / "net"))
    loaded = load_detector(spark, str(tmp_path / "net"))
    pairs = trained.transform(planted).select("record_index", F.col("mse_score").alias("s")).join(
        loaded.transform(planted), "record_index"
    )
    assert pairs.filter(F.abs(F.col("s") - F.col("mse_score")) > 1e-9).count() == 0


@pytest.mark.parametrize("parts", [1, 9])
def test_forest_isolates_planted_rows(spark, planted, parts):
    table = planted.repartition(parts)
    encoder = FeatureEncoder(("a", "b", "c"), ("proto",)).fit(benign_rows(table, ROLES))
    forest = IsolationForest(n_trees=40, max_samples=128).fit(benign_rows(table, ROLES), encoder, "record_index")
    assert forest.nodes["tree"].nunique() == 40 and forest.depth == 7
    scored = forest.transform(table).withColumn("is_malicious", F.col("label") == "Malicious")
    assert ranking_metrics(scored).first()["roc_auc"] > 0.8
    assert scored.filter("flagged").count() == scored.filter("mse_score > 0").count()
    row = scored.orderBy("record_index").first()
    test_forest_isolates_planted_rows.seen = getattr(test_forest_isolates_planted_rows, "seen", row["mse_score"])
    assert row["mse_score"] == pytest.approx(test_forest_isolates_planted_rows.seen)


def test_forest_draws_the_wanted_rows_per_tree(spark, planted):
    encoder = FeatureEncoder(("a",), ()).fit(planted)
    for trees, rows in ((4, 16), (50, 64), (20, 3000)):
        samples = IsolationForest(n_trees=trees, max_samples=rows)._samples(encoder.transform(planted), "record_index", 3000, rows)
        sizes = [r["count"] for r in samples.groupBy("tree").count().collect()]
        assert len(sizes) == trees and min(sizes) > 0.9 * rows and max(sizes) <= rows


def test_average_path_lengths():
    assert average_path(1) == 0 and average_path(2) == 1
    assert average_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_expected_gradients_are_complete(spark, planted, trained):
    scored = trained.transform(planted)
    background = explain.background_sample(benign_rows(planted, ROLES), 30, "record_index")
    assert background.count() == 30
    phi = explain.expected_gradients(trained.model, scored, background, n_explain=5, steps=64)
    base = explain.base_value(trained.model, background).first()[0]
    rows = phi.collect()
    assert len(rows) == 5
    for r in rows:
        assert sum(r["phi"]) == pytest.approx(r["mse_score"] - base, rel=0.05)
    grouped = explain.aggregate_attributions(phi, trained.encoder)
    totals = {r["record_index"]: r["t"] for r in grouped.groupBy("record_index").agg(F.sum("phi").alias("t")).collect()}
    assert all(totals[r["record_index"]] == pytest.approx(sum(r["phi"])) for r in rows)
    assert explain.global_importance(grouped).count() == 4
    table = explain.attribution_table(grouped, scored, trained.encoder.features)
    assert table.count() == 5 and table.columns == ["label", "mse_score", "record_index", "a", "b", "c", "proto"]


def test_attributions_do_not_depend_on_dealing(spark, planted, trained, monkeypatch):
    """Blocks of other sizes, pieces of other lengths, another number of partitions: the same sums."""
    scored = trained.transform(planted)
    background = explain.background_sample(benign_rows(planted, ROLES), 20, "record_index")
    seen = []
    for block, piece, parts in ((16, 65_536, 1), (3, 2, 5), (100, 1, 2)):
        monkeypatch.setattr(explain, "BLOCK", block)
        monkeypatch.setattr(explain, "PIECE", piece)
        phi = explain.expected_gradients(trained.model, scored, background.repartition(parts), n_explain=4)
        seen.append({r["record_index"]: r["phi"] for r in phi.collect()})
    for other in seen[1:]:
        assert other.keys() == seen[0].keys() and len(other) == 4
        for k, v in other.items():
            np.testing.assert_allclose(v, seen[0][k], rtol=1e-10, atol=1e-14)


def test_background_draw_has_the_law_of_row_numbers(spark):
    df = spark.range(8).select(F.col("id").alias("record_index"))
    counts = np.zeros(8)
    for seed in range(30):
        for r in explain.background_sample(df, 8, "record_index", seed).collect():
            counts[r["record_index"]] += 1
    assert counts.sum() == 240 and counts.min() > 10 and counts.max() < 55


def test_separable_attributions_sum_to_the_score(spark, planted):
    detector = AnomalyDetector(ROLES).fit(planted)
    scored = detector.transform(planted)
    background = benign_rows(planted, ROLES)
    phi = explain.separable_attributions(detector.model, scored.filter("flagged"), background)
    base = explain.base_value(detector.model, background).first()[0]
    sums = phi.groupBy("record_index").agg(F.sum("phi").alias("t")).join(scored, "record_index")
    assert sums.filter(F.abs(F.col("t") - (F.col("mse_score") - base)) > 1e-9).count() == 0
    fall = explain.row_waterfall(phi, phi.first()["record_index"], 3).collect()
    assert len(fall) == 3 and abs(fall[0]["phi"]) >= abs(fall[2]["phi"])
    assert all((r["phi"] > 0) == r["text"].startswith("+") for r in fall)


def test_feature_errors_rank_within_the_row(spark, planted):
    detector = AnomalyDetector(ROLES).fit(planted)
    flagged = detector.transform(planted).filter("flagged")
    errors = explain.feature_errors(detector.model, flagged, detector.encoder.dimension_names(), 2)
    assert errors.count() == 2 * flagged.count()
    wide = errors.groupBy("record_index").pivot("rank", [1, 2]).agg(F.first("error"))
    assert wide.filter(F.col("1") < F.col("2")).count() == 0


def test_evaluation_with_forest(spark, planted):
    detector = AnomalyDetector(ROLES).fit(planted)
    evaluation = evaluate_holdout(planted, detector, IsolationForest(n_trees=20))
    assert evaluation.comparison.count() == 5 and evaluation.sweep.count() == 7
    assert evaluation.forest_report.first()["split"] == "test_isolation_forest"
    assert evaluation.scored.count() == 450


def test_published_totals_survive_replays_and_readers(spark, planted, tmp_path):
    """A batch that runs again adds its row again; the newest version is read whole at any time, and an empty folder gives no row."""
    path = str(tmp_path / "totals")
    rows = spark.createDataFrame([(0, 10, 1), (1, 20, 2), (1, 20, 2), (0, 10, 1)], "_version long, processed long, alerts long")
    assert streaming.latest(rows.filter("false")).count() == 0
    seen = []
    for n in range(4):
        rows.filter(F.col("_version") <= n // 2).limit(n + 1).coalesce(1).write.mode("append").parquet(path)
        seen.append(streaming.latest(spark.read.parquet(path)).first()["processed"])
    assert seen == sorted(seen) and seen[-1] == 20


def test_sketched_threshold_is_within_its_bound(spark, planted, tmp_path):
    source = str(tmp_path / "in")
    scores = planted.withColumn("mse_score", F.when(F.col("record_index") % 50 != 0, F.pow("a", F.lit(2))))
    scores.repartition(4).write.parquet(source)
    stream = streaming.parquet_stream(spark, source, scores.schema, files_per_trigger=1)
    sketch = streaming.score_sketch(stream, k=256)
    streaming.publish_kpis(sketch, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    published = streaming.latest(spark.read.parquet(str(tmp_path / "out")))
    values = np.array([r[0] for r in scores.select("mse_score").collect() if r[0] is not None])
    for percentile in (50.0, 99.0):
        row = streaming.sketched_threshold(published, percentile).first()
        assert row["scores"] == len(values) == 2940
        assert abs((values <= row["threshold"]).mean() - percentile / 100) <= streaming.rank_error(256) + 1 / 2940


def test_detector_is_a_pipeline_stage(spark, planted, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import SQLTransformer

    renamed = SQLTransformer(statement="SELECT *, a AS a_again FROM __THIS__")
    fitted = Pipeline(stages=[renamed, AnomalyDetector(ROLES)]).fit(planted)
    path = str(tmp_path / "pipeline")
    fitted.save(path)
    fitted.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert loaded.stages[1].uid == fitted.stages[1].uid and loaded.stages[1].threshold == fitted.stages[1].threshold
    assert loaded.transform(planted).orderBy("record_index").collect() == fitted.transform(planted).orderBy("record_index").collect()


def test_stream_equals_batch(spark, planted, tmp_path):
    source = str(tmp_path / "in")
    planted.repartition(5).write.parquet(source)
    detector = AnomalyDetector(ROLES).fit(planted)
    stream = streaming.score_stream(streaming.parquet_stream(spark, source, planted.schema, files_per_trigger=2), detector)
    assert stream.isStreaming
    alerts = streaming.alert_stream(stream, "record_index")
    streaming.write_alerts(alerts, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    streaming.publish_kpis(streaming.running_kpis(stream), str(tmp_path / "kpi"), str(tmp_path / "c2")).awaitTermination()
    batch = detector.transform(planted)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == ["idx", "mse_score", "label", "proto", "detailed_label"]
    assert sorted(r["idx"] for r in got.collect()) == sorted(r["record_index"] for r in batch.filter("flagged").collect())
    versions = spark.read.parquet(str(tmp_path / "kpi"))
    assert versions.count() == 3 and streaming.latest(versions).first() == streaming.running_kpis(batch).first()
    # a second run has nothing new to read and appends nothing
    again = streaming.alert_stream(streaming.score_stream(streaming.parquet_stream(spark, source, planted.schema), detector), "record_index")
    streaming.write_alerts(again, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == batch.filter("flagged").count()
