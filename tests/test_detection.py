import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from residua.operators import split
from residua.operators.encode import MISSING_CATEGORY, FeatureEncoder
from residua.operators import reconstruct
from residua.operators.reconstruct import MeanModel, PCAReconstructor, reconstruction_mse
from residua.operators.results import top_anomalies
from residua.plans.detection import AnomalyDetector, active_threshold, evaluate_holdout, validate_for_scoring
from residua.roles import Roles
from residua.sources.model_store import load_detector, save_detector

ROLES = Roles(ids=())


def brute_force_split(rows, seed=42):
    """Rank every row by hash within its class and cut by the quotas."""

    def share(total, sizes, size):
        draws = math.ceil(total * size)
        exact = {c: draws * n / total for c, n in sizes.items()}
        got = {c: math.floor(x) for c, x in exact.items()}
        spare = draws - sum(got.values())
        for c in sorted(exact, key=lambda c: (-(exact[c] - got[c]), c))[:spare]:
            got[c] += 1
        return got

    sizes = {}
    for _, c in rows:
        sizes[c] = sizes.get(c, 0) + 1
    test = share(len(rows), sizes, 0.15)
    left = {c: n - test[c] for c, n in sizes.items()}
    val = share(sum(left.values()), left, 0.15 / (1 - 0.15))
    out = {}
    for c in sizes:
        keys = sorted((k for k, cc in rows if cc == c), key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())
        for i, k in enumerate(keys):
            out[k] = "test" if i < test[c] else "val" if i < test[c] + val[c] else "train"
    return out


@pytest.mark.parametrize("literal", [64, 1])
@pytest.mark.parametrize("sigmas", [6.0, 0.001])
@pytest.mark.parametrize("parts", [1, 17])
def test_split_equals_ranking_everything(spark, literal, sigmas, parts):
    rows = [(i, "abcd"[(i * i) % 7 % 4]) for i in range(1300)]
    df = spark.createDataFrame(rows, "record_index long, label string").repartition(parts)
    model = split.StratifiedSplit(literal_classes=literal, sigmas=sigmas).fit(df)
    assert (model.cuts is None) == (literal == 1)
    got = {r["record_index"]: r["split"] for r in model.transform(df).collect()}
    assert got == brute_force_split(rows)


def test_split_of_a_small_table_is_exact(spark):
    rows = [(i, "x" if i < 20 else "y") for i in range(27)]
    df = spark.createDataFrame(rows, "record_index long, label string")
    got = {r["record_index"]: r["split"] for r in split.StratifiedSplit().fit(df).transform(df).collect()}
    assert got == brute_force_split(rows)


def test_split_refuses_small_classes_and_empty_tables(spark):
    schema = "record_index long, label string"
    with pytest.raises(ValueError, match="at least 2"):
        split.StratifiedSplit().fit(spark.createDataFrame([(i, "x" if i else "y") for i in range(50)], schema))
    with pytest.raises(ValueError, match="too few"):
        split.StratifiedSplit().fit(spark.createDataFrame([(i, "xyz"[i % 3]) for i in range(6)], schema))
    with pytest.raises(ValueError, match="empty"):
        split.StratifiedSplit().fit(spark.createDataFrame([], schema))


def test_splits_are_disjoint_and_complete(spark, planted):
    assigned = split.StratifiedSplit().fit(planted).transform(planted)
    parts = [assigned.filter(F.col("split") == s).select("record_index") for s in ("train", "val", "test")]
    union = parts[0].unionAll(parts[1]).unionAll(parts[2])
    assert union.exceptAll(planted.select("record_index")).isEmpty()
    assert planted.select("record_index").exceptAll(union).isEmpty()
    assert all(a.intersect(b).isEmpty() for i, a in enumerate(parts) for b in parts[i + 1 :])
    counts = {r["split"]: r["rows"] for r in split.split_counts(assigned).collect()}
    # 2550 * (0.15 / 0.85) is a hair above 450 in floating point and rounds up
    assert counts == {"train": 2099, "val": 451, "test": 450, "total": 3000}
    assert tuple(split.split_invariants(assigned, "record_index").first()) == (0, 0, 0, 3000)


def encoder_table(spark):
    rows = [(1.0, 5.0, "b"), (3.0, 5.0, "a"), (None, 5.0, None), (float("nan"), 5.0, "a")]
    return spark.createDataFrame(rows, "x double, flat double, s string")


def test_encoder_uses_population_moments_and_sorted_categories(spark):
    model = FeatureEncoder(("x", "flat"), ("s",)).fit(encoder_table(spark))
    assert model.means == (2.0, 5.0) and model.scales == (1.0, 1.0)
    assert model.categories == (((MISSING_CATEGORY, 0.25), ("a", 0.5), ("b", 0.25)),)
    assert model.width == 5 and model.feature_groups() == {"x": [0], "flat": [1], "s": [2, 3, 4]}
    fresh = spark.createDataFrame([(4.0, 6.0, "zzz"), (2.0, 5.0, None)], "x double, flat double, s string")
    rows = model.transform(fresh).withColumn("dense", model.dense()).collect()
    assert rows[0]["enc_num"] == [2.0, 1.0] and rows[0]["enc_cat"] == [-1]
    assert rows[0]["dense"] == [2.0, 1.0, 0.0, 0.0, 0.0]  # unseen: all zero
    assert rows[1]["dense"] == [0.0, 0.0, 1.0, 0.0, 0.0]  # missing text is a category
    with pytest.raises(ValueError, match="flat"):
        model.transform(fresh.drop("flat"))


def test_large_vocabularies_give_the_same_scores(spark, monkeypatch):
    import residua.operators.encode as encode

    df = spark.range(600).select(
        "id", (F.col("id") % 11).cast("double").alias("x"), F.concat(F.lit("v"), F.col("id") % 37).alias("s"), F.concat(F.lit("w"), F.col("id") % 5).alias("t")
    )
    train = df.filter("id < 400 and s <> 'v3'")
    small = FeatureEncoder(("x",), ("s", "t")).fit(train)
    wide = FeatureEncoder(("x",), ("s", "t"), collected_categories=10).fit(train)
    assert wide.vocabulary is not None and wide.widths == small.widths
    monkeypatch.setattr(encode, "LITERAL_CATEGORIES", 3)
    joined = FeatureEncoder(("x",), ("s", "t")).fit(train)
    scores = [
        {r["id"]: (r["mse_score"], *r["enc_cat"]) for r in m.transform(MeanModel(m).with_score(df)).collect()}
        for m in (small, wide, joined)
    ]
    for other in scores[1:]:
        assert other.keys() == scores[0].keys()
        assert all(np.allclose(other[k], scores[0][k]) for k in other)
    reconstruct.require_weights(wide, "PCA", wide.width)
    with pytest.raises(ValueError, match="too wide"):
        reconstruct.require_weights(wide, "PCA", wide.width - 1)


def test_exact_category_count_decides(spark):
    """The number of different categories, not an estimate of it, says whether the vocabulary stays a table."""
    train = spark.range(3000).select(F.concat(F.lit("v"), F.col("id") % 1000).alias("s"))
    assert FeatureEncoder((), ("s",), collected_categories=1000).fit(train).vocabulary is None
    assert FeatureEncoder((), ("s",), collected_categories=999).fit(train).vocabulary is not None


def test_pca_equals_the_matrix_method(spark):
    """Against Spark ML's PCA, which squares the width; with wide scoring and a joined vocabulary the errors stay the same."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    df = spark.range(3000).select("id", (F.col("id") % 13).cast("double").alias("x"), ((F.col("id") * 7) % 29).cast("double").alias("y"), F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(40))).alias("s"))
    encoder = FeatureEncoder(("x", "y"), ("s",)).fit(df)
    wide = FeatureEncoder(("x", "y"), ("s",), collected_categories=10).fit(df)
    model, joined = PCAReconstructor(k=5).fit(df, df, encoder), PCAReconstructor(k=5).fit(df, df, wide)
    vectors = encoder.transform(df).select(array_to_vector(encoder.dense()).alias("v"))
    wanted = PCA(k=5, inputCol="v", outputCol="o").fit(vectors).pc.toArray()
    for found in (model, joined):
        # equal variances turn single directions, never the space they span
        np.testing.assert_allclose(np.linalg.svd(wanted.T @ found.components, compute_uv=False), 1.0, atol=1e-7)
    scores = [{r["id"]: r["mse_score"] for r in m.with_score(df, dense_width=w).collect()} for m, w in ((model, 10**6), (model, 0), (joined, 0))]
    for other in scores[1:]:
        assert other.keys() == scores[0].keys() and all(abs(other[k] - scores[0][k]) < 1e-9 for k in other)


def test_leading_directions():
    rng = np.random.default_rng(4)
    for width, values in ((60, 0.9 ** np.arange(60)), (200, np.concatenate([[5.0, 5, 5, 4], np.linspace(1, 0, 196)])), (7, np.zeros(7))):
        basis = np.linalg.qr(rng.normal(size=(width, width)))[0]
        matrix = (basis * values) @ basis.T
        got = reconstruct.leading_directions(lambda q: matrix @ q, width, 4, min(8, width), min(width, 30), 1e-10, 500, 1)
        np.testing.assert_allclose(got.T @ got, np.eye(4), atol=1e-10)
        np.testing.assert_allclose(np.diag(got.T @ matrix @ got), values[:4], atol=1e-9)


@pytest.mark.parametrize("width", [30_000])
def test_vocabulary_beyond_dense_rows(spark, width):
    """A vocabulary of tens of thousands: PCA, forest and network fit and score without a dense row."""
    from residua.operators.autoencoder import Autoencoder
    from residua.operators.forest import IsolationForest

    df = spark.range(width).select("id", (F.col("id") % 13).cast("double").alias("x"), F.concat(F.lit("v"), F.col("id")).alias("s"))
    encoder = FeatureEncoder(("x",), ("s",), collected_categories=10_000).fit(df)
    assert encoder.width == width + 1 and encoder.vocabulary is not None
    part = df.filter("id < 600")
    models = [PCAReconstructor(k=2).fit(df, df, encoder), Autoencoder(max_epochs=1).fit(part, part.limit(50), encoder), IsolationForest(n_trees=5).fit(df, encoder, "id")]
    for model in models:
        row = model.with_score(part).agg(F.count("mse_score").alias("n"), F.min("mse_score").alias("low")).first()
        assert row["n"] == 600 and row["low"] > -0.5


def test_reconstruction_mse_example(spark):
    df = spark.createDataFrame([([0.0, 1.0], [0.0, 0.5]), ([1.0, 0.0], [0.5, 0.0])], "x array<double>, y array<double>")
    assert [r[0] for r in df.select(reconstruction_mse(F.col("x"), F.col("y"))).collect()] == [0.125, 0.125]


def test_mean_score_equals_dense_arithmetic(spark, planted):
    train = planted.filter("label = 'Benign'")
    encoder = FeatureEncoder(("a", "b", "c"), ("proto",)).fit(train)
    model = MeanModel(encoder)
    center = np.array([0, 0, 0, *[p for _, p in encoder.categories[0]]])
    rows = encoder.transform(model.with_dimension_errors(model.with_score(planted))).withColumn("x", encoder.dense()).limit(200).collect()
    for r in rows:
        expected = np.square(np.array(r["x"]) - center)
        np.testing.assert_allclose(r["errors"], expected, atol=1e-9)
        assert r["mse_score"] == pytest.approx(expected.mean(), abs=1e-9)


def test_pca_reconstruction_ranks_planted_rows_first(spark, planted):
    roles = Roles(ids=(), numeric=("a", "b", "c"), categorical=())
    detector = AnomalyDetector(roles, PCAReconstructor(k=2)).fit(planted)
    scored = detector.transform(planted)
    top = top_anomalies(scored, 200)
    assert top.filter("is_malicious").count() > 180
    train = detector.assign_split(planted).filter("split = 'train' and label = 'Benign'")
    x = np.array([[r.a, r.b, r.c] for r in train.collect()])
    z = (x - x.mean(0)) / x.std(0)
    _, _, vt = np.linalg.svd(z - z.mean(0), full_matrices=False)
    rest = z - z @ vt[:2].T @ vt[:2]
    got = sorted(r["mse_score"] for r in scored.join(train.select("record_index"), "record_index").collect())
    np.testing.assert_allclose(got, np.sort(np.square(rest).mean(1)), atol=1e-6)


def test_scoring_checks_and_threshold_override(spark, planted):
    roles = Roles(ids=(), numeric=("a", "b", "c"), categorical=("proto",))
    detector = AnomalyDetector(roles).fit(planted)
    scored = detector.transform(planted)
    assert set(planted.columns) < set(scored.columns)
    with pytest.raises(ValueError, match="'c'"):
        detector.transform(planted.drop("c"))
    with pytest.raises(ValueError, match="duplicate"):
        validate_for_scoring(planted.select("a", "a"), ("a",))
    assert active_threshold(0.5, None) == active_threshold(0.5, float("nan")) == active_threshold(0.5, -1.0) == 0.5
    assert active_threshold(0.5, 0.7) == 0.7
    assert detector.score(planted, threshold=1e9).filter("flagged").count() == 0
    missing = spark.createDataFrame([(1, None, 0.0, 0.0, "tcp")], "record_index long, a double, b double, c double, proto string")
    row = detector.transform(missing).first()
    assert row["mse_score"] is None and row["flagged"] is False


def test_detection_does_not_depend_on_partitioning(spark, planted):
    roles = Roles(ids=(), numeric=("a", "b", "c"), categorical=("proto",))
    results = []
    for n in (1, 17):
        detector = AnomalyDetector(roles, score_places=6).fit(planted.repartition(n))
        evaluation = evaluate_holdout(planted.repartition(n), detector)
        results.append((round(detector.threshold, 9), evaluation.report.first(), evaluation.sweep.collect()))
    assert results[0][0] == results[1][0]
    for a, b in zip(results[0][1], results[1][1]):
        assert a == b or a == pytest.approx(b)
    assert [r["tp"] for r in results[0][2]] == [r["tp"] for r in results[1][2]]


@pytest.mark.parametrize("reconstructor", [None, PCAReconstructor(k=2)])
def test_saved_detector_scores_the_same(spark, planted, tmp_path, reconstructor):
    roles = Roles(ids=(), numeric=("a", "b", "c"), categorical=("proto",))
    detector = AnomalyDetector(roles, reconstructor).fit(planted)
    save_detector(spark, detector, str(tmp_path / "d"))
    loaded = load_detector(spark, str(tmp_path / "d"))
    assert loaded.threshold == detector.threshold and loaded.split_model == detector.split_model
    pairs = detector.transform(planted).select("record_index", F.col("mse_score").alias("s")).join(
        loaded.transform(planted).select("record_index", "mse_score"), "record_index"
    )
    assert pairs.filter(F.abs(F.col("s") - F.col("mse_score")) > 1e-12).count() == 0


def test_fitting_needs_benign_rows(spark):
    df = spark.range(100).select(F.col("id").alias("record_index"), F.lit("Malicious").alias("label"), F.lit("x").alias("detailed_label"), F.rand(1).alias("x"))
    with pytest.raises(ValueError, match="benign"):
        AnomalyDetector(Roles(ids=(), numeric=("x",), categorical=())).fit(df)
