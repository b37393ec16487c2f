"""One rule for missing numbers in every model: such rows are left out of fits, have no score and rank last."""

import math

import pytest
from pyspark.sql import functions as F

from residua import Roles
from residua.operators.autoencoder import Autoencoder
from residua.operators.forest import IsolationForest
from residua.operators.labels import benign_rows
from residua.operators.reconstruct import MeanReconstructor, PCAReconstructor
from residua.operators.results import lowest_error_rows, top_anomalies
from residua.operators.split import StratifiedSplit
from residua.plans.detection import AnomalyDetector

ROLES = Roles(key="record_index", ids=(), numeric=("a", "b", "c"), categorical=("proto",))


@pytest.fixture(scope="module")
def gaps(planted):
    """Null and NaN cells in every split."""
    a = F.when(F.col("record_index") % 50 == 7, None).when(F.col("record_index") % 50 == 13, float("nan")).otherwise(F.col("a"))
    return planted.withColumn("a", a)


def missing(row):
    return row["a"] is None or math.isnan(row["a"])


@pytest.mark.parametrize("model", [MeanReconstructor(), PCAReconstructor(k=2), Autoencoder(max_epochs=2)])
def test_models_leave_missing_numbers_out(gaps, model):
    detector = AnomalyDetector(ROLES, model).fit(gaps)
    assert math.isfinite(detector.threshold)
    rows = detector.transform(gaps).collect()
    assert all((r["mse_score"] is None) == missing(r) for r in rows)
    assert not any(r["flagged"] for r in rows if missing(r))
    scored = detector.transform(gaps)
    assert not any(missing(r) for r in top_anomalies(scored, 50).collect() + lowest_error_rows(scored, 50).collect())
    if isinstance(model, Autoencoder):
        assert detector.model.left_out > 0 and all(map(math.isfinite, detector.model.losses))


def test_forest_leaves_missing_numbers_out(gaps):
    detector = AnomalyDetector(ROLES, MeanReconstructor()).fit(gaps)
    train = detector.split_rows(benign_rows(gaps, ROLES), "train")
    forest = IsolationForest(n_trees=20).fit(train, detector.encoder, "record_index")
    rows = forest.transform(gaps).collect()
    assert all((r["mse_score"] is None) == missing(r) and r["flagged"] == bool(r["mse_score"] and r["mse_score"] > 0) for r in rows)


def test_models_without_a_complete_row(planted):
    empty = planted.withColumn("a", F.lit(None).cast("double"))
    encoder = AnomalyDetector(ROLES, MeanReconstructor()).fit(planted).encoder
    for model in (Autoencoder(max_epochs=1), PCAReconstructor()):
        with pytest.raises(ValueError):
            model.fit(empty, empty, encoder)
    with pytest.raises(ValueError):
        IsolationForest().fit(empty, encoder, "record_index")


def test_nan_scores_rank_last(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 0.5), (4, 2.0)], "record_index long, mse_score double").withColumn("flagged", F.lit(True))
    assert [r["record_index"] for r in top_anomalies(df, 4).collect()] == [4, 3, 1, 2]
    assert [r["record_index"] for r in lowest_error_rows(df, 2).collect()] == [3, 4]


def test_split_refuses_missing_and_repeated_keys(spark):
    rows = spark.range(200).select(F.lit("Benign").alias("label"), F.when(F.col("id") >= 180, F.col("id")).alias("record_index"))
    with pytest.raises(ValueError, match="180 rows have no"):
        StratifiedSplit().fit(rows)
    twice = spark.range(200).select(F.lit("Benign").alias("label"), (F.col("id") % 150).alias("record_index"))
    with pytest.raises(ValueError, match="stands in 2 rows"):
        StratifiedSplit().fit(twice)
