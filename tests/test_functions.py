import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from residua.functions.columns import exceeds, half_even, is_benign
from residua.functions.lookup import lookup_join
from residua.functions.materialize import materialize
from residua.functions.quantiles import exact_quantiles
from residua.functions.running import running_totals, sketch_order
from residua.sources.record_index import index_by_number, with_record_index

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_benign_is_trimmed_and_case_free(spark):
    df = spark.createDataFrame([("Benign",), ("\t BENIGN \n",), ("Malicious",), (None,), ("nan",)], "l string")
    assert [r[0] for r in df.select(is_benign("l")).collect()] == [True, True, False, False, False]


def test_rounding_is_half_even_like_numpy(spark):
    values = [0.125, 0.375, 2.5, 3.5, -0.125, 1.005, 12.345, 99.995]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(half_even(F.col("v"), 2)).collect()] == np.round(values, 2).tolist()


def test_nan_and_ties_are_not_above_the_threshold(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (float("nan"),), (None,), (float("inf"),)], "s double")
    assert [r[0] for r in df.select(exceeds(F.col("s"), F.lit(1.0))).collect()] == [False, True, False, False, True]


@few
@given(st.lists(st.sampled_from([0.0, 0.1, 0.5, 0.5000001, 3.0, 7.25, float("nan")]) | st.floats(-1e6, 1e6), min_size=1, max_size=300))
def test_quantiles_match_numpy_through_every_path(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    probabilities = [0.0, 0.01, 0.5, 0.9, 0.99, 1.0]
    kept = [v for v in values if v == v]
    expected = np.percentile(kept, [100 * p for p in probabilities]) if kept else [None] * 6
    for bins, pick_rows in ((1_024, 1_000), (8, 3), (2, 1)):
        found = exact_quantiles(df, {"v": F.col("v")}, probabilities, bins, pick_rows)["v"]
        if kept:
            np.testing.assert_allclose(found, expected, rtol=1e-9, atol=1e-9)
        else:
            assert found == [None] * 6


def test_quantiles_narrow_brackets_repeatedly(spark):
    values = np.concatenate([np.linspace(0, 1, 20_000), np.full(10_000, 0.5), [np.nan]])
    df = spark.createDataFrame([(float(v), float(v) ** 3) for v in values], "a double, b double").repartition(5)
    found = exact_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, [0.3, 0.5, 0.995], bins=50, pick_rows=50)
    for name, power in (("a", 1), ("b", 3)):
        np.testing.assert_allclose(found[name], np.nanpercentile(values**power, [30, 50, 99.5]), rtol=1e-9)


def test_quantiles_of_extreme_values(spark):
    values = [float("-inf"), -1e308, -3.0, -5e-324, 0.0, 0.0, 1e-300, 2.0, 1e308, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    shares = [i / 9 for i in range(10)]
    assert exact_quantiles(df, {"v": F.col("v")}, shares, bins=3, pick_rows=1)["v"] == pytest.approx(values)


def test_quantiles_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select(F.xxhash64("id").cast("double").alias("v"))
    found = {tuple(exact_quantiles(df.repartition(n), {"v": F.col("v")}, [0.3, 0.99], bins=7, pick_rows=5)["v"]) for n in (1, 17)}
    assert len(found) == 1


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, {"v": F.col("v")}, [0.5])["v"] == [None]


@pytest.mark.parametrize("per_bucket", [1_000_000, 40, 7])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_agree_for_any_bucket_size(spark, per_bucket, descending):
    rng = np.random.default_rng(1)
    values = rng.permutation(500).astype(float)
    weights = rng.integers(0, 5, 500)
    df = spark.createDataFrame([(float(v), int(w)) for v, w in zip(values, weights)], "v double, w long").repartition(4)
    sketch, extra = sketch_order(df, F.col("v"), per_bucket, {"w": F.sum("w")})
    assert extra["w"] == weights.sum()
    assert (sketch.buckets > 1) == (per_bucket < 500)
    rows = running_totals(df, "v", {"t": F.col("w")}, sketch, descending=descending).collect()
    order = np.argsort(-values if descending else values)
    expected = dict(zip(values[order], np.cumsum(weights[order])))
    assert {r["v"]: r["t"] for r in rows} == expected


def test_running_totals_per_group(spark):
    df = spark.range(300).select(F.col("id").cast("double").alias("v"), (F.col("id") % 3).alias("g"))
    sketch, _ = sketch_order(df, F.col("v"), 20)
    rows = running_totals(df, "v", {"t": F.lit(1)}, sketch, by=("g",)).collect()
    assert all(r["t"] == r["v"] // 3 + 1 for r in rows)


def test_running_totals_keep_a_missing_group(spark):
    df = spark.range(90).select(F.col("id").cast("double").alias("v"), F.when(F.col("id") % 3 != 0, F.col("id") % 3).alias("g"))
    for per_bucket in (1_000, 8):
        sketch, _ = sketch_order(df, F.col("v"), per_bucket)
        rows = running_totals(df, "v", {"t": F.lit(1)}, sketch, by=("g",)).collect()
        assert len(rows) == 90 and all(r["t"] == r["v"] // 3 + 1 for r in rows)


def test_salted_lookup_keeps_every_row_of_a_hot_key(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    table = rows.select("k").distinct().filter("k <> '5'").withColumn("x", F.length("k"))
    small = lookup_join(rows, table, ["k"], 10)
    salted = lookup_join(rows, table, ["k"], 10, salts=4, limit=1)
    assert sorted(map(tuple, small.select("id", "k", "x").collect())) == sorted(
        map(tuple, salted.select("id", "k", "x").collect())
    )
    assert salted.filter("x is null").count() == 1


def test_index_by_number_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, 7).repartition(6)
    for per_bucket in (1_000_000, 50):
        rows = index_by_number(df, "id", rows_per_bucket=per_bucket).collect()
        assert all(r["record_index"] * 7 == r["id"] for r in rows)


def test_index_follows_file_order_and_text_order(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select("id", F.concat(F.lit("k"), F.col("id").cast("string")).alias("k")).repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(path)
    by_file = with_record_index(spark.read.parquet(path)).collect()
    assert all(r["record_index"] == r["id"] for r in by_file)
    by_text = with_record_index(spark.read.parquet(path), ["k"]).collect()
    order = {k: i for i, k in enumerate(sorted(f"k{i}" for i in range(1000)))}
    assert all(order[r["k"]] == r["record_index"] for r in by_text)


def test_index_of_csv_and_text_files(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.range(1000).repartitionByRange(4, "id").sortWithinPartitions("id").write.option("header", True).csv(path)
    numbered = with_record_index(spark.read.option("header", True).schema("id long").csv(path)).collect()
    assert len(numbered) == 1000 and all(r["record_index"] == r["id"] for r in numbered)
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        text = with_record_index(spark.read.text(str(tmp_path / "c"))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)
    assert sorted(r["record_index"] for r in text) == list(range(1004))
    numbers = [int(r["value"]) for r in sorted(text, key=lambda r: r["record_index"]) if r["value"] != "id"]
    assert numbers == sorted(numbers)


def test_materialized_table_is_read_from_files(spark):
    table = materialize(spark.range(10))
    assert table.count() == 10 and table.inputFiles()


def test_salted_lookup_is_never_broadcast(spark, tmp_path):
    """A table whose files are small is repeated once per salt: the estimate from the files must not send all copies to the driver."""
    spark.range(5000).select("id", F.lit(True).alias("seen")).write.parquet(str(tmp_path / "names"))
    names = spark.read.parquet(str(tmp_path / "names"))
    met = lookup_join(spark.range(20_000), names, ["id"], 5000, limit=100)
    assert met.where("seen").count() == 5000 and met.count() == 20_000
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()
