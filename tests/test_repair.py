import numpy as np
import pytest
from pyspark.sql import functions as F

from residua.operators import repair
from residua.operators.repair import RepairSpec
from residua.roles import Roles

ROLES = Roles(key="record_index", detail_label="detailed_label")
INF, NAN = float("inf"), float("nan")


def run(df, **spec):
    out, log = repair.repair(df, RepairSpec(**spec), ROLES)
    return out, log.first().asDict()


def test_protected_columns_stay(spark):
    df = spark.createDataFrame([(1, 2, "Benign")], "f1 int, f2 int, label string")
    assert repair.optional_columns(df, ROLES, ("f1",)) == ["f2"]
    out, log = run(df, required=("f1",), extra_columns=("f1", "f2", "label"))
    assert out.columns == ["f1", "label"] and log["cols_dropped"] == ["f2"]


def test_median_fill(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "feat double")
    out, log = run(df, required=("feat",), missing_numeric="median")
    assert sorted(r[0] for r in out.collect()) == [1.0, 2.0, 3.0]
    assert log["numeric_missing_filled"] == 1 and log["missing_cells_after"] == 0


@pytest.mark.parametrize("how,value", [("mean", 2.5), ("zero", 0.0)])
def test_other_fills(spark, how, value):
    df = spark.createDataFrame([(1.0,), (NAN,), (4.0,), (INF,)], "x double")
    out, log = run(df, missing_numeric=how)
    assert sorted(r[0] for r in out.collect()) == sorted([1.0, 4.0, value, value])
    assert log["inf_replaced"] == 1 and log["numeric_missing_filled"] == 2


def test_a_column_without_values_is_not_counted_as_filled(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    out, log = run(df, missing_numeric="median")
    assert log["numeric_missing_filled"] == 0 and log["missing_cells_after"] == 2


def test_drop_rows_skips_imputation(spark):
    df = spark.createDataFrame([(1.0, None), (None, "a"), (2.0, "b")], "x double, s string")
    out, log = run(df, required=("x",), missing_numeric="drop_rows", missing_categorical="placeholder")
    assert log["rows_dropped_missing"] == 1 and log["categorical_missing_filled"] == 0
    assert out.filter("s is null").count() == 1


def test_placeholder_leaves_labels_alone(spark):
    df = spark.createDataFrame([(None, None), ("a", "Benign")], "s string, label string")
    out, log = run(df, missing_categorical="placeholder")
    assert log["categorical_missing_filled"] == 1
    assert sorted(map(tuple, out.fillna("none").collect())) == [("(missing)", "none"), ("a", "Benign")]


def test_duplicates_after_infinities_keep_the_first_record(spark):
    rows = [(5, INF, "a"), (2, NAN, "a"), (9, 1.0, "b"), (1, None, "a")]
    df = spark.createDataFrame(rows, "record_index long, x double, s string")
    out, log = run(df, required=("x", "s"), drop_duplicates=True)
    assert log["dupes_removed"] == 2 and log["inf_replaced"] == 1
    assert sorted(r["record_index"] for r in out.collect()) == [1, 9]


def test_invalid_rows_are_flagged_and_removed(spark):
    df = spark.createDataFrame([(1.0, True), (None, True), (2.0, False)], "x double, _invalid_row boolean")
    out, log = run(df)
    assert repair.FLAG not in out.columns
    out, log = run(df.drop(repair.FLAG), required=("x",), flag_invalid=True)
    assert log["invalid_flagged"] == 1 and out.filter(repair.FLAG).count() == 1
    out, log = run(df.drop(repair.FLAG), required=("x",), flag_invalid=True, remove_invalid=True)
    assert log["invalid_rows_removed"] == 1 and log["rows_after"] == 2 and repair.FLAG not in out.columns
    out, log = run(df.drop(repair.FLAG), required=("x",), remove_invalid=True)
    assert log["invalid_rows_removed"] == 0 and log["rows_after"] == 3


def test_winsorizing_matches_numpy_and_skips_flat_columns(spark):
    values = [float(v) for v in range(200)] + [1e6]
    df = spark.createDataFrame([(v, 1.0, None if i == 3 else v) for i, v in enumerate(values)], "x double, flat double, gap double")
    out, log = run(df, winsorize=True)
    lo, hi = np.percentile(values, [1, 99])
    assert np.allclose(sorted(r["x"] for r in out.collect()), sorted(np.clip(values, lo, hi)))
    gaps = [v for i, v in enumerate(values) if i != 3]
    glo, ghi = np.percentile(gaps, [1, 99])
    changed = sum(v < lo or v > hi for v in values) + sum(v < glo or v > ghi for v in gaps)
    assert log["clip_updates"] == changed and out.filter("gap is null").count() == 1
    _, parity = run(df, winsorize=True, parity_clip_count=True)
    assert parity["clip_updates"] == changed + 1


def test_summary_lists_nonzero_counters(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (3.0,)], "x double")
    _, log = repair.repair(df, RepairSpec(missing_numeric="zero", drop_duplicates=True), ROLES)
    assert [tuple(r) for r in repair.repair_summary(log).collect()] == [
        ("missing_cells_before", 1), ("missing_cells_after", 0), ("rows_before", 4), ("rows_after", 3),
        ("dupes_removed", 1), ("numeric_missing_filled", 1),
    ]


def test_placeholder_fills_and_counts_text_only(spark):
    df = spark.createDataFrame([("a", True, 1.0), (None, None, None)], "t string, f boolean, x double")
    out, log = run(df, missing_categorical="placeholder")
    assert log["categorical_missing_filled"] == 1 and out.filter("f is null").count() == 1


def test_unknown_fill_is_refused():
    with pytest.raises(ValueError):
        RepairSpec(missing_numeric="mode")


def test_statistics_are_independent_of_partitioning(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 7 != 0, F.col("id") * 1.5).alias("x"))
    medians = {
        repair.impute_numeric(df.repartition(n), ["x"], "median").agg(F.sum("x")).first()[0] for n in (1, 17)
    }
    assert len(medians) == 1
