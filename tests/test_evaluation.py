import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from residua.operators import bootstrap, compare, confusion, curves, distribution, results, thresholds
from residua.sources import sinks

few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
pairs = st.lists(
    st.tuples(st.booleans(), st.sampled_from([0.0, 0.1, 0.2, 0.5, 1.0]) | st.floats(0, 100)), min_size=1, max_size=120
)
SCHEMA = "record_index long, is_malicious boolean, mse_score double, flagged boolean"


def scored(spark, rows, threshold=0.4):
    data = [(i, bool(y), float(s), bool(s > threshold)) for i, (y, s) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def brute_curve(rows):
    """Counts at or above every distinct score, from the top."""
    out = []
    for t in sorted({s for _, s in rows}, reverse=True):
        out.append((t, sum(y for y, s in rows if s >= t), sum(not y for y, s in rows if s >= t)))
    return out


def brute_auc(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    if not pos or not neg:
        return None, None
    ap, before = 0.0, 0
    for _, tp, fp in brute_curve(rows):
        ap += (tp - before) / len(pos) * tp / (tp + fp)
        before = tp
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return ap, wins / len(pos) / len(neg)


@few
@given(pairs)
def test_ranking_metrics_match_brute_force(spark, rows):
    df = scored(spark, rows)
    expected = brute_auc(rows)
    for per_bucket in (1_000_000, 4):
        got = curves.ranking_metrics(df, rows_per_bucket=per_bucket).first()
        if expected[0] is None:
            assert tuple(got) == (None, None)
        else:
            np.testing.assert_allclose(tuple(got), expected, atol=1e-9)


@few
@given(pairs)
def test_curves_match_brute_force(spark, rows):
    df = scored(spark, rows)
    points = brute_curve(rows)
    pos, neg = max(points[-1][1], 1), max(points[-1][2], 1)
    for per_bucket in (1_000_000, 5):
        got = sorted(map(tuple, curves.pr_curve(df, rows_per_bucket=per_bucket).filter("threshold is not null").collect()))
        want = sorted((t, tp / (tp + fp), tp / pos) for t, tp, fp in points)
        np.testing.assert_allclose(got, want, atol=1e-12)
        corners = [(None, 0.0, 0.0)]
        for i, (t, tp, fp) in enumerate(points):
            ends = i in (0, len(points) - 1)
            if ends or (2 * tp, 2 * fp) != (points[i - 1][1] + points[i + 1][1], points[i - 1][2] + points[i + 1][2]):
                corners.append((t, fp / neg, tp / pos))
        kept = list(map(tuple, curves.roc_curve(df, rows_per_bucket=per_bucket).collect()))
        assert {k[0] for k in kept} == {c[0] for c in corners}
        whole = curves.roc_curve(df, drop_collinear=False, rows_per_bucket=per_bucket)
        assert whole.count() == len(points) + 1
    area = curves.pr_curve_area(df).first()
    curve = [(0.0, 1.0)] + [(tp / pos, tp / (tp + fp)) for _, tp, fp in points]
    assert area["pr_area"] == pytest.approx(sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:])), abs=1e-9)
    assert area["prevalence"] == pytest.approx(np.mean([y for y, _ in rows]))


def test_undefined_scores_give_no_ranking_metrics(spark):
    df = scored(spark, [(True, 1.0), (False, float("nan"))])
    assert tuple(curves.ranking_metrics(df).first()) == (None, None)


# Published confusion counts and the metrics they give.
GOLDEN = [
    (1017, 4, 284, 2167, 0.9960822722820764, 0.31940954773869346, 0.48370986920332937),
    (3180, 31, 257, 4, 0.990346, 0.998744, 0.994527),
    (3155, 17, 271, 29, 0.994641, 0.990892, 0.992763),
    (1015, 2, 286, 2169, 0.998033, 0.318781, 0.483218),
]


@pytest.mark.parametrize("tp,fp,tn,fn,p,r,f1", GOLDEN)
def test_metrics_from_published_counts(spark, tp, fp, tn, fn, p, r, f1):
    row = confusion.with_metrics(spark.createDataFrame([(tp, fp, tn, fn)], "tp long, fp long, tn long, fn long")).first()
    np.testing.assert_allclose([row["precision"], row["recall"], row["f1_score"]], [p, r, f1], atol=1e-6)


def test_perfect_and_undefined_metrics(spark):
    counts = spark.createDataFrame([(10, 0, 5, 0), (0, 0, 10, 2), (0, 3, 4, 2)], "tp long, fp long, tn long, fn long")
    null = [tuple(r)[4:] for r in confusion.with_metrics(counts).collect()]
    assert null == [(1.0, 1.0, 1.0), (None, 0.0, None), (0.0, 0.0, None)]
    zero = [tuple(r)[4:] for r in confusion.with_metrics(counts, "zero").collect()]
    assert zero == [(1.0, 1.0, 1.0), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0)]
    with pytest.raises(ValueError):
        confusion.with_metrics(counts, "nan")


def test_reports_and_unlabelled_tables(spark):
    rows = [(True, 1.0), (True, 0.1), (False, 0.9), (False, 0.2), (False, 0.3)]
    df = scored(spark, rows)
    report = confusion.metrics_report(df, 0.4, "src").first()
    assert [report[c] for c in ("rows_scored", "flagged_count", "true_malicious_label_count", "tp", "fp", "tn", "fn")] == [5, 2, 2, 1, 1, 2, 1]
    assert report["pr_auc"] == pytest.approx(brute_auc(rows)[0])
    blind = confusion.metrics_report(df.drop("is_malicious"), 0.4, "src", labelled=False)
    assert blind.columns == list(report.asDict()) and blind.first()["tp"] is None
    lines = [r[0] for r in sinks.report_markdown(blind).collect()]
    assert "| precision | - |" in lines and "| flagged_count | 2 |" in lines
    assert {r["cell"]: r["count"] for r in confusion.confusion_long(df).collect()} == {
        "Malicious | Flagged": 1, "Malicious | Not flagged": 1, "Benign | Flagged": 1, "Benign | Not flagged": 2,
    }
    assert [r["count"] for r in confusion.confusion_long(None, spark).collect()] == [None] * 4
    assert [r["malicious"] for r in confusion.contingency_matrix(None, spark).collect()] == [None, None]
    assert confusion.flag_rate_sentence(confusion.flag_rate(df)).first()[0] == "2 of 5 records flagged (40.0 %)"


def test_sweep_matches_numpy(spark):
    rng = np.random.default_rng(3)
    y = rng.random(500) < 0.3
    s = np.round(rng.gamma(2.0, size=500) + y, 2)
    df = scored(spark, list(zip(y, s)))
    for row in thresholds.threshold_sweep(df).collect():
        t = np.percentile(s[~y], row["percentile"])
        assert row["threshold"] == pytest.approx(t, rel=1e-12)
        hit = s > row["threshold"]
        assert (row["tp"], row["fp"], row["tn"], row["fn"]) == ((hit & y).sum(), (hit & ~y).sum(), (~hit & ~y).sum(), (~hit & y).sum())
    context = thresholds.threshold_context(df, 2.0).first()
    assert context["above"] == (s > 2).sum() and context["near_band"] == pytest.approx(((s >= 1.9) & (s <= 2.1)).mean())


@pytest.mark.parametrize("per_bucket", [1_000_000, 25])
def test_grouped_medians_with_a_hot_group_and_ties(spark, per_bucket):
    rng = np.random.default_rng(5)
    groups = np.where(rng.random(900) < 0.6, "hot", rng.choice(list("abc"), 900))
    values = np.where(rng.random(900) < 0.4, 0.25, rng.random(900))
    df = spark.createDataFrame([(str(g), float(v)) for g, v in zip(groups, values)], "g string, v double").repartition(4)
    got = {r["g"]: r["median"] for r in thresholds.grouped_median(df, "g", "v", rows_per_bucket=per_bucket).collect()}
    assert got.keys() == set(groups)
    for g, m in got.items():
        assert m == pytest.approx(np.median(values[groups == g]), abs=1e-12)


def test_per_class_parity_and_label_option(spark):
    rows = [("-", False, False, 0.1), ("-", False, True, 0.9), ("DDoS", True, True, 0.8), (" DDoS", True, False, 0.2), ("BENIGN", False, False, 0.1), (None, True, True, 0.7)]
    df = spark.createDataFrame(rows, "detailed_label string, is_malicious boolean, flagged boolean, mse_score double")
    parity = {r["attack_type"]: tuple(r)[1:] for r in thresholds.per_class_detection(df).collect()}
    assert parity == {"-": (2, 1, 0.5, 0.5, 0.5), "DDoS": (2, 1, 0.5, 0.5, 0.5), "nan": (1, 1, 1.0, 0.7, 0.7)}
    assert {r["attack_type"] for r in thresholds.per_class_detection(df, benign_from="label").collect()} == {"DDoS", "nan"}
    shown = thresholds.class_breakdown(thresholds.per_class_detection(df)).collect()
    assert [r["text"] for r in shown] == ["n=2  (50%)", "n=2  (50%)", "n=1  (100%)"]


@pytest.mark.parametrize("values", [[0.0, 1.0, 1.0, 2.0, 4.0], [3.0] * 5, list(np.random.default_rng(0).random(400)), [0.1 * i for i in range(41)]])
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in [*values, float("nan")]], "mse_score double")
    for bins in (1, 7, 40):
        rows = distribution.score_histogram(df, bins).orderBy("bin").collect()
        counts, edges = np.histogram(values, bins)
        assert [r["count"] for r in rows] == counts.tolist()
        np.testing.assert_allclose([r["bin_start"] for r in rows] + [rows[-1]["bin_end"]], edges)


def test_class_histogram_density_integrates_to_one(spark):
    df = scored(spark, [(i % 4 == 0, i / 7) for i in range(100)])
    rows = distribution.score_histogram_by_class(df, 10).collect()
    for name in ("Benign", "Malicious"):
        assert sum(r["density"] * (r["bin_end"] - r["bin_start"]) for r in rows if r["class"] == name) == pytest.approx(1)
    assert distribution.score_histogram_by_class(df, 10, labelled=False).count() == 10
    assert distribution.score_histogram(df.limit(0)).count() == 0
    sampled = distribution.score_histogram_sampled(df, rows=50).collect()
    assert len(sampled) == 8 and sum(r["count"] for r in sampled) == 50


def test_score_quantiles_and_summary(spark):
    values = np.random.default_rng(2).random(333)
    df = spark.createDataFrame([(float(v),) for v in values], "mse_score double")
    got = [r["score"] for r in distribution.score_quantiles(df).collect()]
    np.testing.assert_allclose(got, np.quantile(values, [0, 0.5, 0.9, 0.99, 1]))
    s = distribution.score_summary(df).first()
    np.testing.assert_allclose(list(s), [values.mean(), values.std(), values.min(), np.median(values), values.max()])


def test_bootstrap_is_reproducible_and_brackets_the_point(spark):
    rng = np.random.default_rng(9)
    y = rng.random(600) < 0.4
    s = np.round(rng.random(600) + 0.5 * y, 2)
    df = scored(spark, list(zip(y, s)), threshold=0.8)
    runs = [
        {r["metric"]: r.asDict() for r in bootstrap.bootstrap_all(df.repartition(n), replicates=200).collect()} for n in (1, 13)
    ]
    assert runs[0].keys() == set(bootstrap.METRICS)
    for metric, row in runs[0].items():
        assert row["lower"] < row["value"] < row["upper"] and row["width"] < 0.2
        assert runs[1][metric]["lower"] == pytest.approx(row["lower"])
    # resampling rows directly gives intervals of the same size
    direct = []
    for _ in range(200):
        pick = rng.integers(0, 600, 600)
        direct.append(brute_auc(list(zip(y[pick].tolist(), s[pick].tolist()))))
    for i, metric in enumerate(("pr_auc", "roc_auc")):
        lo, hi = np.percentile([d[i] for d in direct], [2.5, 97.5])
        assert abs(runs[0][metric]["width"] - (hi - lo)) < 0.02
        assert abs(runs[0][metric]["lower"] - lo) < 0.02


def test_draws_down_the_tree_have_the_law_of_one_draw(spark):
    """Whatever the tree's fan: every replicate deals out all rows, starts follow from what lies above, and means and variances are multinomial."""
    sizes = [(i, i % 7, (5 * i) % 11) for i in range(40)]
    groups = spark.createDataFrame(sizes, "bucket long, pos long, neg long")
    numbers = spark.range(600).select(F.col("id").alias("replicate"))
    n = sum(p + q for _, p, q in sizes)
    for fan in (2, 7, 64):
        drawn = bootstrap.bucket_draws(groups, 40, numbers, 3, fan).toPandas().sort_values(["replicate", "bucket"], ascending=[True, False])
        assert len(drawn) == 600 * 40
        by = drawn.groupby("replicate")
        assert ((by["pos"].sum() + by["neg"].sum()) == n).all()
        assert (by["pos"].cumsum() - drawn["pos"] == drawn["tp"]).all() and (by["neg"].cumsum() - drawn["neg"] == drawn["fp"]).all()
        assert (by["pos"].transform("sum") == drawn["all_pos"]).all()
        per = drawn.groupby("bucket")[["pos", "neg"]].agg(["mean", "var"])
        for b, p, q in sizes:
            for name, size in (("pos", p), ("neg", q)):
                assert abs(per.loc[b, (name, "mean")] - size) < 5 * np.sqrt(max(size, 1) / 600)
                assert abs(per.loc[b, (name, "var")] - size * (1 - size / n)) < 0.5 * max(size, 1)


def test_bootstrap_over_many_buckets(spark):
    rng = np.random.default_rng(4)
    y = rng.random(400) < 0.5
    s = rng.random(400) + 0.3 * y
    df = scored(spark, list(zip(y, s)))
    rows = bootstrap.ranking_replicates(bootstrap.score_table(df), 100, 42, groups_per_bucket=30).collect()
    values = np.array([(r["pr_auc"], r["roc_auc"]) for r in rows])
    assert len(rows) == 100
    np.testing.assert_allclose(values.mean(0), brute_auc(list(zip(y.tolist(), s.tolist()))), atol=0.02)
    with pytest.raises(ValueError, match="unknown metric"):
        bootstrap.bootstrap_ci(df, "accuracy")
    single = scored(spark, [(True, 0.5), (True, 0.7)])
    assert {tuple(r)[1:] for r in bootstrap.ranking_replicates(bootstrap.score_table(single), 5, 1).collect()} == {(0.0, 0.0)}


def test_comparison_and_baseline_join(spark):
    schema = "precision double, recall double, f1_score double, pr_auc double, roc_auc double"
    a = spark.createDataFrame([(0.9, 0.8, 0.85, None, 0.7)], schema)
    b = spark.createDataFrame([(0.5, 0.8, 0.6, 0.4, 0.6)], schema)
    table = compare.model_comparison(a, b, ("mine", "theirs"))
    rows = {r["metric"]: r for r in compare.shown(table, ("mine", "theirs")).collect()}
    assert rows["pr_auc"]["mine"] == "n/a" and rows["precision"]["theirs"] == "0.5000"
    shown = spark.createDataFrame([("Precision", 0.9), ("F1-score", 0.85), ("PR-AUC", 0.1)], "metric string, value double")
    known = spark.createDataFrame([("precision", 0.5), ("f1_score", 0.6)], "metric string, baseline_value double")
    joined = {r["metric"]: r["baseline_value"] for r in compare.with_baseline(shown, known).collect()}
    assert joined == {"precision": 0.5, "f1_score": 0.6, "pr_auc": None}


def test_rankings_and_windows(spark):
    df = scored(spark, [(i % 3 == 0, float((i * 7) % 10)) for i in range(40)], threshold=6.0)
    all_rows = sorted(((i * 7) % 10, -i) for i in range(40))[::-1]
    top = [(r["mse_score"], r["record_index"]) for r in results.top_anomalies(df, 6).collect()]
    assert top == [(float(s), -i) for s, i in all_rows[:6]]
    assert results.top_anomalies(df, 0).count() == 1
    assert results.top_anomalies(df, 0, at_least_one=False).count() == 0
    assert results.top_anomalies(df, 99, flagged_only=True).count() == df.filter("flagged").count()
    assert [r["position"] for r in results.ranked(df, 3).collect()] == [1, 2, 3]
    flags = {r["record_index"]: r["flagged"] for r in df.collect()}
    for per_bucket in (1_000_000, 6):
        got = {r["record_index"]: r["cumulative_alerts"] for r in results.cumulative_alerts(df, rows_per_bucket=per_bucket).collect()}
        assert got == {k: sum(flags[i] for i in range(k + 1)) for k in flags}
    assert [r["record_index"] for r in results.last_window(df, 4).collect()] == [39, 38, 37, 36]
    alerts = [i for i in flags if flags[i]]
    assert [r["record_index"] for r in results.recent_alerts(df, 3).collect()] == sorted(alerts)[::-1][:3]
    assert [r["record_index"] for r in results.first_flagged(df, 3).collect()] == sorted(alerts)[:3]
    capped = results.top_anomalies_then_filter(df, 5, score_range=(0.0, 8.0))
    early = results.top_anomalies_then_filter(df, 5, score_range=(0.0, 8.0), filter_first=True)
    assert capped.count() == 1 and early.count() == 5


def test_drilldown_and_previews(spark):
    from residua.roles import Roles

    df = spark.createDataFrame([(0, "a", 1.5), (1, None, 2.5)], "record_index long, s string, x double")
    assert [tuple(r) for r in results.record_drilldown(df, 1).collect()] == [("record_index", "1"), ("s", None), ("x", "2.5")]
    wide = spark.range(30).select(F.col("id").alias("record_index"), *[F.col("id").alias(f"c{i}") for i in range(45)], F.lit("Benign").alias("label"))
    shown = results.feature_preview(wide, Roles(detail_label=None))
    assert shown.columns == ["record_index", *[f"c{i}" for i in range(40)], "label"] and shown.count() == 20
