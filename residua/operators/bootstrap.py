"""Bootstrap confidence intervals.

Resampling rows for a fixed-threshold metric only moves counts between the four confusion cells, so those
replicates are multinomial draws over the cells. Ranking metrics resample in two steps with the same law as drawing
rows: how many rows each score bucket and class receives, drawn down a tree of buckets, then which score groups inside the bucket. The
second step runs in the task that holds the bucket, seeded by (seed, replicate, bucket); buckets are cut by the rank of a score and hold
the same number of groups whatever the table, so nothing of size replicates x rows is shuffled and the result does not depend on
partitioning.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions.lookup import lookup_join
from residua.functions.materialize import materialize
from residua.functions.running import running_totals, sketch_rows
from residua.operators.confusion import with_metrics
from residua.operators.curves import auc_of, rank_groups

CELL_METRICS = ("precision", "recall", "f1_score")
RANKING_METRICS = ("pr_auc", "roc_auc")
METRICS = CELL_METRICS + RANKING_METRICS
GROUPS_PER_BUCKET = 8_000
#: Children of a node of the tree that deals rows out to buckets.
FAN = 256
_TOTALS = ("pos", "neg", "tp", "fp", "all_pos", "all_neg")


def score_table(scored: DataFrame, score: str = "mse_score") -> DataFrame:
    """Positives and negatives per score and flag, written once: every pass below reads this, not the rows."""
    groups = scored.groupBy(F.col(score).cast("double").alias("score"), "flagged").agg(
        F.count_if("is_malicious").alias("pos"), F.count_if(~F.col("is_malicious")).alias("neg")
    )
    return materialize(groups, "scores")


def _cells(table: DataFrame) -> DataFrame:
    count = lambda n, on: F.coalesce(F.sum(F.when(on, F.col(n))), F.lit(0)).cast("bigint")
    hit = F.col("flagged")
    return table.agg(
        count("pos", hit).alias("tp"), count("neg", hit).alias("fp"), count("neg", ~hit).alias("tn"), count("pos", ~hit).alias("fn")
    )


def cell_replicates(table: DataFrame, replicates: int, seed: int) -> DataFrame:
    """(replicate, precision, recall, f1_score) over a score table; undefined values are 0."""
    cells = _cells(table).first()
    counts = np.array([cells["tp"], cells["fp"], cells["tn"], cells["fn"]])
    n = int(counts.sum())

    def draw(batches):
        for batch in batches:
            draws = np.array([np.random.default_rng([seed, r]).multinomial(n, counts / n) for r in batch["replicate"]])
            tp, fp, _, fn = draws.T.astype(float)
            precision = np.divide(tp, tp + fp, out=np.zeros_like(tp), where=tp + fp > 0)
            recall = np.divide(tp, tp + fn, out=np.zeros_like(tp), where=tp + fn > 0)
            both = precision + recall
            f1 = np.divide(2 * precision * recall, both, out=np.zeros_like(tp), where=both > 0)
            yield pd.DataFrame({"replicate": batch["replicate"], "precision": precision, "recall": recall, "f1_score": f1})

    numbers = table.sparkSession.range(replicates).select(F.col("id").alias("replicate"))
    return numbers.mapInPandas(draw, "replicate long, precision double, recall double, f1_score double")


class _Resampler:
    """Draws with replacement from the rows of one bucket and class, as counts per score group."""

    def __init__(self, counts: np.ndarray) -> None:
        rows = int(counts.sum())
        few_copies = rows <= 4 * len(counts)
        self.size = len(counts)
        self.owners = np.repeat(np.arange(self.size), counts) if few_copies else None
        self.shares = None if few_copies else counts / rows

    def draw(self, rng: np.random.Generator, total: int) -> np.ndarray:
        if self.owners is None:
            return rng.multinomial(total, self.shares)
        if not total:
            return np.zeros(self.size, dtype=np.int64)
        return np.bincount(self.owners[rng.integers(0, len(self.owners), total)], minlength=self.size)


def bucket_draws(groups: DataFrame, n_buckets: int, numbers: DataFrame, seed: int, fan: int = FAN) -> DataFrame:
    """(bucket, replicate, pos, neg, tp, fp, all_pos, all_neg): rows that every bucket and class gets in a replicate, and what lies above.

    A tree over the buckets, highest scores first: a node's rows are drawn among its ``fan`` children, seeded by replicate and node, which
    has the law of drawing among all buckets at once. No task sees more than one node's children.
    """
    sizes = groups.groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    sizes = materialize(sizes.withColumn("place", F.lit(n_buckets - 1) - F.col("bucket")), "bucket-sizes")
    found = sizes.agg(F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))).first()
    cells = np.array([int(found[0]), int(found[1])])
    levels = 1
    while fan**levels < n_buckets:
        levels += 1

    def whole(batches):
        n = int(cells.sum())
        for batch in batches:
            draws = [np.random.default_rng([seed, r]).multinomial(n, cells / max(n, 1)) if n else (0, 0) for r in batch["replicate"]]
            pos, neg = np.array(draws, dtype=np.int64).reshape(-1, 2).T
            zero = np.zeros(len(pos), dtype=np.int64)
            yield pd.DataFrame(dict(zip(("node", "replicate", *_TOTALS), (zero, batch["replicate"], pos, neg, zero, zero, pos, neg), strict=True)))

    def among_children(level: int):
        def split(batches):
            for batch in batches:
                for row in batch.itertuples():
                    kids = [k["place"] for k in row.kids]
                    weights = np.array([(k["pos"], k["neg"]) for k in row.kids], dtype=float)
                    rng = np.random.default_rng([seed, row.replicate, level, row.node])
                    given = [rng.multinomial(n, w / w.sum()) if w.sum() else np.zeros(len(kids), np.int64) for n, w in zip((row.pos, row.neg), weights.T, strict=True)]
                    above = [start + np.cumsum(g) - g for start, g in zip((row.tp, row.fp), given, strict=True)]
                    yield pd.DataFrame(dict(zip(("node", "replicate", *_TOTALS), (kids, row.replicate, *given, *above, row.all_pos, row.all_neg), strict=True)))

        return split

    schema = ", ".join(f"{c} long" for c in ("node", "replicate", *_TOTALS))
    state = numbers.mapInPandas(whole, schema)
    for level in range(1, levels + 1):
        child = F.floor(F.col("place") / fan ** (levels - level))
        kids = sizes.groupBy(child.alias("place")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        kids = kids.groupBy(F.floor(F.col("place") / fan).alias("node")).agg(F.sort_array(F.collect_list(F.struct("place", "pos", "neg"))).alias("kids"))
        nodes = -(-n_buckets // fan ** (levels - level + 1))
        state = lookup_join(state, kids, ["node"], nodes).mapInPandas(among_children(level), schema)
    return state.select((F.lit(n_buckets - 1) - F.col("node")).alias("bucket"), "replicate", *_TOTALS)


def ranking_replicates(
    table: DataFrame, replicates: int, seed: int, groups_per_bucket: int = GROUPS_PER_BUCKET
) -> DataFrame:
    """(replicate, pr_auc, roc_auc) over a score table; 0 for a replicate that drew a single class."""
    score = F.col("score")
    numbers = table.sparkSession.range(replicates).select(F.col("id").alias("replicate"))
    undefined = score.isNull() | F.isnan(score) | (F.abs(score) == float("inf"))
    if not table.filter(undefined).isEmpty():  # as for the point value
        none = F.lit(None).cast("double")
        return numbers.select("replicate", none.alias("pr_auc"), none.alias("roc_auc"))
    groups = table.groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    n_groups = groups.count()
    # buckets are cut by the rank of the score, which no partitioning changes
    groups = running_totals(groups, "score", {"upto": F.lit(1)}, sketch_rows(n_groups))
    groups = groups.withColumn("bucket", F.floor((F.col("upto") - 1) / groups_per_bucket)).drop("upto")
    totals = bucket_draws(groups, max(1, -(-n_groups // groups_per_bucket)), numbers, seed)

    def partial_metrics(key: tuple, group: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("score", ascending=False)
        positives, negatives = _Resampler(ordered["pos"].to_numpy()), _Resampler(ordered["neg"].to_numpy())
        out = []
        for row in start.itertuples():
            rng = np.random.default_rng([seed, int(row.replicate), int(key[0]) + 1])
            pos, neg = positives.draw(rng, row.pos), negatives.draw(rng, row.neg)
            tp, fp = row.tp + np.cumsum(pos), row.fp + np.cumsum(neg)
            precision = np.divide(tp, tp + fp, out=np.zeros(len(tp)), where=tp + fp > 0)
            area = float((neg * (tp - pos / 2.0)).sum())
            out.append((row.replicate, float((pos * precision).sum()), area, row.all_pos, row.all_neg))
        return pd.DataFrame(out, columns=["replicate", "ap", "area", "all_pos", "all_neg"])

    partial = (
        groups.groupBy("bucket")
        .cogroup(totals.groupBy("bucket"))
        .applyInPandas(partial_metrics, "replicate long, ap double, area double, all_pos long, all_neg long")
    )
    both = (F.first("all_pos") > 0) & (F.first("all_neg") > 0)
    p, n = F.first("all_pos"), F.first("all_neg")
    return partial.groupBy("replicate").agg(
        F.when(both, F.sum("ap") / p).otherwise(0.0).alias("pr_auc"),
        F.when(both, F.sum("area") / (p * n)).otherwise(0.0).alias("roc_auc"),
    )


def bootstrap_ci(
    scored: DataFrame, metric: str, replicates: int = 1000, ci: float = 0.95, seed: int = 42, score: str = "mse_score"
) -> DataFrame:
    """(metric, lower, upper) for one metric."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {METRICS}")
    draw = cell_replicates if metric in CELL_METRICS else ranking_replicates
    return _intervals(draw(score_table(scored, score), replicates, seed), (metric,), ci)


def _intervals(values: DataFrame, metrics: tuple[str, ...], ci: float) -> DataFrame:
    alpha = (1.0 - ci) / 2.0
    long = values.unpivot("replicate", list(metrics), "metric", "value")
    bounds = F.percentile("value", F.array(F.lit(alpha), F.lit(1.0 - alpha)))  # one value per replicate: bounded
    return (
        long.groupBy("metric")
        .agg(bounds.alias("b"))
        .select("metric", F.get("b", F.lit(0)).alias("lower"), F.get("b", F.lit(1)).alias("upper"))
    )


def bootstrap_all(
    scored: DataFrame, replicates: int = 1000, ci: float = 0.95, seed: int = 42, score: str = "mse_score"
) -> DataFrame:
    """(metric, value, lower, upper, width) for the five metrics."""
    table = score_table(scored, score)
    cells = _intervals(cell_replicates(table, replicates, seed), CELL_METRICS, ci)
    ranking = _intervals(ranking_replicates(table, replicates, seed), RANKING_METRICS, ci)
    point = with_metrics(_cells(table), "zero").select(*CELL_METRICS)
    auc = auc_of(rank_groups(table.drop("flagged")))
    points = point.unpivot([], list(CELL_METRICS), "metric", "value").unionByName(
        auc.unpivot([], list(RANKING_METRICS), "metric", "value")
    )
    return points.join(cells.unionByName(ranking), "metric").withColumn("width", F.col("upper") - F.col("lower"))
