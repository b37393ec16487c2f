"""Isolation forest (Liu, Ting and Zhou, 2008): trees grown on the executors from hashed subsamples.

Rows are hashed into per-tree candidate slots in one scan, a bounded number of them (about twice what the trees
need), every tree keeps its lowest hashes, and trees grow in parallel, one small group each. Splits test a number or a category
directly, so no encoded row is written out, however wide the encoder.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from residua.functions.columns import no_nan
from residua.functions.materialize import spread_small
from residua.operators.encode import EncoderModel
from residua.operators.reconstruct import compact_arrays, complete_rows

_NODES = "tree int, node int, feature int, cut double, left int, right int, path double"


def average_path(n: float) -> float:
    """Expected path length of an unsuccessful search in a binary search tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def grow_tree(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple[int, float, int, int, float]]:
    """Nodes as (feature, cut, left, right, path); leaves have feature -1 and carry their path length."""
    nodes: list = [None]
    pending = [(0, np.arange(len(x)), 0)]
    while pending:
        at, rows, depth = pending.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(open_features):
            nodes[at] = (-1, 0.0, at, at, depth + average_path(len(rows)))
            continue
        feature = int(rng.choice(open_features))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = x[rows, feature] <= cut
        left, right = len(nodes), len(nodes) + 1
        nodes += [None, None]
        nodes[at] = (feature, cut, left, right, 0.0)
        pending += [(left, rows[goes_left], depth + 1), (right, rows[~goes_left], depth + 1)]
    return nodes


def feature_columns(encoder: EncoderModel) -> np.ndarray:
    """First encoded dimension of every categorical column, and the one behind the last."""
    return np.array([*encoder.offsets(), encoder.width], dtype=np.int64)


def feature_values(z: np.ndarray, cat: np.ndarray, starts: np.ndarray, rows: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Value of one encoded dimension per row: a number, or whether the row's category of that column is this one."""
    n_num = z.shape[1]
    if not cat.shape[1]:
        return z[rows, features]
    column = np.clip(np.searchsorted(starts, features, side="right") - 1, 0, cat.shape[1] - 1)
    hit = (cat[rows, column] == features).astype(float)
    return hit if not n_num else np.where(features < n_num, z[rows, np.minimum(features, n_num - 1)], hit)


@dataclass(frozen=True)
class IsolationForestModel:
    """Score ``2^(-E[h]/c) - 0.5``, higher is more anomalous; flagged above 0. A row with a missing number has no score."""

    encoder: EncoderModel
    nodes: pd.DataFrame
    sample_rows: int
    depth: int

    def with_score(self, df: DataFrame, name: str = "mse_score") -> DataFrame:
        n_num, n_cat, starts = len(self.encoder.numeric), len(self.encoder.categorical), feature_columns(self.encoder)
        trees = []
        for _, t in self.nodes.sort_values(["tree", "node"]).groupby("tree"):
            trees.append((t["feature"].clip(lower=0).to_numpy(np.int64), *(t[c].to_numpy() for c in ("cut", "left", "right", "path"))))
        shared = df.sparkSession.sparkContext.broadcast(trees)
        depth, scale = self.depth, average_path(self.sample_rows)

        @F.arrow_udf("double")
        def score(num: pa.Array, cat: pa.Array) -> pa.Array:
            z, c = compact_arrays(num, cat, n_num, n_cat)
            rows = np.arange(len(z))
            lengths = np.zeros(len(z))
            for feature, cut, left, right, path in shared.value:
                at = np.zeros(len(z), dtype=np.int64)
                for _ in range(depth):
                    at = np.where(feature_values(z, c, starts, rows, feature[at]) <= cut[at], left[at], right[at])
                lengths += path[at]
            result = np.exp2(-lengths / (len(shared.value) * scale)) - 0.5
            return pa.array(np.where(np.isnan(z).any(axis=1), np.nan, result))

        scored = self.encoder.transform(spread_small(df)).withColumn(name, no_nan(score("enc_num", "enc_cat")))
        return scored.drop("enc_num", "enc_cat")

    def transform(self, df: DataFrame) -> DataFrame:
        return self.with_score(df).withColumn("flagged", F.coalesce(F.col("mse_score") > 0, F.lit(False)))


@dataclass(frozen=True)
class IsolationForest:
    n_trees: int = 200
    max_samples: int = 256
    seed: int = 42

    def fit(self, train: DataFrame, encoder: EncoderModel, key: str) -> IsolationForestModel:
        encoded = complete_rows(encoder.transform(train))
        n_rows = encoded.count()
        if n_rows < 2:
            raise ValueError("the isolation forest needs at least 2 benign rows without a missing number")
        sample = min(self.max_samples, n_rows)
        depth = max(1, math.ceil(math.log2(sample)))
        samples = self._samples(encoded, key, n_rows, sample)
        n_num, n_cat, seed = len(encoder.numeric), len(encoder.categorical), self.seed

        def grow(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("place")
            tree = int(group["tree"].iloc[0])
            z = np.array(group["enc_num"].to_list(), dtype=float).reshape(len(group), n_num)
            cat = np.array(group["enc_cat"].to_list(), dtype=np.int64).reshape(len(group), n_cat)
            # of the one-hot dimensions only those of the sample's own categories differ between its rows
            slots = np.unique(cat[cat >= 0])
            x = np.hstack([z, (cat[:, :, None] == slots).any(axis=1).astype(float)])
            nodes = grow_tree(x, np.random.default_rng([seed, tree]), depth)
            out = pd.DataFrame(nodes, columns=["feature", "cut", "left", "right", "path"])
            names = np.concatenate([np.arange(n_num), slots]).astype(np.int64)
            out["feature"] = np.where(out["feature"] >= 0, names[out["feature"].clip(lower=0)], -1)
            out.insert(0, "node", np.arange(len(out)))
            out.insert(0, "tree", tree)
            return out

        nodes = samples.groupBy("tree").applyInPandas(grow, _NODES).toPandas()
        return IsolationForestModel(encoder, nodes, sample, depth)

    def _samples(self, encoded: DataFrame, key: str, n_rows: int, sample: int) -> DataFrame:
        """Lowest ``sample`` hashes per tree. Candidates in total stay near ``2 * n_trees * sample``."""
        wanted = 2.0 * self.n_trees * sample
        h = lambda tag: F.xxhash64(F.lit(f"{self.seed}:{tag}"), F.col(key))
        copies = min(self.n_trees, math.ceil(wanted / n_rows))
        rows = encoded
        if n_rows > wanted:
            resolution = 1 << 53
            rows = rows.filter(F.pmod(h("pool"), F.lit(resolution)) < F.lit(math.ceil(wanted / n_rows * resolution)))
        start = F.pmod(h("tree"), F.lit(self.n_trees))
        slots = F.transform(F.sequence(F.lit(0), F.lit(copies - 1)), lambda i: ((start + i) % self.n_trees).cast("int"))
        candidates = rows.select("enc_num", "enc_cat", F.col(key).alias("_key"), F.explode(slots).alias("tree"))
        order = F.xxhash64(F.lit(f"{self.seed}:draw"), F.col("tree"), F.col("_key"))
        by_tree = Window.partitionBy("tree").orderBy(order, "_key")
        return (
            candidates.withColumn("place", F.row_number().over(by_tree))
            .filter(F.col("place") <= sample)
            .select("tree", "place", "enc_num", "enc_cat")
        )
