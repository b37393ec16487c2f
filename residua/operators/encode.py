"""Scaling and one-hot encoding, fitted on benign training rows.

The encoded vector is never written out dense: a row carries its scaled numbers and one position per
categorical column. Scorers gather by position, so a 569-wide one-hot block costs one integer per column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residua.functions.columns import no_nan
from residua.functions.lookup import lookup_join
from residua.functions.materialize import materialize
from residua.operators.labels import require_columns

MISSING_CATEGORY = "\u0000missing"
LITERAL_CATEGORIES = 256
COLLECTED_CATEGORIES = 100_000


def category_text(name: str) -> Column:
    """Missing text is a category of its own, sorted first."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(MISSING_CATEGORY))


@dataclass(frozen=True)
class EncoderModel:
    """Fitted scaler and category lists.

    ``categories`` holds (value, training share) per column in vector order. A vocabulary too large to
    collect stays in ``vocabulary`` (feature, value, slot, share), and rows find their slot by a join.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    means: tuple[float | None, ...]
    scales: tuple[float, ...]
    widths: tuple[int, ...]
    sum_share_sq: tuple[float, ...]
    categories: tuple[tuple[tuple[str, float], ...], ...] | None
    vocabulary: DataFrame | None = field(default=None, compare=False)

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(self.widths)

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    def offsets(self) -> list[int]:
        """Vector index of the first slot of each categorical column."""
        starts, at = [], len(self.numeric)
        for w in self.widths:
            starts.append(at)
            at += w
        return starts

    def feature_groups(self) -> dict[str, list[int]]:
        """Original column to its vector indices."""
        groups = {c: [i] for i, c in enumerate(self.numeric)}
        for c, start, w in zip(self.categorical, self.offsets(), self.widths, strict=True):
            groups[c] = list(range(start, start + w))
        return groups

    def feature_groups_table(self, spark) -> DataFrame:
        rows = [(f, i) for f, indices in self.feature_groups().items() for i in indices]
        return spark.createDataFrame(rows, "feature string, idx int")

    def dimension_names(self) -> list[str]:
        self._require_collected("naming the encoded dimensions")
        names = list(self.numeric)
        for c, values in zip(self.categorical, self.categories, strict=True):
            names += [f"{c}_{value}" for value, _ in values]
        return names

    def scaled(self) -> list[Column]:
        """Standard scores; a missing number, NaN included, is null."""
        return [
            (no_nan(F.col(f"`{c}`")) - F.lit(m)) / F.lit(s)
            for c, m, s in zip(self.numeric, self.means, self.scales, strict=True)
        ]

    def with_slots(self, df: DataFrame) -> DataFrame:
        """Add ``_slot_<i>`` (position inside the column's block, -1 or null when unseen) and ``_share_<i>``."""
        require_columns(df, self.features, "features the encoder was fitted on")
        if self.vocabulary is not None:
            return self._with_joined_slots(df)
        added = {}
        for i, (c, values) in enumerate(zip(self.categorical, self.categories, strict=True)):
            if len(values) > LITERAL_CATEGORIES:
                df = self._with_broadcast_slots(df, i, c, values)
                continue
            slot = (F.array_position(F.array(*[F.lit(v) for v, _ in values]), category_text(c)) - 1).cast("int")
            added[f"_slot_{i}"] = slot
            added[f"_share_{i}"] = F.get(F.array(*[F.lit(p) for _, p in values]), slot)
        return df.withColumns(added) if added else df

    def _with_broadcast_slots(self, df: DataFrame, i: int, c: str, values) -> DataFrame:
        rows = [(v, k, p) for k, (v, p) in enumerate(values)]
        table = df.sparkSession.createDataFrame(rows, f"_value string, _slot_{i} int, _share_{i} double")
        return lookup_join(df.withColumn("_value", category_text(c)), table, ["_value"], len(rows)).drop("_value")

    def _with_joined_slots(self, df: DataFrame) -> DataFrame:
        for i, (c, width) in enumerate(zip(self.categorical, self.widths, strict=True)):
            table = self.vocabulary.filter(F.col("feature") == c).select(
                F.col("value").alias("_value"), F.col("slot").alias(f"_slot_{i}"), F.col("share").alias(f"_share_{i}")
            )
            df = lookup_join(df.withColumn("_value", category_text(c)), table, ["_value"], width).drop("_value")
        return df

    def drop_slots(self, df: DataFrame) -> DataFrame:
        return df.drop(*[f"_{kind}_{i}" for i in range(len(self.categorical)) for kind in ("slot", "share")])

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``enc_num`` (scaled numbers) and ``enc_cat`` (vector index per categorical column, -1 unseen)."""
        slotted = self.with_slots(df)
        slots = [F.col(f"_slot_{i}") for i in range(len(self.categorical))]
        indices = [F.when(s >= 0, s + F.lit(start)).otherwise(-1) for s, start in zip(slots, self.offsets(), strict=True)]
        number_array = F.array(*self.scaled()) if self.numeric else F.array().cast("array<double>")
        index_array = F.array(*indices) if indices else F.array().cast("array<int>")
        return self.drop_slots(slotted.withColumns({"enc_num": number_array, "enc_cat": index_array}))

    def dense(self, num: Column | None = None, cat: Column | None = None) -> Column:
        """The full vector as an array, for the few rows that are explained."""
        num = F.col("enc_num") if num is None else num
        cat = F.col("enc_cat") if cat is None else cat
        first, last = len(self.numeric), self.width - 1
        if last < first:
            return num
        block = F.transform(
            F.sequence(F.lit(first), F.lit(last)), lambda i: F.when(F.array_contains(cat, i), 1.0).otherwise(0.0)
        )
        return F.concat(num, block)

    def center(self) -> np.ndarray:
        """Mean of the encoded training rows: 0 for a standard score, its training share for a category."""
        out = np.zeros(self.width)
        if self.vocabulary is None:
            shares = [p for block in self.categories for _, p in block]
            out[len(self.numeric) :] = shares
            return out
        first = dict(zip(self.categorical, self.offsets(), strict=True))
        found = self.vocabulary.select("feature", "slot", "share").toPandas()  # a number per dimension
        out[found["feature"].map(first).to_numpy(np.int64) + found["slot"].to_numpy(np.int64)] = found["share"].to_numpy()
        return out

    def _require_collected(self, purpose: str) -> None:
        if self.vocabulary is not None:
            raise ValueError(f"{purpose} needs a dense width, but the encoder has {self.width} dimensions")


@dataclass(frozen=True)
class FeatureEncoder:
    """Population mean and standard deviation per number, sorted categories per text column."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    collected_categories: int = COLLECTED_CATEGORIES

    def fit(self, train: DataFrame) -> EncoderModel:
        if not self.numeric and not self.categorical:
            raise ValueError("no feature columns to encode")
        require_columns(train, self.numeric + self.categorical, "features")
        means, scales, rows, estimate = self._fit_numbers(train)
        if rows == 0:
            raise ValueError("no benign rows to fit on")
        vocabulary = self._vocabulary(train)
        # the estimate only spares collecting what is surely too large; the count itself decides
        limit, collected = self.collected_categories, []
        if self.categorical:
            collected = None if estimate > 2 * limit + 100 else vocabulary.limit(limit + 1).collect()
        if collected is None or len(collected) > limit:
            return self._fit_wide(means, scales, rows, vocabulary)
        blocks = []
        for i in range(len(self.categorical)):
            blocks.append(tuple(sorted((r["value"], r["n"] / rows) for r in collected if r["f"] == i)))
        return EncoderModel(
            self.numeric,
            self.categorical,
            means,
            scales,
            tuple(len(b) for b in blocks),
            tuple(sum(p * p for _, p in b) for b in blocks),
            tuple(blocks),
        )

    def _fit_numbers(self, train: DataFrame) -> tuple[tuple, tuple, int, int]:
        """Moments of the numbers, the row count and the (estimated) number of categories, in one scan."""
        values = [F.col(f"`{c}`").cast("double") for c in self.numeric]
        present = [F.when(~F.isnan(v), v) for v in values]
        row = train.agg(
            F.count(F.lit(1)),
            *[F.avg(v) for v in present],
            *[F.stddev_pop(v) for v in present],
            *[F.approx_count_distinct(category_text(c)) for c in self.categorical],
        ).first()
        k = len(values)
        means = tuple(row[1 + i] for i in range(k))
        scales = tuple(row[1 + k + i] or 1.0 for i in range(k))
        return means, scales, row[0], sum(row[1 + 2 * k :])

    def _vocabulary(self, train: DataFrame) -> DataFrame:
        """(column position, value, rows): one scan for all columns, combined before the shuffle."""
        entries = [F.struct(F.lit(i).alias("f"), category_text(c).alias("value")) for i, c in enumerate(self.categorical)]
        schema_only = F.array().cast("array<struct<f:int,value:string>>")
        return (
            train.select(F.explode(F.array(*entries) if entries else schema_only).alias("e"))
            .groupBy("e.f", "e.value")
            .agg(F.count(F.lit(1)).alias("n"))
        )

    def _fit_wide(self, means, scales, rows: int, vocabulary: DataFrame) -> EncoderModel:
        """Vocabulary beyond the driver's reach: number the slots in a distributed order and keep a table."""
        from residua.sources.record_index import with_record_index

        names = F.array(*[F.lit(c) for c in self.categorical])
        ordered = with_record_index(vocabulary, order_by=["f", "value"], name="at")
        blocks = ordered.groupBy("f").agg(
            F.min("at").alias("first"), F.count(F.lit(1)).alias("width"), F.sum((F.col("n") / rows) ** 2).alias("sq")
        )
        per_feature = {r["f"]: r for r in blocks.collect()}
        first = F.array(*[F.lit(per_feature[i]["first"]) for i in range(len(self.categorical))])
        table = ordered.select(
            F.get(names, F.col("f")).alias("feature"),
            "value",
            (F.col("at") - F.get(first, F.col("f"))).cast(T.IntegerType()).alias("slot"),
            (F.col("n") / rows).alias("share"),
        )
        order = range(len(self.categorical))
        return EncoderModel(
            self.numeric,
            self.categorical,
            means,
            scales,
            tuple(per_feature[i]["width"] for i in order),
            tuple(per_feature[i]["sq"] for i in order),
            None,
            materialize(table, "vocabulary"),
        )
