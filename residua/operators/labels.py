"""Features, labels and identifiers; binary ground truth; flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residua.functions.columns import count_where, exceeds, is_benign, is_malicious, label_text
from residua.roles import Roles


def require_columns(df: DataFrame, columns: tuple[str, ...] | list[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing[:20]}")


def split_features_labels(df: DataFrame, roles: Roles) -> DataFrame:
    """Feature columns plus the stripped label texts; fails before any job when a label column is absent."""
    require_columns(df, roles.labels, "label columns")
    features = [c for c in df.columns if c not in roles.labels]
    return df.select(*[F.col(f"`{c}`") for c in features], *[label_text(F.col(f"`{c}`")).alias(c) for c in roles.labels])


def drop_identifiers(df: DataFrame, roles: Roles) -> DataFrame:
    return df.drop(*roles.ids)


def with_binary_label(df: DataFrame, roles: Roles) -> DataFrame:
    return df.withColumn("is_malicious", is_malicious(roles.label))


def binary_label(df: DataFrame, roles: Roles) -> Column:
    return is_malicious(roles.label).cast("int")


def with_flag(df: DataFrame, threshold: float | Column, score: str = "mse_score") -> DataFrame:
    """``flagged`` is strict: a score equal to the threshold, or a missing one, is not flagged."""
    bound = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.withColumn("flagged", exceeds(F.col(score), bound))


def benign_rows(df: DataFrame, roles: Roles, split: str | None = None) -> DataFrame:
    rows = df.filter(is_benign(roles.label))
    return rows if split is None else rows.filter(F.col("split") == split)


def benign_counts(df: DataFrame, roles: Roles) -> DataFrame:
    """Benign rows per split, the guard in front of fitting."""
    return df.groupBy("split").agg(count_where(is_benign(roles.label)).alias("benign_rows"))
