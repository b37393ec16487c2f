"""Running totals over a global order without a single-task window.

A large table is written once, range partitioned by the order; its partition number is the bucket. A window runs inside each
bucket and the totals of the earlier buckets (one small row per bucket) are added on top.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.functions.materialize import materialize

ROWS_PER_BUCKET = 1_000_000


@dataclass(frozen=True)
class OrderSketch:
    """Row count of a table and the number of buckets its order is cut into."""

    rows: int
    buckets: int

    def place(self, df: DataFrame, order: str) -> DataFrame:
        """Add ``_bucket``; equal values share a bucket, greater ones lie in the same or a later one."""
        if self.buckets == 1:
            return df.withColumn("_bucket", F.lit(0))
        parts = df.repartitionByRange(self.buckets, F.col(order))
        return materialize(parts.withColumn("_bucket", F.spark_partition_id()), "ordered")


def sketch_order(
    df: DataFrame, order: Column, rows_per_bucket: int = ROWS_PER_BUCKET, extra: dict[str, Column] | None = None
) -> tuple[OrderSketch, dict[str, object]]:
    """One scan: row count, any extra aggregates, and the number of buckets."""
    extra = extra or {}
    first = df.agg(F.count(order).alias("_rows"), *[c.alias(n) for n, c in extra.items()]).first()
    return sketch_rows(first["_rows"], rows_per_bucket), {n: first[n] for n in extra}


def sketch_rows(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> OrderSketch:
    """Buckets for a table of known size."""
    return OrderSketch(rows, max(1, math.ceil(rows / rows_per_bucket)))


def running_totals(
    df: DataFrame,
    order: str,
    sums: dict[str, Column],
    sketch: OrderSketch,
    by: tuple[str, ...] = (),
    descending: bool = False,
    keep_bucket: bool = False,
) -> DataFrame:
    """Add one inclusive running total per entry of ``sums``; ``order`` must be unique within ``by``."""
    direction = F.col(order).desc() if descending else F.col(order).asc()
    bucketed = sketch.place(df, order)
    w = Window.partitionBy(*by, "_bucket").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    if sketch.buckets == 1:
        totalled = bucketed.withColumns({n: F.sum(c).over(w) for n, c in sums.items()})
        return totalled if keep_bucket else totalled.drop("_bucket")

    bucket_direction = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    earlier = Window.partitionBy(*by).orderBy(bucket_direction).rowsBetween(Window.unboundedPreceding, -1)
    totals = bucketed.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_total_{n}") for n, c in sums.items()])
    keys = [*by, "_bucket"]
    offsets = totals.select(
        *[F.col(k).alias(f"_at_{k}") for k in keys],
        *[F.coalesce(F.sum(f"_total_{n}").over(earlier), F.lit(0)).alias(f"_offset_{n}") for n in sums],
    )
    if not by:
        offsets = F.broadcast(offsets)  # one row per bucket
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_at_{k}"))  # a missing group is a group
    added = bucketed.join(offsets, same).withColumns({n: F.sum(c).over(w) + F.col(f"_offset_{n}") for n, c in sums.items()})
    dropped = [f"_at_{k}" for k in keys] + [f"_offset_{n}" for n in sums]
    return added.drop(*dropped) if keep_bucket else added.drop("_bucket", *dropped)
