"""Table audits: quality counts, label counts, missing cells, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residua.functions.columns import count_where, half_even, label_text, strip
from residua.functions.repeats import apart
from residua.roles import numeric_columns

_FLOATS = (T.DoubleType, T.FloatType)


def missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating point column."""
    c = F.col(f"`{column}`")
    return c.isNull() | F.isnan(c) if isinstance(df.schema[column].dataType, _FLOATS) else c.isNull()


def _cells(conditions: list[Column]) -> Column:
    """Cells meeting their condition, over all rows."""
    per_row = sum((c.cast("int") for c in conditions), F.lit(0))
    return F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint")


def total_missing_cells(df: DataFrame, name: str = "missing_cells") -> DataFrame:
    return df.agg(_cells([missing(df, c) for c in df.columns]).alias(name))


def duplicate_row_count(df: DataFrame, name: str = "duplicate_rows") -> DataFrame:
    """Rows minus distinct rows; missing cells compare equal. Only rows that may be repeated are compared in full."""
    parts = apart(df, df.columns)
    rows = df if parts is None else parts[1]
    groups = rows.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias(name))


def duplicate_key_count(df: DataFrame, key: str, name: str = "duplicate_keys") -> DataFrame:
    """Rows whose key was already seen; a missing key is one key."""
    return duplicate_row_count(df.select(key), name)


def schema_overview(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")


def quality_summary(df: DataFrame) -> DataFrame:
    """One row of audit counts. Equal rows are collapsed first, so one shuffle serves every count."""
    numeric = set(numeric_columns(df))
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    copies = F.col("_copies")
    invalid = [
        missing(df, c) | F.coalesce(F.abs(F.col(f"`{c}`")) == float("inf"), F.lit(False))
        for c in df.columns
        if c in numeric
    ]
    invalid_per_row = sum((i.cast("int") for i in invalid), F.lit(0))
    with_nulls = sum(
        (F.coalesce(F.bool_or(missing(df, c)), F.lit(False)).cast("bigint") for c in df.columns), F.lit(0)
    )
    return groups.agg(
        F.coalesce(F.sum(copies), F.lit(0)).cast("bigint").alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        with_nulls.cast("bigint").alias("columns_with_nulls"),
        F.coalesce(F.sum(copies * invalid_per_row), F.lit(0)).cast("bigint").alias("invalid_numeric_cells"),
    )


def label_quality_summary(df: DataFrame, label: str = "label") -> DataFrame:
    """Distinct case-insensitive labels, benign and other rows; nulls when there is no label column."""
    names = ("unique_labels", "benign_rows", "non_benign_rows")
    if label not in df.columns:
        return df.sparkSession.range(1).select(*[F.lit(None).cast("bigint").alias(n) for n in names])
    counts = df.groupBy(F.lower(label_text(label)).alias("l")).agg(F.count(F.lit(1)).alias("n"))
    benign = F.col("l") == "benign"
    return counts.agg(
        F.count(F.lit(1)).cast("bigint").alias(names[0]),
        F.coalesce(F.sum(F.when(benign, F.col("n"))), F.lit(0)).cast("bigint").alias(names[1]),
        F.coalesce(F.sum(F.when(~benign, F.col("n"))), F.lit(0)).cast("bigint").alias(names[2]),
    )


def missing_values_audit(df: DataFrame, top_n: int = 25) -> DataFrame:
    """Columns with missing cells, most first; one wide aggregate, then one row per column."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)]
    )
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_cells")) for i, c in enumerate(df.columns)]
    )
    pct = half_even(F.lit(100.0) * F.col("missing_cells") / F.greatest(F.col("_rows"), F.lit(1)), 2)
    return (
        counted.select("_rows", F.inline(entries))
        .filter(F.col("missing_cells") > 0)
        .select("column", F.col("missing_cells").cast("bigint").alias("missing_cells"), pct.alias("missing_pct"))
        .orderBy(F.col("missing_cells").desc(), "column")
        .limit(top_n)
    )


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(count_where(F.lit(True)).alias("rows"))


def top_detail_labels(df: DataFrame, column: str = "detailed_label", n: int = 12) -> DataFrame:
    counts = df.groupBy(F.col(column).alias("detailed_label")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.col("rows").desc(), "detailed_label").limit(n)


def distinct_labels(df: DataFrame, label: str = "label") -> DataFrame:
    return df.select(strip(F.col(label).cast("string")).alias("label")).distinct().orderBy("label")
