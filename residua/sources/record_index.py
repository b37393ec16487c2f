"""Zero-based record numbers that do not depend on how Spark cuts the input into tasks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from residua.functions.lookup import lookup_join
from residua.functions.materialize import materialize
from residua.functions.running import ROWS_PER_BUCKET, running_totals, sketch_order


def index_by_number(
    df: DataFrame, key: str, name: str = "record_index", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Number rows in the order of a unique numeric key; lazy, nothing is written."""
    sketch, _ = sketch_order(df, F.col(key), rows_per_bucket)
    numbered = running_totals(df, key, {"_upto": F.lit(1)}, sketch)
    return numbered.withColumn(name, (F.col("_upto") - 1).cast("bigint")).drop("_upto")


def with_record_index(df: DataFrame, order_by: list[str] | None = None, name: str = "record_index") -> DataFrame:
    """Number rows in file order (any file scan) or in the order of any sortable columns.

    An ordered copy is range partitioned and written once; each file's row positions plus the row counts
    of the files before it give the number. File counts are one small row per file. Text and CSV scans have no row
    positions: there the rows are copied once with their place in the block of the file that a task read.
    """
    if order_by is None:
        try:
            df.select("_metadata.row_index")
        except AnalysisException:
            return _number_by_block(df, name)
        return _number_by_file(df, [], name)
    sorted_parts = df.repartitionByRange(*[F.col(c) for c in order_by]).sortWithinPartitions(*order_by)
    return _number_by_file(materialize(sorted_parts.withColumn("_part", F.spark_partition_id()), "ordered"), ["_part"], name)


def _number_by_file(df: DataFrame, lead: list[str], name: str) -> DataFrame:
    columns = [c for c in df.columns if c not in lead]
    located = df.select(
        *df.columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    # an ordered copy holds one partition per file, so its partition number leads the file order
    sizes = located.groupBy("_file").agg(
        F.count(F.lit(1)).alias("_size"), *[F.min(c).alias(c) for c in lead]
    )
    earlier = Window.orderBy(*lead, "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    offsets = materialize(offsets, "file-offsets")
    joined = lookup_join(located, offsets, ["_file"], offsets.count())
    return joined.select(*columns, (F.col("_before") + F.col("_row")).cast("bigint").alias(name))


def _number_by_block(df: DataFrame, name: str) -> DataFrame:
    """File, start of the block and order inside the task that read it, as numbers."""
    located = df.select(
        *df.columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    located = materialize(located, "located")
    blocks = located.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_size"), F.min("_line").alias("_first"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    offsets = materialize(blocks.select("_file", "_block", "_first", before.alias("_before")), "block-offsets")
    joined = lookup_join(located, offsets, ["_file", "_block"], offsets.count())
    number = F.col("_before") + F.col("_line") - F.col("_first")
    return joined.select(*df.columns, number.cast("bigint").alias(name))
