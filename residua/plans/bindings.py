"""The benchmark tables bound to column roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.functions.materialize import scratch_path
from residua.operators.reconstruct import Reconstructor
from residua.plans.detection import AnomalyDetector, DetectorModel
from residua.roles import Roles

SCORE_PLACES = 6

LINEITEM = Roles(
    key="record_key",
    ids=(),
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_linestatus", "ship_month"),
)
EVENTS = Roles(key="event_id", ids=("user_id",), numeric=("value", "k", "hour_of_day"), categorical=("user_bucket",))
EMBEDDING_WIDTH = 64
EMBEDDINGS = Roles(
    key="vec_id", ids=(), numeric=tuple(f"e{i}" for i in range(EMBEDDING_WIDTH)), categorical=()
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines; the key is unique at every scale, lines not returned are benign."""
    key = F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").cast("string")
    )
    kept = F.col("l_returnflag") == "N"
    return table(spark, folder, "lineitem").select(
        key.alias("record_key"),
        F.when(kept, "Benign").otherwise("Malicious").alias("label"),
        F.when(kept, "-").otherwise(F.col("l_returnflag")).alias("detailed_label"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_linestatus",
        F.lpad(F.month("l_shipdate").cast("string"), 2, "0").alias("ship_month"),
    )


def lineitem_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with infinite, missing and repeated cells put in by rule."""
    clean = lineitem(spark, folder)
    gaps = clean.withColumns(
        {
            "l_quantity": F.when(F.col("l_quantity") == 50, float("inf")).otherwise(F.col("l_quantity")),
            "l_discount": F.nullif("l_discount", F.lit(0.0)),
            "l_tax": F.nullif("l_tax", F.lit(0.08)),
            "l_linestatus": F.when(F.col("l_quantity") != 7, F.col("l_linestatus")),
            "label": F.when(F.col("l_quantity") != 13, F.concat(F.lit(" "), F.upper("label"), F.lit(" "))).otherwise(
                F.col("label")
            ),
        }
    )
    again = gaps.filter((F.col("l_tax") == 0.0) & F.col("l_discount").isNull())
    return gaps.unionAll(again.withColumn("record_key", F.concat("record_key", F.lit("-again"))))


def events(spark: SparkSession, folder: str) -> DataFrame:
    return event_columns(table(spark, folder, "events"))


def event_columns(raw: DataFrame) -> DataFrame:
    """Event records of a table or a stream; ``error`` events are malicious."""
    return raw.select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") == "error", "Malicious").otherwise("Benign").alias("label"),
        F.col("event_type").alias("detailed_label"),
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.hour("ts").cast("double").alias("hour_of_day"),
        F.pmod("user_id", F.lit(8)).cast("string").alias("user_bucket"),
    )


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors as one column per dimension; label 0 is benign."""
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.when(F.col("label") == 0, "Benign").otherwise("Malicious").alias("label"),
        F.col("label").cast("string").alias("detailed_label"),
        *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(EMBEDDING_WIDTH)],
    )


def event_log_lines(spark: SparkSession, folder: str, broken: str | None = None) -> DataFrame:
    """Events as log lines of four files, each with comments, a header and a merged last cell.

    Events of type ``broken`` lose the type from the last cell, so their rows have the wrong arity.
    """
    detail = F.col("event_type") if broken is None else F.when(F.col("event_type") != broken, F.col("event_type"))
    rows = table(spark, folder, "events").select(
        F.concat(F.lit("conn-"), F.pmod("user_id", F.lit(4)).cast("string"), F.lit(".log")).alias("file"),
        F.col("event_id").alias("pos"),
        F.concat_ws(
            "\t",
            F.col("event_id").cast("string"),
            F.concat(F.lit("u"), F.col("user_id").cast("string")),
            F.get_json_object("props", "$.k"),
            F.concat_ws(
                "   ",
                F.lit("-"),
                F.when(F.col("event_type") == "error", "Malicious").otherwise("Benign"),
                detail,
            ),
        ).alias("value"),
    )
    directives = F.array(
        F.struct(F.lit(-3).cast("bigint").alias("pos"), F.lit("#separator \\x09").alias("value")),
        F.struct(
            F.lit(-2).cast("bigint").alias("pos"),
            F.lit("#fields\tts\tuid\tid.resp_p\ttunnel_parents   label   detailed-label").alias("value"),
        ),
        F.struct(F.lit(-1).cast("bigint").alias("pos"), F.lit("").alias("value")),
    )
    files = rows.select("file").distinct()
    return rows.unionByName(files.select("file", F.inline(directives)))


def write_lines(lines: DataFrame) -> str:
    """Text files of (file, pos, value) lines, a folder per file, in the order of ``pos``."""
    path = scratch_path(lines.sparkSession, "logs")
    lines.repartition("file").sortWithinPartitions("file", "pos").select("file", "value").write.partitionBy("file").text(path)
    return path


def fit(df: DataFrame, roles: Roles, reconstructor: Reconstructor | None = None) -> DetectorModel:
    """The mean model's scores, which SQL twins repeat, are rounded before the threshold is taken, so a score on the threshold reads the same anywhere."""
    return AnomalyDetector(roles, reconstructor, score_places=SCORE_PLACES if reconstructor is None else None).fit(df)


def lineitem_holdout(spark: SparkSession, folder: str, split: str = "test") -> DataFrame:
    df = lineitem(spark, folder)
    return fit(df, LINEITEM).holdout(df, split)


def events_scored(spark: SparkSession, folder: str) -> DataFrame:
    df = events(spark, folder)
    return fit(df, EVENTS).transform(df)
