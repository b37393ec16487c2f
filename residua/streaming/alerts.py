"""Scoring a stream, writing its alerts and keeping running totals.

The detector is fixed, so scoring is stateless and appends; the only state is global counters and a quantile sketch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from residua.functions.columns import half_even, no_nan
from residua.operators.results import alert_columns
from residua.operators.thresholds import THRESHOLD_PERCENTILE
from residua.plans.detection import DetectorModel

#: Column that numbers the versions of a published one-row table.
VERSION = "_version"
#: Size of a quantile sketch: some 40 kB of state, a rank error of 0.15 %.
SKETCH = 4096


def parquet_stream(
    spark: SparkSession, folder: str, schema: T.StructType, file_glob: str | None = None, files_per_trigger: int = 1000
) -> DataFrame:
    """Records arriving as Parquet files; ``files_per_trigger`` sets how many one micro-batch takes."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.parquet(folder)


def score_stream(stream: DataFrame, detector: DetectorModel) -> DataFrame:
    return detector.transform(stream)


def alert_stream(scored: DataFrame, key: str) -> DataFrame:
    """Flagged records only, with the columns an alert shows."""
    return alert_columns(scored.filter(F.col("flagged")), key)


def running_kpis(scored: DataFrame) -> DataFrame:
    """Processed records, alerts and alert rate in percent; the same expression on a stream or a table."""
    processed, alerts = F.count(F.lit(1)), F.count_if("flagged")
    return scored.groupBy().agg(
        processed.cast("bigint").alias("processed"),
        alerts.cast("bigint").alias("alerts"),
        half_even(F.lit(100.0) * alerts / F.greatest(processed, F.lit(1)), 4).alias("alert_rate_pct"),
    )


def write_alerts(alerts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append alerts to a Parquet table, taking everything available and then stopping."""
    return (
        alerts.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def publish_kpis(kpis: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add a version of the one-row totals table after every micro-batch; ``latest`` reads the newest.

    A version is one file that appears whole or not at all, named by its batch; nothing is ever replaced or deleted, so a reader
    always finds the last complete version, and a batch that is run again after a crash adds the same row once more, which changes
    nothing. Files of older versions may be removed at any time.
    """

    def add(batch: DataFrame, number: int) -> None:
        batch.withColumn(VERSION, F.lit(number).cast("long")).coalesce(1).write.mode("append").parquet(path)

    return (
        kpis.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )


def latest(versions: DataFrame) -> DataFrame:
    """The row of the highest version, without it; no row if there is none."""
    names = [c for c in versions.columns if c != VERSION]
    newest = versions.agg(F.max_by(F.struct(*names), VERSION).alias("row"))
    return newest.filter("row IS NOT NULL").select("row.*")


def score_sketch(scored: DataFrame, score: str = "mse_score", k: int = SKETCH) -> DataFrame:
    """One row: a mergeable quantile sketch of the scores and their number, over a table or as the state of a stream.

    For a stream without a saved threshold. Missing scores are left out.
    """
    value = no_nan(F.col(score).cast("double"))
    return scored.filter(value.isNotNull()).groupBy().agg(F.kll_sketch_agg_double(value, k).alias("sketch"), F.count(F.lit(1)).alias("scores"))


def sketched_threshold(sketch: DataFrame, percentile: float = THRESHOLD_PERCENTILE) -> DataFrame:
    """(threshold, scores): a score whose rank is within ``rank_error`` of the percentile; the exact way is ``fit_threshold``."""
    return sketch.select(F.kll_sketch_get_quantile_double("sketch", F.lit(percentile / 100.0)).alias("threshold"), "scores")


def rank_error(k: int = SKETCH) -> float:
    """How far, as a share of the rows, a sketched quantile's rank may be off, with 99 % confidence."""
    return 2.296 / k**0.9021
