"""Writing tables, scored rows, one-row metric reports and anomaly exports."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("parquet", "csv")
STUB_LENGTH = 48

REPORT_SCHEMA = (
    "split string, model string, n_estimators int, percentile double, threshold double, precision double, "
    "recall double, f1_score double, tp bigint, fp bigint, tn bigint, fn bigint, pr_auc double, roc_auc double, "
    "accuracy double"
)


def write_processed(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    writer = df.write.mode(mode)
    writer.parquet(path) if fmt == "parquet" else writer.option("header", True).csv(path)


def write_scored(scored: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Scored rows; Parquet is laid out by ``flagged``, so alert readers skip the rest."""
    if fmt == "parquet":
        scored.write.mode(mode).partitionBy("flagged").parquet(path)
    else:
        write_processed(scored, path, fmt, mode)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """Scored rows as written by ``write_scored``; filtering on ``flagged`` reads only its folder."""
    return spark.read.parquet(path).withColumn("flagged", F.col("flagged").cast("boolean"))


def finite_report(report: DataFrame) -> DataFrame:
    """NaN and infinite metrics become null: empty in CSV, ``null`` in strict JSON."""
    floats = [f.name for f in report.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return report.withColumns(
        {c: F.when(~F.isnan(F.col(c)) & (F.abs(F.col(c)) != float("inf")), F.col(c)) for c in floats}
    )


def report_json(report: DataFrame) -> DataFrame:
    return finite_report(report).select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json")
    )


def write_metrics(report: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """A report of a few rows, written as one file."""
    safe = finite_report(report).coalesce(1)
    if fmt == "json":
        safe.write.mode(mode).option("ignoreNullFields", False).json(path)
    elif fmt == "csv":
        safe.write.mode(mode).option("header", True).option("nullValue", "").csv(path)
    elif fmt == "md":
        report_markdown(report).coalesce(1).write.mode(mode).text(path)
    else:
        raise ValueError("fmt must be json, csv or md")


def read_metrics_json(spark: SparkSession, path: str, schema: str = REPORT_SCHEMA) -> DataFrame:
    """A saved report; an absent one is an empty table."""
    try:
        return spark.read.schema(schema).option("multiLine", False).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def baseline_table(report: DataFrame) -> DataFrame:
    """(metric, baseline_value) of a saved report, for metrics it has."""
    keys = ("precision", "recall", "f1_score", "pr_auc", "accuracy")
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("baseline_value")) for k in keys])
    return report.select(F.inline(rows)).filter(F.col("baseline_value").isNotNull())


# Fields of the Markdown report and their number formats.
MARKDOWN_FIELDS = (
    ("data_source", None),
    ("rows_scored", None),
    ("flagged_count", None),
    ("true_malicious_label_count", None),
    ("threshold_mse", "%.6f"),
    ("precision", "%.4f"),
    ("recall", "%.4f"),
    ("f1_score", "%.4f"),
    ("pr_auc", "%.4f"),
    ("tp", None),
    ("fp", None),
    ("tn", None),
    ("fn", None),
)


def report_markdown(report: DataFrame) -> DataFrame:
    """The report as a Markdown table of field and value, one line per row; a missing value is a dash."""
    shown = [F.col(c).cast("string") if form is None else F.when(F.col(c).isNotNull(), F.format_string(form, c)) for c, form in MARKDOWN_FIELDS]
    rows = [F.concat(F.lit(f"| {c} | "), F.coalesce(v, F.lit("-")), F.lit(" |")) for (c, _), v in zip(MARKDOWN_FIELDS, shown, strict=True)]
    return report.select(F.explode(F.array(F.lit("| field | value |"), F.lit("|---|---|"), *rows)).alias("line"))


def file_stub(label: str) -> str:
    """File-system friendly name of a data source."""
    stub = re.sub(r"[^a-z0-9]+", "_", label.lower()).strip("_")
    return stub[:STUB_LENGTH] or "metrics"
