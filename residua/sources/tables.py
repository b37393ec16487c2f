"""Header CSV and Parquet tables with explicit errors."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts a CSV reader takes for a missing cell.
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


class TableError(ValueError):
    """A table that cannot be read, with a message fit for the user."""


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet by suffix, else a UTF-8 CSV with a header line.

    Without a schema the CSV is read as text, missing-value tokens become null and one aggregate finds the
    narrowest type of every column. Pass the schema, or convert to Parquet once, for repeated reads.
    """
    try:
        if path.rstrip("/").endswith(".parquet"):
            return spark.read.parquet(path)
        reader = spark.read.option("header", True).option("mode", "FAILFAST").option("encoding", "UTF-8")
        if schema is not None:
            return reader.schema(schema).csv(path)
        raw = reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no table at {path}") from error
        raise TableError(f"cannot read {path}: {error.getMessage()}") from error
    if not raw.columns:
        raise TableError(f"{path} is empty: no header line")
    return infer_types(missing_tokens_to_null(raw))


def missing_tokens_to_null(df: DataFrame, tokens: tuple[str, ...] = MISSING_TOKENS) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*tokens), F.col(f"`{c}`")) for c in texts}) if texts else df


def infer_types(df: DataFrame) -> DataFrame:
    """Cast text columns whose every value is a whole number, a number or a truth value."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    fits = [
        F.count(F.expr(f"try_cast(`{c}` as {t})")) == F.count(f"`{c}`") for c in texts for t in ("bigint", "double")
    ]
    truth = [F.count_if(F.lower(f"`{c}`").isin("true", "false")) == F.count(f"`{c}`") for c in texts]
    filled = [F.count(f"`{c}`") > 0 for c in texts]
    row = df.agg(*fits, *truth, *filled).first()
    n, casts = len(texts), {}
    for i, c in enumerate(texts):
        whole, number, boolean, any_value = row[2 * i], row[2 * i + 1], row[2 * n + i], row[3 * n + i]
        if not any_value or number:
            casts[c] = F.expr(f"cast(`{c}` as {'bigint' if whole and any_value else 'double'})")
        elif boolean:
            casts[c] = F.expr(f"cast(`{c}` as boolean)")
    return df.withColumns(casts) if casts else df


def dataset_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) per file, to recognise an input that was already scored."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))
