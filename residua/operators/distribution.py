"""Score distributions: quantiles, summary and equal-width histograms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residua.functions.columns import no_nan
from residua.functions.quantiles import exact_quantiles

# Quantiles shown, histogram bin counts and the sample size of the quick histogram.
SHOWN_QUANTILES = {"Minimum": 0.0, "Median": 0.5, "90th percentile": 0.9, "99th percentile": 0.99, "Maximum": 1.0}
HISTOGRAM_BINS = 40
CLASS_HISTOGRAM_BINS = 80
SAMPLE_ROWS = 12_000
SAMPLE_BINS = (8, 28)


def score_quantiles(scored: DataFrame, score: str = "mse_score") -> DataFrame:
    found = exact_quantiles(scored, {"s": F.col(score)}, list(SHOWN_QUANTILES.values()))["s"]
    rows = list(zip(SHOWN_QUANTILES, found, strict=True))
    return scored.sparkSession.createDataFrame(rows, "statistic string, score double")


def score_summary(scored: DataFrame, score: str = "mse_score") -> DataFrame:
    """Mean, population standard deviation, minimum, median and maximum in one row."""
    s = no_nan(F.col(score))
    median = exact_quantiles(scored, {"s": s}, [0.5])["s"][0]
    return scored.agg(
        F.avg(s).alias("mean"),
        F.stddev_pop(s).alias("std"),
        F.min(s).alias("min"),
        F.lit(median).cast("double").alias("median"),
        F.max(s).alias("max"),
    )


def _range(scored: DataFrame, score: str) -> tuple[float, float, int]:
    s = no_nan(F.col(score))
    lo, hi, n = scored.agg(F.min(s), F.max(s), F.count(s)).first()
    if n and lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    return lo, hi, n


def _edge(i: Column, lo: float, hi: float, bins: int) -> Column:
    return F.when(i == bins, F.lit(hi)).otherwise(i * F.lit((hi - lo) / bins) + F.lit(lo))


def _binned(scored: DataFrame, score: str, lo: float, hi: float, bins: int, by: list[str]) -> DataFrame:
    """Rows per bin: left-closed bins, last bin closed, the computed index corrected against the printed edges."""
    s, i = F.col("_s"), F.col("_i")
    first = F.least(F.floor((s - lo) / F.lit(hi - lo) * F.lit(float(bins))), F.lit(bins - 1))
    lower = (s < _edge(i, lo, hi, bins)).cast("int")
    higher = ((s >= _edge(i + 1, lo, hi, bins)) & (i < bins - 1)).cast("int")
    placed = scored.select(*by, no_nan(F.col(score)).alias("_s")).withColumn("_i", first)
    # a missing score goes to bin -1, which the join to the bins leaves out; a not-null test on the bin would be
    # pushed below the grouping and repeat the whole score expression
    index = F.coalesce((i - lower + higher).cast("int"), F.lit(-1))
    return placed.groupBy(*by, index.alias("bin")).agg(F.count("_s").alias("n"))


def _bins_table(scored: DataFrame, lo: float, hi: float, bins: int) -> DataFrame:
    i = F.col("id").cast("int")
    return scored.sparkSession.range(bins).select(
        i.alias("bin"), _edge(i, lo, hi, bins).alias("bin_start"), _edge(i + 1, lo, hi, bins).alias("bin_end")
    )


def score_histogram(scored: DataFrame, bins: int = HISTOGRAM_BINS, score: str = "mse_score") -> DataFrame:
    """(bin, bin_start, bin_end, count) over the score range, empty bins included."""
    lo, hi, n = _range(scored, score)
    if not n:
        return scored.sparkSession.createDataFrame([], "bin int, bin_start double, bin_end double, count bigint")
    counts = _binned(scored, score, lo, hi, bins, [])
    return (
        _bins_table(scored, lo, hi, bins)
        .join(counts, "bin", "left")
        .select("bin", "bin_start", "bin_end", F.coalesce("n", F.lit(0)).cast("bigint").alias("count"))
    )


def score_histogram_sampled(
    scored: DataFrame, order: str = "record_index", rows: int = SAMPLE_ROWS, score: str = "mse_score"
) -> DataFrame:
    """(mid, count) over the first ``rows`` records; the bin count follows the square root of the sample."""
    sample = scored.select(order, score).orderBy(order).limit(rows)
    n = sample.count()
    low, high = SAMPLE_BINS
    histogram = score_histogram(sample, min(high, max(low, math.isqrt(n))), score)
    return histogram.select("bin", ((F.col("bin_start") + F.col("bin_end")) / 2.0).alias("mid"), "count")


def score_histogram_by_class(
    scored: DataFrame, bins: int = CLASS_HISTOGRAM_BINS, labelled: bool = True, score: str = "mse_score"
) -> DataFrame:
    """(class, bin, bin_start, bin_end, count, density); one series without labels."""
    lo, hi, n = _range(scored, score)
    if not n:
        schema = "class string, bin int, bin_start double, bin_end double, count bigint, density double"
        return scored.sparkSession.createDataFrame([], schema)
    series = F.when(F.col("is_malicious"), "Malicious").otherwise("Benign") if labelled else F.lit("All rows")
    counts = _binned(scored.withColumn("class", series), score, lo, hi, bins, ["class"])
    classes = ["Benign", "Malicious"] if labelled else ["All rows"]
    grid = _bins_table(scored, lo, hi, bins).withColumn("class", F.explode(F.array(*[F.lit(c) for c in classes])))
    # one row per class and bin: a fixed, small table
    joined = grid.join(counts, ["class", "bin"], "left").withColumn("count", F.coalesce("n", F.lit(0)).cast("bigint"))
    totals = counts.groupBy("class").agg(F.sum("n").alias("_rows"))
    return joined.join(F.broadcast(totals), "class", "left").select(
        "class",
        "bin",
        "bin_start",
        "bin_end",
        "count",
        F.coalesce(F.col("count") / (F.col("_rows") * F.lit((hi - lo) / bins)), F.lit(0.0)).alias("density"),
    )
