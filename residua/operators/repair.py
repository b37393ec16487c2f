"""Cleaning steps in a fixed order, each usable alone, and the composed ``repair`` with its log.

Order: stale flag, extra columns, infinities, duplicates, missing values (drop rows, or impute), invalid
flag, invalid rows, winsorising. Each step alone is a lazy projection or filter around a few fetched numbers. ``repair`` writes its
result once and counts along the way: what happens to rows on their way into the file is observed while they are written. Only steps
behind the last exchange are observed, whose tasks count once however often they are run; what comes before has a pass of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from residua.functions.columns import finite_or_null, is_infinite, no_nan
from residua.functions.materialize import materialize
from residua.functions.quantiles import exact_quantiles
from residua.functions.repeats import apart
from residua.operators.profile import missing
from residua.roles import Roles, numeric_columns, text_columns

FLAG = "_invalid_row"
PLACEHOLDER = "(missing)"
CLIP_RANGE = (0.01, 0.99)
NUMERIC_FILLS = ("none", "median", "mean", "zero", "drop_rows")


@dataclass(frozen=True)
class RepairSpec:
    required: tuple[str, ...] | None = None
    missing_numeric: str = "none"
    missing_categorical: str = "none"
    drop_duplicates: bool = False
    extra_columns: tuple[str, ...] = ()
    flag_invalid: bool = False
    remove_invalid: bool = False
    winsorize: bool = False
    parity_clip_count: bool = False

    def __post_init__(self) -> None:
        if self.missing_numeric not in NUMERIC_FILLS:
            raise ValueError(f"missing_numeric must be one of {NUMERIC_FILLS}")


def drop_stale_flag(df: DataFrame, flag_invalid: bool) -> DataFrame:
    return df if flag_invalid else df.drop(FLAG)


def optional_columns(df: DataFrame, roles: Roles, required: tuple[str, ...] | None) -> list[str]:
    keep = {*roles.labels, *(required or ())}
    return sorted(c for c in df.columns if c not in keep)


def drop_extra_columns(
    df: DataFrame, extra: tuple[str, ...], roles: Roles, required: tuple[str, ...] | None = None
) -> DataFrame:
    """Drop the chosen columns that are neither labels nor required features."""
    allowed = set(optional_columns(df, roles, required))
    return df.drop(*[c for c in extra if c in allowed])


def inf_to_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Infinite cells become null, and so does NaN, so that later steps know one kind of missing."""
    floats = [c for c in columns if dict(df.dtypes)[c] in ("double", "float")]
    return df.withColumns({c: finite_or_null(F.col(f"`{c}`")) for c in floats}) if floats else df


def infinite_cells(df: DataFrame, columns: list[str]) -> Column:
    floats = [c for c in columns if dict(df.dtypes)[c] in ("double", "float")]
    per_row = sum((is_infinite(F.col(f"`{c}`")).cast("int") for c in floats), F.lit(0))
    return F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint")


def drop_duplicate_rows(df: DataFrame, key: str | None = None) -> DataFrame:
    """Distinct rows; with a record number the first record of each group of equal rows is kept.

    Rows that nothing equals stay where they are, and only the others are shuffled.
    """
    data = [c for c in df.columns if c != key]
    parts = apart(df, data)
    alone, doubtful = parts if parts is not None else (None, df)
    if key is None:
        kept = doubtful.dropDuplicates()
    else:
        kept = doubtful.groupBy(*[F.col(f"`{c}`") for c in data]).agg(F.min(key).alias(key)).select(*[F.col(f"`{c}`") for c in df.columns])
    return kept if alone is None else alone.unionByName(kept)


def drop_rows_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna("any", subset=columns) if columns else df


def fill_values(df: DataFrame, columns: list[str], how: str) -> dict[str, float]:
    """Fill value per column; a column without any value has none."""
    if how == "zero":
        return {c: 0.0 for c in columns}
    values = {c: no_nan(F.col(f"`{c}`").cast("double")) for c in columns}
    if how == "median":
        found = {c: q[0] for c, q in exact_quantiles(df, values, [0.5]).items()}
    else:
        row = df.agg(*[F.avg(v) for v in values.values()]).first()
        found = dict(zip(columns, row, strict=True))
    return {c: v for c, v in found.items() if v is not None}


def impute_numeric(df: DataFrame, columns: list[str], how: str) -> DataFrame:
    if how not in ("median", "mean", "zero") or not columns:
        return df
    return fill_numeric(df, fill_values(df, columns, how))


def fill_numeric(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    if not fills:
        return df
    return df.withColumns(
        {c: F.coalesce(no_nan(F.col(f"`{c}`").cast("double")), F.lit(float(v))) for c, v in fills.items()}
    )


def impute_categorical(df: DataFrame, columns: list[str], placeholder: str = PLACEHOLDER) -> DataFrame:
    return df.fillna(placeholder, subset=columns) if columns else df


def flag_invalid_rows(df: DataFrame, columns: list[str], name: str = FLAG) -> DataFrame:
    """True where any of the numeric cells is missing or infinite."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | missing(df, c) | is_infinite(F.col(f"`{c}`").cast("double"))
    return df.withColumn(name, bad)


def remove_invalid_rows(df: DataFrame, name: str = FLAG) -> DataFrame:
    return df.filter(~F.col(name)).drop(name) if name in df.columns else df


def clip_bounds(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """1 % and 99 % quantiles per column, for columns where they differ."""
    if not columns:
        return {}
    bounds = exact_quantiles(df, {c: F.col(f"`{c}`") for c in columns}, CLIP_RANGE)
    return {c: (lo, hi) for c, (lo, hi) in bounds.items() if lo is not None and lo < hi}


def clip(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Values outside their bounds move to the bound; missing cells stay missing."""
    if not bounds:
        return df
    return df.withColumns({c: _clipped(c, lo, hi) for c, (lo, hi) in bounds.items()})


def _clipped(column: str, lo: float, hi: float) -> Column:
    v = F.col(f"`{column}`").cast("double")
    return F.when(v.isNotNull(), F.greatest(F.least(v, F.lit(hi)), F.lit(lo)))


def winsorize(df: DataFrame, columns: list[str]) -> DataFrame:
    return clip(df, clip_bounds(df, columns))


def repair(df: DataFrame, spec: RepairSpec, roles: Roles) -> tuple[DataFrame, DataFrame]:
    """Repaired table, written, and its one-row log.

    The input is read once to count it and once to repair it; removing duplicates reads it twice more. Statistics read a written table.
    """
    work = drop_stale_flag(df, spec.flag_invalid)
    trimmed = drop_extra_columns(work, spec.extra_columns, roles, spec.required)
    dropped = [c for c in work.columns if c not in trimmed.columns]
    numeric = numeric_columns(trimmed, spec.required)
    first = df.agg(_missing_cells(df, df.columns).alias("missing"), F.count(F.lit(1)).alias("rows"), infinite_cells(trimmed, numeric).alias("infinite")).first()
    counters = {"missing_cells_before": first["missing"], "rows_before": first["rows"], "inf_replaced": first["infinite"]}
    watched = _Watch()
    work = inf_to_missing(trimmed, numeric)

    if spec.drop_duplicates:
        work = watched.rows(drop_duplicate_rows(work, roles.key if roles.key in work.columns else None), "distinct")
    if spec.drop_duplicates or spec.missing_numeric in ("median", "mean") or spec.winsorize:
        work = materialize(work, "distinct")  # read by the statistics passes below, and the last exchange
    if spec.missing_numeric == "drop_rows":
        subset = [c for c in spec.required or work.columns if c in work.columns and c not in roles.labels]
        work = watched.rows(drop_rows_missing(watched.rows(work, "whole"), subset), "complete")
    else:
        if spec.missing_numeric != "none" and numeric:
            fills = fill_values(work, numeric, spec.missing_numeric)
            work = fill_numeric(watched.cells(work, list(fills), "numeric_missing_filled"), fills)
        if spec.missing_categorical == "placeholder":
            texts = text_columns(work, spec.required, exclude=roles.labels)
            work = impute_categorical(watched.cells(work, texts, "categorical_missing_filled"), texts)

    if spec.flag_invalid:
        work = watched.count(flag_invalid_rows(work, numeric), F.count_if(FLAG), "invalid_flagged")
    if spec.remove_invalid and FLAG in work.columns:
        work = watched.rows(remove_invalid_rows(watched.rows(work, "flagged")), "valid")
    if spec.winsorize and numeric:
        bounds = clip_bounds(work, numeric)
        work = clip(watched.count(work, _clip_updates(work, bounds, spec.parity_clip_count), "clip_updates"), bounds)

    work = watched.rows(watched.cells(work, work.columns, "missing_cells_after"), "rows_after")
    work = materialize(work, "repaired")
    seen = watched.seen()
    counters |= {n: seen[n] for n in LOG_COUNTERS if n in seen}
    for name, before, after in (
        ("dupes_removed", counters["rows_before"], seen.get("distinct")),
        ("rows_dropped_missing", seen.get("whole"), seen.get("complete")),
        ("invalid_rows_removed", seen.get("flagged"), seen.get("valid")),
    ):
        if after is not None:
            counters[name] = before - after
    return work, _log_row(df, counters, dropped)


class _Watch:
    """Counters that fill while the rows they were put on are written."""

    def __init__(self) -> None:
        self.observed: dict[str, Observation] = {}

    def count(self, df: DataFrame, value: Column, name: str) -> DataFrame:
        self.observed[name] = Observation(name)
        return df.observe(self.observed[name], value.cast("bigint").alias("n"))

    def rows(self, df: DataFrame, name: str) -> DataFrame:
        return self.count(df, F.count(F.lit(1)), name)

    def cells(self, df: DataFrame, columns: list[str], name: str) -> DataFrame:
        return self.count(df, _missing_cells(df, columns), name)

    def seen(self) -> dict[str, int]:
        return {n: o.get["n"] or 0 for n, o in self.observed.items()}


# Counter names of the repair log.
LOG_COUNTERS = (
    "missing_cells_before",
    "missing_cells_after",
    "rows_before",
    "rows_after",
    "dupes_removed",
    "rows_dropped_missing",
    "numeric_missing_filled",
    "categorical_missing_filled",
    "inf_replaced",
    "invalid_flagged",
    "invalid_rows_removed",
    "clip_updates",
)


def _log_row(df: DataFrame, counters: dict[str, int], dropped: list[str]) -> DataFrame:
    values = [F.lit(counters.get(n, 0)).cast("bigint").alias(n) for n in LOG_COUNTERS]
    names = F.array(*[F.lit(c) for c in dropped]).cast("array<string>")
    return df.sparkSession.range(1).select(*values, names.alias("cols_dropped"))


def _missing_cells(df: DataFrame, columns: list[str]) -> Column:
    per_row = sum((missing(df, c).cast("int") for c in columns), F.lit(0))
    return F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint")


def _clip_updates(df: DataFrame, bounds: dict[str, tuple[float, float]], parity: bool) -> Column:
    """Cells the clip changes; parity counting adds the cells still missing in a column with any change."""
    counted = F.lit(0)
    for c, (lo, hi) in bounds.items():
        v = F.col(f"`{c}`")
        changed = F.count_if((v < lo) | (v > hi))
        if parity:
            changed = changed + F.count_if(missing(df, c))
        counted = counted + changed
    return counted.cast("bigint")


def repair_summary(log: DataFrame) -> DataFrame:
    """(counter, value) in the order of the log: table sizes always, other counters where something happened."""
    always = {"missing_cells_before", "missing_cells_after", "rows_before", "rows_after"}
    values = {**{c: F.col(c) for c in LOG_COUNTERS}, "cols_dropped": F.size("cols_dropped").cast("bigint")}
    lines = F.array(
        *[F.struct(F.lit(i).alias("place"), F.lit(c).alias("counter"), v.alias("value")) for i, (c, v) in enumerate(values.items())]
    )
    listed = log.select(F.inline(lines))
    return listed.filter(F.col("counter").isin(*always) | (F.col("value") > 0)).orderBy("place").drop("place")
