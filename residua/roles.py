"""Column roles: which columns are labels, identifiers, numeric or categorical features."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of labelled connection logs.
LABEL_COLUMNS = ("label", "detailed-label")
ID_COLUMNS = ("uid", "id.orig_h", "id.resp_h")
DEFAULT_CATEGORICAL = (
    "proto",
    "service",
    "conn_state",
    "local_orig",
    "local_resp",
    "history",
    "tunnel_parents",
)


def safe_name(name: str) -> str:
    """Dots mean struct access in Spark and dashes need quoting, so both become underscores."""
    return name.replace(".", "_").replace("-", "_")


def sanitise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[safe_name(c) for c in df.columns])


@dataclass(frozen=True)
class Roles:
    """Names the operators bind to; feature lists left as ``None`` are inferred from the schema."""

    label: str = "label"
    detail_label: str | None = "detailed_label"
    ids: tuple[str, ...] = tuple(safe_name(c) for c in ID_COLUMNS)
    key: str | None = "record_index"
    numeric: tuple[str, ...] | None = None
    categorical: tuple[str, ...] | None = None

    @property
    def labels(self) -> tuple[str, ...]:
        return (self.label,) if self.detail_label is None else (self.label, self.detail_label)

    @property
    def features(self) -> tuple[str, ...]:
        return (self.numeric or ()) + (self.categorical or ())

    def resolve(self, df: DataFrame) -> Roles:
        """Fill in open feature lists: default categoricals and text are categorical, the rest numeric."""
        if self.numeric is not None and self.categorical is not None:
            return self
        reserved = {*self.labels, *self.ids, self.key, "split", "mse_score", "flagged", "is_malicious"}
        fields = [f for f in df.schema.fields if f.name not in reserved]
        categorical = tuple(
            f.name for f in fields if f.name in DEFAULT_CATEGORICAL or isinstance(f.dataType, T.StringType)
        )
        numeric = tuple(f.name for f in fields if f.name not in categorical)
        return replace(
            self,
            numeric=self.numeric if self.numeric is not None else numeric,
            categorical=self.categorical if self.categorical is not None else categorical,
        )


def numeric_columns(df: DataFrame, within: tuple[str, ...] | None = None) -> list[str]:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return names if within is None else [c for c in within if c in names]


def text_columns(df: DataFrame, within: tuple[str, ...] | None = None, exclude: tuple[str, ...] = ()) -> list[str]:
    """String columns: what a text placeholder can fill; booleans and times are not text."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return [c for c in (names if within is None else within) if c in names and c not in exclude]


def coerce_numeric(df: DataFrame, columns: list[str], unset_tokens: tuple[str, ...] = ("-",)) -> DataFrame:
    """Opt-in: unset tokens become null and the column becomes numeric instead of a wide one-hot block."""
    return df.withColumns(
        {
            c: F.when(~F.col(f"`{c}`").isin(*unset_tokens), F.expr(f"try_cast(`{c}` as double)"))
            for c in columns
        }
    )
