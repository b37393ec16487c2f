"""Column expressions used across operators. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters Unicode calls white space.
ASCII_WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
WHITESPACE = ASCII_WHITESPACE + (
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove every kind of leading and trailing white space (plain ``trim`` only removes blanks).

    Pure ASCII text, nearly all of it, is trimmed by the short list.
    """
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.btrim(c, F.lit(ASCII_WHITESPACE))).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def label_text(label: Column | str) -> Column:
    """Stripped label; a missing label reads as the text ``nan``, hence counts as malicious."""
    c = F.col(label) if isinstance(label, str) else label
    return strip(F.coalesce(c.cast("string"), F.lit("nan")))


def is_benign(label: Column | str) -> Column:
    return F.lower(label_text(label)) == "benign"


def is_malicious(label: Column | str) -> Column:
    return F.lower(label_text(label)) != "benign"


def half_even(c: Column, places: int) -> Column:
    """Scale, round half to even, scale back."""
    factor = F.lit(float(10**places))
    return F.rint(c * factor) / factor


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator)


def no_nan(c: Column) -> Column:
    """NaN is a missing value; Spark would rank it above every number. The argument is evaluated once."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def finite_or_null(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def is_infinite(c: Column) -> Column:
    return F.coalesce(F.abs(c) == float("inf"), F.lit(False))


def exceeds(score: Column, threshold: Column) -> Column:
    """Strictly above the threshold; a missing or NaN score is never above it."""
    return F.coalesce(F.nanvl(score, F.lit(float("-inf"))) > threshold, F.lit(False))


def total(columns: list[Column]) -> Column:
    return reduce(add, columns, F.lit(0.0)) if columns else F.lit(0.0)


def count_where(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")
