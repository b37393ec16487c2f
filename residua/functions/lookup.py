"""Joining rows to a lookup table: broadcast below a checked size, salted shuffle join above it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
SALTS = 32


def lookup_join(
    rows: DataFrame, table: DataFrame, on: list[str], table_rows: int, salts: int = SALTS, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Left join that survives a hot key.

    ``table_rows`` is the counted size of ``table``, which holds one row per key. Above ``limit`` rows the
    table is repeated once per salt and each row picks its salt from its own content, so a key that
    holds a third of the rows is spread over ``salts`` tasks, and a retried task picks the same salts.
    The optimizer's size estimate knows nothing of the repeats, so the merge join is asked for: it would
    broadcast all of them.
    """
    if table_rows <= limit:
        return rows.join(F.broadcast(table), on, "left")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*_hashable(rows)), F.lit(salts)).cast("int"))
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated.hint("merge"), [*on, "_salt"], "left").drop("_salt")


def _hashable(df: DataFrame) -> list:
    return [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
