"""Finding repeated rows without moving the others.

Rows are told apart by a 64-bit fingerprint first: only fingerprints are grouped over the cluster, some 10 bytes a row whatever a row holds.
Rows whose fingerprint stands once are different from all others; only the rest is compared in full. A bitmap of counters would be
smaller still, but it fills up once there are more rows than bits, and fingerprints do not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Repeated fingerprints that are broadcast; a table with more of them is compared as a whole.
BROADCAST_FINGERPRINTS = 200_000


def apart(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame] | None:
    """Rows that nothing else equals in ``columns``, and the rows that may be repeated; None if these are too many to be told apart.

    Null and NaN equal themselves, as in a grouping. Reads the columns once, now.
    """
    if not columns:
        return None
    fingerprint = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    groups = df.select(fingerprint.alias("_print")).groupBy("_print").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = groups.select("_print").limit(BROADCAST_FINGERPRINTS + 1).toArrow()
    if found.num_rows > BROADCAST_FINGERPRINTS:
        return None
    if not found.num_rows:
        return df, df.filter(F.lit(False))
    named = F.broadcast(df.sparkSession.createDataFrame(found))
    same = fingerprint == F.col("_print")
    return df.join(named, same, "left_anti"), df.join(named, same, "left_semi")
