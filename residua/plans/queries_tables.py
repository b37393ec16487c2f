"""Queries over raw tables: log parsing, record numbers, labels, profiling and repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions.columns import half_even
from residua.functions.materialize import scratch_path
from residua.operators import labels, profile, repair
from residua.operators.results import feature_preview
from residua.plans import bindings as b
from residua.plans.oracle import EVENTS_BASE, GAPS_BASE, LINEITEM_BASE, even
from residua.plans.registry import query
from residua.roles import coerce_numeric
from residua.sources import conn_log, record_index, sinks, tables

PARSED = """
SELECT CAST(event_id AS VARCHAR) AS ts, 'u' || user_id AS uid, json_extract_string(props, '$.k') AS id_resp_p,
       '-' AS tunnel_parents, CASE WHEN event_type = 'error' THEN 'Malicious' ELSE 'Benign' END AS label,
       event_type AS detailed_label FROM events
"""


@query("parse_conn_log", PARSED)
def parse_conn_log(spark, folder) -> DataFrame:
    return conn_log.parse_conn_lines(b.event_log_lines(spark, folder))


@query(
    "parse_conn_log_bad_rows",
    f"""WITH good AS ({PARSED})
SELECT CASE WHEN detailed_label <> 'click' THEN ts END AS ts, CASE WHEN detailed_label <> 'click' THEN uid END AS uid,
       CASE WHEN detailed_label <> 'click' THEN id_resp_p END AS id_resp_p,
       CASE WHEN detailed_label <> 'click' THEN tunnel_parents END AS tunnel_parents,
       CASE WHEN detailed_label <> 'click' THEN label END AS label,
       CASE WHEN detailed_label <> 'click' THEN detailed_label END AS detailed_label,
       CASE WHEN detailed_label = 'click'
            THEN ts || chr(9) || uid || chr(9) || id_resp_p || chr(9) || '-   ' || label END AS _corrupt_record
FROM good""",
)
def parse_conn_log_bad_rows(spark, folder) -> DataFrame:
    return conn_log.parse_conn_lines(b.event_log_lines(spark, folder, broken="click"), mode="PERMISSIVE")


@query("read_conn_log_files", PARSED.replace("'u' || user_id AS uid", "'u' || user_id || CASE WHEN user_id % 5 = 0 THEN chr(65533) ELSE '' END AS uid"))
def read_conn_log_files(spark, folder) -> DataFrame:
    """The lines written as four log files and read back by the text scan; every fifth user's name has a byte that is not UTF-8."""
    lines = b.event_log_lines(spark, folder)
    name = F.regexp_extract("value", r"^[^\t]*\tu(\d+)\t", 1)
    odd = F.coalesce(name.try_cast("long") % 5 == 0, F.lit(False))
    broken = F.concat(F.regexp_extract("value", r"^[^\t]*\tu\d+", 0), F.unhex(F.lit("FF")).cast("string"), F.regexp_extract("value", r"^[^\t]*\tu\d+(\t.*)$", 1))
    path = b.write_lines(lines.withColumn("value", F.when(odd, broken).otherwise(F.col("value"))))
    return conn_log.read_conn_log(spark, f"{path}/*")


@query("parse_conn_log_drop_bad_rows", f"SELECT * FROM ({PARSED}) WHERE detailed_label <> 'click'")
def parse_conn_log_drop_bad_rows(spark, folder) -> DataFrame:
    return conn_log.parse_conn_lines(b.event_log_lines(spark, folder, broken="click"), mode="DROPMALFORMED")


@query("log_column_names", """
SELECT 'conn-' || f || '.log' AS file, 'ts,uid,id.resp_p,tunnel_parents,label,detailed-label' AS names
FROM (SELECT DISTINCT user_id % 4 AS f FROM events)""")
def log_column_names(spark, folder) -> DataFrame:
    lines = b.event_log_lines(spark, folder).filter(F.col("value").startswith(conn_log.FIELDS_DIRECTIVE))
    return lines.select("file", F.concat_ws(",", conn_log.column_names(F.col("value"))).alias("names"))


@query("read_csv_table", f"""
SELECT event_id, user_id, label, detailed_label, value, CAST(k AS BIGINT) AS k, CAST(hour_of_day AS BIGINT) AS hour_of_day,
       CAST(user_bucket AS BIGINT) AS user_bucket FROM ({EVENTS_BASE})""")
def read_csv_table(spark, folder) -> DataFrame:
    """Events written as CSV with whole numbers and read back with inferred types."""
    whole = {c: F.col(c).cast("bigint") for c in ("k", "hour_of_day")}
    path = scratch_path(spark, "events-csv")
    sinks.write_processed(b.events(spark, folder).withColumns(whole), path, "csv")
    return tables.read_table(spark, path)


@query("record_index_by_key", "SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS record_index FROM events")
def record_index_by_key(spark, folder) -> DataFrame:
    return record_index.index_by_number(b.table(spark, folder, "events").select("event_id"), "event_id")


@query(
    "record_index_by_text_key",
    f"SELECT record_key, row_number() OVER (ORDER BY record_key) - 1 AS record_index FROM ({LINEITEM_BASE})",
)
def record_index_by_text_key(spark, folder) -> DataFrame:
    return record_index.with_record_index(b.lineitem(spark, folder).select("record_key"), ["record_key"])


@query("features_and_labels", f"SELECT * REPLACE (trim(label) AS label) FROM ({GAPS_BASE})")
def features_and_labels(spark, folder) -> DataFrame:
    return labels.split_features_labels(b.lineitem_with_gaps(spark, folder), b.LINEITEM)


@query("drop_identifiers", f"SELECT * EXCLUDE (user_id) FROM ({EVENTS_BASE})")
def drop_identifiers(spark, folder) -> DataFrame:
    return labels.drop_identifiers(b.events(spark, folder), b.EVENTS)


@query("binary_label", f"SELECT record_key, lower(trim(label)) <> 'benign' AS is_malicious FROM ({GAPS_BASE})")
def binary_label(spark, folder) -> DataFrame:
    return labels.with_binary_label(b.lineitem_with_gaps(spark, folder), b.LINEITEM).select("record_key", "is_malicious")


@query("preview", f"SELECT event_id, value, k, hour_of_day, user_bucket FROM ({EVENTS_BASE}) ORDER BY event_id LIMIT 20")
def preview(spark, folder) -> DataFrame:
    return feature_preview(b.events(spark, folder), b.EVENTS)


@query(
    "preview_wide",
    """SELECT vec_id, """
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(40))
    + """, CASE WHEN label = 0 THEN 'Benign' ELSE 'Malicious' END AS label, CAST(label AS VARCHAR) AS detailed_label
FROM embeddings ORDER BY vec_id LIMIT 20""",
)
def preview_wide(spark, folder) -> DataFrame:
    """More columns than a preview shows: the first forty and the labels."""
    return feature_preview(b.embeddings(spark, folder), b.EMBEDDINGS)


# ---- profiling -------------------------------------------------------------------------------------------------


def _gaps(spark, folder) -> DataFrame:
    return b.lineitem_with_gaps(spark, folder).drop("record_key")


DATA = "(SELECT * EXCLUDE (record_key) FROM g)"
COLUMNS = (
    "label", "detailed_label", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "ship_month",
)
NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
MISSING_CELLS = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in COLUMNS)


@query(
    "quality_summary",
    f"""WITH g AS ({GAPS_BASE})
SELECT count(*) AS "rows", {len(COLUMNS)}::BIGINT AS "columns",
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {DATA})) AS duplicate_rows,
       ({" + ".join(f"max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in COLUMNS)})::BIGINT AS columns_with_nulls,
       ({" + ".join(f"count(*) FILTER ({c} IS NULL OR isinf({c}))" for c in NUMBERS)})::BIGINT AS invalid_numeric_cells
FROM g""",
)
def quality_summary(spark, folder) -> DataFrame:
    return profile.quality_summary(_gaps(spark, folder))


@query(
    "label_quality",
    f"""WITH g AS ({GAPS_BASE}) SELECT count(DISTINCT lower(trim(label))) AS unique_labels,
       count(*) FILTER (lower(trim(label)) = 'benign') AS benign_rows,
       count(*) FILTER (lower(trim(label)) <> 'benign') AS non_benign_rows FROM g""",
)
def label_quality(spark, folder) -> DataFrame:
    return profile.label_quality_summary(_gaps(spark, folder))


@query(
    "missing_audit",
    f"""WITH g AS ({GAPS_BASE}), m AS (
{" UNION ALL ".join(f"SELECT '{c}' AS c, count(*) FILTER ({c} IS NULL) AS n, count(*) AS total FROM g" for c in COLUMNS)})
SELECT c AS "column", n AS missing_cells, {even("100.0::DOUBLE * n / total", 2)} AS missing_pct
FROM m WHERE n > 0 ORDER BY n DESC, c LIMIT 25""",
)
def missing_audit(spark, folder) -> DataFrame:
    return profile.missing_values_audit(_gaps(spark, folder))


@query("label_distribution", f'SELECT label, count(*) AS "rows" FROM ({GAPS_BASE}) GROUP BY 1')
def label_distribution(spark, folder) -> DataFrame:
    return profile.label_distribution(_gaps(spark, folder))


@query(
    "top_detail_labels",
    'SELECT event_type AS detailed_label, count(*) AS "rows" FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12',
)
def top_detail_labels(spark, folder) -> DataFrame:
    return profile.top_detail_labels(b.events(spark, folder))


@query("duplicate_keys", "SELECT count(*) - count(DISTINCT l_orderkey) AS duplicate_keys FROM lineitem")
def duplicate_keys(spark, folder) -> DataFrame:
    return profile.duplicate_key_count(b.table(spark, folder, "lineitem"), "l_orderkey")


@query("distinct_labels", f"SELECT DISTINCT trim(label) AS label FROM ({GAPS_BASE})")
def distinct_labels(spark, folder) -> DataFrame:
    return profile.distinct_labels(_gaps(spark, folder))


@query("missing_cells", f"WITH g AS ({GAPS_BASE}) SELECT ({MISSING_CELLS})::BIGINT AS missing_cells FROM g")
def missing_cells(spark, folder) -> DataFrame:
    return profile.total_missing_cells(_gaps(spark, folder))


@query(
    "duplicate_rows",
    f"""WITH g AS ({GAPS_BASE})
SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {DATA})) AS duplicate_rows FROM g""",
)
def duplicate_rows(spark, folder) -> DataFrame:
    return profile.duplicate_row_count(_gaps(spark, folder))


# ---- repair ----------------------------------------------------------------------------------------------------

FINITE = f"""WITH g AS ({GAPS_BASE}),
f AS (SELECT * REPLACE (CASE WHEN isinf(l_quantity) THEN NULL ELSE l_quantity END AS l_quantity) FROM g)"""


def _finite(spark, folder) -> DataFrame:
    return repair.inf_to_missing(b.lineitem_with_gaps(spark, folder), list(NUMBERS))


def _rounded(df: DataFrame, columns=NUMBERS) -> DataFrame:
    return df.select("record_key", *[half_even(F.col(c), 6).alias(c) for c in columns])


def _filled_sql(aggregate: str) -> str:
    filled = ", ".join(f"{even(f'coalesce(f.{c}, s.{c})', 6)} AS {c}" for c in NUMBERS)
    stats = ", ".join(f"{aggregate.format(c)} AS {c}" for c in NUMBERS)
    return f"{FINITE}, s AS MATERIALIZED (SELECT {stats} FROM f) SELECT record_key, {filled} FROM f CROSS JOIN s"


@query("repair_median", _filled_sql("quantile_cont({}, 0.5)"))
def repair_median(spark, folder) -> DataFrame:
    return _rounded(repair.impute_numeric(_finite(spark, folder), list(NUMBERS), "median"))


@query("repair_mean", _filled_sql("avg({})"))
def repair_mean(spark, folder) -> DataFrame:
    return _rounded(repair.impute_numeric(_finite(spark, folder), list(NUMBERS), "mean"))


@query("repair_zero", _filled_sql("0.0 * max({})"))
def repair_zero(spark, folder) -> DataFrame:
    return _rounded(repair.impute_numeric(_finite(spark, folder), list(NUMBERS), "zero"))


@query(
    "repair_drop_rows",
    f"{FINITE} SELECT * FROM f WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL AND l_discount IS NOT NULL "
    "AND l_tax IS NOT NULL",
)
def repair_drop_rows(spark, folder) -> DataFrame:
    return repair.drop_rows_missing(_finite(spark, folder), list(NUMBERS))


@query(
    "repair_placeholder", f"{FINITE} SELECT record_key, coalesce(l_linestatus, '(missing)') AS l_linestatus FROM f"
)
def repair_placeholder(spark, folder) -> DataFrame:
    filled = repair.impute_categorical(_finite(spark, folder), ["l_linestatus", "ship_month"])
    return filled.select("record_key", "l_linestatus")


@query("repair_drop_columns", f"SELECT * EXCLUDE (ship_month) FROM ({GAPS_BASE})")
def repair_drop_columns(spark, folder) -> DataFrame:
    """Labels and required columns stay although they were asked to go."""
    df = b.lineitem_with_gaps(spark, folder)
    return repair.drop_extra_columns(df, ("ship_month", "label", "l_tax"), b.LINEITEM, required=("record_key", *NUMBERS))


@query("repair_dedupe", f"{FINITE} SELECT min(record_key) AS record_key, {', '.join(COLUMNS)} FROM f GROUP BY ALL")
def repair_dedupe(spark, folder) -> DataFrame:
    return repair.drop_duplicate_rows(_finite(spark, folder), key="record_key")


@query("distinct_rows", f"WITH g AS ({GAPS_BASE}) SELECT DISTINCT * FROM {DATA}")
def distinct_rows(spark, folder) -> DataFrame:
    return repair.drop_duplicate_rows(_gaps(spark, folder))


@query("repair_inf", f"{FINITE} SELECT record_key, l_quantity FROM f")
def repair_inf(spark, folder) -> DataFrame:
    return _finite(spark, folder).select("record_key", "l_quantity")


INVALID = " OR ".join(f"{c} IS NULL OR isinf({c})" for c in NUMBERS)


@query("repair_flag_invalid", f"SELECT record_key, ({INVALID}) AS _invalid_row FROM ({GAPS_BASE})")
def repair_flag_invalid(spark, folder) -> DataFrame:
    flagged = repair.flag_invalid_rows(b.lineitem_with_gaps(spark, folder), list(NUMBERS))
    return flagged.select("record_key", repair.FLAG)


@query("repair_remove_invalid", f"SELECT * FROM ({GAPS_BASE}) WHERE NOT ({INVALID})")
def repair_remove_invalid(spark, folder) -> DataFrame:
    flagged = repair.flag_invalid_rows(b.lineitem_with_gaps(spark, folder), list(NUMBERS))
    return repair.remove_invalid_rows(flagged)


def _clipped_sql(source: str, column: str) -> str:
    """Clip to the 1 % and 99 % quantiles unless they coincide."""
    lo = f"(SELECT quantile_cont({column}, 0.01) FROM {source})"
    hi = f"(SELECT quantile_cont({column}, 0.99) FROM {source})"
    return f"CASE WHEN {lo} < {hi} AND {column} IS NOT NULL THEN greatest(least({column}, {hi}), {lo}) ELSE {column} END"


@query(
    "repair_winsorize",
    f"{FINITE} SELECT record_key, {', '.join(f'{even(_clipped_sql("f", c), 6)} AS {c}' for c in NUMBERS)} FROM f",
)
def repair_winsorize(spark, folder) -> DataFrame:
    return _rounded(repair.winsorize(_finite(spark, folder), list(NUMBERS)))


FULL = repair.RepairSpec(
    missing_numeric="median",
    missing_categorical="placeholder",
    drop_duplicates=True,
    extra_columns=("ship_month",),
    flag_invalid=True,
    remove_invalid=True,
    winsorize=True,
)
FULL_COLUMNS = tuple(c for c in COLUMNS if c != "ship_month")
FULL_REPAIR = f"""{FINITE},
d AS (SELECT min(record_key) AS record_key, {", ".join(FULL_COLUMNS)} FROM f GROUP BY ALL),
i AS (SELECT record_key, label, detailed_label,
             {", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM d)) AS {c}" for c in NUMBERS)},
             coalesce(l_linestatus, '(missing)') AS l_linestatus FROM d),
c AS (SELECT record_key, label, detailed_label, l_linestatus,
             {", ".join(f"{_clipped_sql('i', c)} AS {c}" for c in NUMBERS)} FROM i)"""
FULL_LOG = f"""{FULL_REPAIR},
log AS (SELECT (SELECT {MISSING_CELLS} FROM g)::BIGINT AS missing_cells_before, 0::BIGINT AS missing_cells_after,
       (SELECT count(*) FROM g) AS rows_before, (SELECT count(*) FROM c) AS rows_after,
       (SELECT count(*) FROM f) - (SELECT count(*) FROM d) AS dupes_removed, 0::BIGINT AS rows_dropped_missing,
       (SELECT {" + ".join(f"count(*) FILTER ({c} IS NULL)" for c in NUMBERS)} FROM d)::BIGINT AS numeric_missing_filled,
       (SELECT count(*) FILTER (l_linestatus IS NULL) FROM d) AS categorical_missing_filled,
       (SELECT count(*) FILTER (isinf(l_quantity)) FROM g) AS inf_replaced, 0::BIGINT AS invalid_flagged,
       0::BIGINT AS invalid_rows_removed,
       (SELECT {" + ".join(f"count(*) FILTER (i.{c} <> c.{c})" for c in NUMBERS)}
        FROM i JOIN c USING (record_key))::BIGINT AS clip_updates, 'ship_month' AS cols_dropped)"""


@query(
    "repair_table",
    f"{FULL_REPAIR} SELECT record_key, label, detailed_label, l_linestatus, "
    f"{', '.join(f'{even(c, 6)} AS {c}' for c in NUMBERS)} FROM c",
)
def repair_table(spark, folder) -> DataFrame:
    repaired, _ = repair.repair(b.lineitem_with_gaps(spark, folder), FULL, b.LINEITEM)
    return repaired.select(
        "record_key", "label", "detailed_label", "l_linestatus", *[half_even(F.col(c), 6).alias(c) for c in NUMBERS]
    )


@query("repair_log", f"{FULL_LOG} SELECT * FROM log")
def repair_log(spark, folder) -> DataFrame:
    _, log = repair.repair(b.lineitem_with_gaps(spark, folder), FULL, b.LINEITEM)
    return log.withColumn("cols_dropped", F.concat_ws(",", "cols_dropped"))


def _drop_rows_spec() -> repair.RepairSpec:
    return repair.RepairSpec(required=NUMBERS, missing_numeric="drop_rows", missing_categorical="placeholder")


@query(
    "repair_summary",
    f"""{FINITE}, k AS (SELECT * FROM f WHERE {" AND ".join(f"{c} IS NOT NULL" for c in NUMBERS)}),
n AS (SELECT (SELECT count(*) FROM g) AS r0, (SELECT count(*) FROM k) AS r1,
             (SELECT {MISSING_CELLS} FROM g)::BIGINT AS m0, (SELECT {MISSING_CELLS} FROM k)::BIGINT AS m1,
             (SELECT count(*) FILTER (isinf(l_quantity)) FROM g) AS inf)
SELECT counter, value FROM n, LATERAL (VALUES ('missing_cells_before', m0), ('missing_cells_after', m1), ('rows_before', r0),
  ('rows_after', r1), ('rows_dropped_missing', r0 - r1), ('inf_replaced', inf)) v(counter, value)
WHERE value > 0 OR counter IN ('rows_before', 'rows_after', 'missing_cells_before', 'missing_cells_after')""",
)
def repair_summary(spark, folder) -> DataFrame:
    """Dropping rows skips imputation, so the placeholder has nothing to fill."""
    _, log = repair.repair(b.lineitem_with_gaps(spark, folder), _drop_rows_spec(), b.LINEITEM)
    return repair.repair_summary(log)


@query(
    "coerce_unset_numeric",
    "SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS value FROM events",
)
def coerce_unset_numeric(spark, folder) -> DataFrame:
    """A dash for every view event turns the column into text; coercing it gives numbers and nulls again."""
    text = F.when(F.col("detailed_label") == "view", "-").otherwise(F.col("value").cast("string"))
    dashed = b.events(spark, folder).select("event_id", text.alias("value"))
    return coerce_numeric(dashed, ["value"])
