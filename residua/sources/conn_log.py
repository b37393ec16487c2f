"""Tab-separated logs whose ``#fields`` line names the columns, as one Spark job over any number of files.

The plan is a text scan, one small header table joined by file, and array expressions. No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from residua.functions.columns import strip
from residua.functions.lookup import lookup_join
from residua.functions.materialize import materialize
from residua.roles import safe_name

# Log directives and the labels a labelled log must carry.
FIELDS_DIRECTIVE = "#fields"
COMMENT_MARK = "#"
REQUIRED_LABELS = ("label", "detailed-label")
MERGED_TAIL = r"\s{2,}"
MERGED_TAIL_PARTS = 3

MODES = ("FAILFAST", "PERMISSIVE", "DROPMALFORMED")
CORRUPT = "_corrupt_record"


def expand_merged_tail(tokens: Column) -> Column:
    """A last cell made of exactly three parts, two or more blanks apart, becomes three cells."""
    tail = F.split(strip(F.element_at(tokens, -1)), MERGED_TAIL)
    merged = (F.size(tokens) >= 2) & (F.size(tail) == MERGED_TAIL_PARTS)
    return F.when(merged, F.concat(F.slice(tokens, F.lit(1), F.size(tokens) - 1), tail)).otherwise(tokens)


def split_line(line: Column) -> Column:
    return F.split(F.regexp_replace(line, r"[\r\n]+$", ""), "\t")


def row_tokens(line: Column) -> Column:
    return expand_merged_tail(split_line(line))


def column_names(line: Column) -> Column:
    """Names on a header line: directive removed, empty names dropped, merged tail expanded."""
    parts = split_line(line)
    named = F.filter(F.transform(F.slice(parts, F.lit(2), F.size(parts)), strip), lambda n: n != "")
    return F.when(strip(F.get(parts, F.lit(0))) == FIELDS_DIRECTIVE, expand_merged_tail(named))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, pos, value): ``pos`` orders the lines of one file. Bytes that are not UTF-8 are replaced."""
    scan = spark.read.text(path)
    return scan.select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias(
            "pos"
        ),
        F.make_valid_utf8("value").alias("value"),
    )


def read_conn_log(
    spark: SparkSession, path: str | list[str], mode: str = "FAILFAST", require_labels: bool = True
) -> DataFrame:
    return parse_conn_lines(read_lines(spark, path), mode, require_labels)


def parse_conn_lines(lines: DataFrame, mode: str = "FAILFAST", require_labels: bool = True) -> DataFrame:
    """Flat text table from (file, pos, value) lines; column names have dots and dashes replaced.

    The last header of a file names its columns. FAILFAST raises when the cells of a row of the wrong arity or in
    front of any header are read, PERMISSIVE keeps it in ``_corrupt_record``, DROPMALFORMED leaves it out.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    text = F.col("value")
    headers = (
        lines.filter(text.startswith(FIELDS_DIRECTIVE))
        .groupBy("file")
        .agg(column_names(F.max_by("value", "pos")).alias("names"), F.min("pos").alias("first_header"))
    )
    headers = materialize(headers, "headers")  # one row per file, read by everything below
    layouts = headers.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.coalesce(F.size("names"), F.lit(0)) <= 0).alias("nameless"),
        F.count_if(F.size(F.array_distinct("names")) < F.size("names")).alias("repeating"),
        (F.min("names") == F.max("names")).alias("same"),
    ).first()
    columns = _columns(headers, layouts, require_labels)

    data = lines.filter(~text.startswith(COMMENT_MARK) & (strip(text) != ""))
    joined = lookup_join(data, headers, ["file"], layouts["files"])
    headed = F.coalesce(F.col("pos") > F.col("first_header"), F.lit(False))
    fits = headed & (F.size("tokens") == F.size("names"))
    rows = joined.withColumn("tokens", row_tokens(text))
    if mode == "DROPMALFORMED":
        rows = rows.filter(fits)
    cells = F.when(fits, F.col("tokens"))
    if mode == "FAILFAST":
        # part of the cells, not a filter: a filter would be pushed down and split every line twice
        cells = cells.otherwise(_failure(headed).cast("array<string>"))
    rows = rows.withColumn("cells", cells)
    same_layout = layouts["same"]
    place = lambda i, c: F.lit(i) if same_layout else (F.array_position("names", c) - 1).cast("int")
    picked = [F.get("cells", place(i, c)).alias(safe_name(c)) for i, c in enumerate(columns)]
    if mode == "PERMISSIVE":
        picked.append(F.when(F.col("cells").isNull(), text).alias(CORRUPT))
    return rows.select(*picked)


def _columns(headers: DataFrame, layouts: Row, require_labels: bool) -> list[str]:
    """All column names, each where it first stands in the first file that has it; names are few, headers need not be."""
    if not layouts["files"]:
        raise ValueError("no '#fields' line: column names are unknown")
    if layouts["nameless"]:
        raise ValueError("a '#fields' line names no columns")
    if layouts["repeating"]:
        raise ValueError("a '#fields' line repeats a column name")
    named = headers.select("file", F.posexplode("names").alias("place", "name"))
    first = named.groupBy("name").agg(F.min(F.struct("file", "place")).alias("at"))
    columns = [r["name"] for r in first.orderBy("at").collect()]
    missing = sorted(set(REQUIRED_LABELS) - set(columns))
    if require_labels and missing:
        raise ValueError(f"expected columns {sorted(REQUIRED_LABELS)}; missing {missing}; found {columns}")
    return columns


def _failure(headed: Column) -> Column:
    arity = F.format_string(
        "row has %d fields after parsing, expected %d, in %s: %s",
        F.size("tokens"),
        F.size("names"),
        F.col("file"),
        F.substring("value", 1, 200),
    )
    unheaded = F.format_string("data row before a '#fields' line in %s: %s", F.col("file"), F.substring("value", 1, 200))
    return F.raise_error(F.when(headed, arity).otherwise(unheaded))
