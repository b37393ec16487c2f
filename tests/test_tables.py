import pytest
from pyspark.sql import functions as F

from residua.operators import labels, profile
from residua.roles import Roles, coerce_numeric, safe_name, sanitise_columns
from residua.sources import conn_log, sinks, tables

HEADER = "#separator \\x09\n#fields\tts\tuid\tid.orig_h\ttunnel_parents   label   detailed-label\n"
ROLES = Roles(key="record_index")


def write(path, text, mode="w", **kw):
    with open(path, mode, **kw) as f:
        f.write(text)
    return str(path)


def test_log_with_merged_tail_comments_and_blank_lines(spark, tmp_path):
    path = write(tmp_path / "a.log", HEADER + "1\tu1\th1\t-   Malicious   C&C\n\n#close\n2\tu2\th2\t-   Benign   -\n")
    df = conn_log.read_conn_log(spark, path)
    assert df.columns == ["ts", "uid", "id_orig_h", "tunnel_parents", "label", "detailed_label"]
    assert sorted(map(tuple, df.collect())) == [
        ("1", "u1", "h1", "-", "Malicious", "C&C"),
        ("2", "u2", "h2", "-", "Benign", "-"),
    ]


def test_last_cell_with_other_part_counts_is_left_alone(spark):
    df = spark.createDataFrame([("a\tb   c",), ("a\tb",), ("a\tb  c  d  e",), ("a  b  c",), ("x\ta  b  c",)], "v string")
    got = [r[0] for r in df.select(conn_log.row_tokens(F.col("v"))).collect()]
    assert got == [["a", "b   c"], ["a", "b"], ["a", "b  c  d  e"], ["a  b  c"], ["x", "a", "b", "c"]]


def test_empty_header_names_are_dropped(spark):
    df = spark.createDataFrame([("#fields\ta\t\tb\t c \r\n",), ("#fieldsX\ta",)], "v string")
    assert [r[0] for r in df.select(conn_log.column_names(F.col("v"))).collect()] == [["a", "b", "c"], None]


def test_last_header_of_a_file_wins(spark, tmp_path):
    path = write(tmp_path / "a.log", "#fields\tx\ty\n1\t2\n#fields\tlabel\tdetailed-label\n")
    df = conn_log.read_conn_log(spark, path)
    assert df.columns == ["label", "detailed_label"]
    assert [tuple(r) for r in df.collect()] == [("1", "2")]


def test_files_with_different_headers_are_read_by_name(spark, tmp_path):
    write(tmp_path / "a.log", "#fields\tlabel\tdetailed-label\tx\nBenign\t-\t1\n")
    write(tmp_path / "b.log", "#fields\tx\tlabel\tdetailed-label\n2\tMalicious\tscan\n")
    rows = conn_log.read_conn_log(spark, str(tmp_path)).select("label", "detailed_label", "x").collect()
    assert sorted(map(tuple, rows)) == [("Benign", "-", "1"), ("Malicious", "scan", "2")]


@pytest.mark.parametrize("mode,rows", [("PERMISSIVE", 2), ("DROPMALFORMED", 1)])
def test_wrong_arity(spark, tmp_path, mode, rows):
    path = write(tmp_path / "a.log", HEADER + "1\tu1\th1\t-   Malicious   C&C\n1\tu1\n")
    df = conn_log.read_conn_log(spark, path, mode=mode)
    assert df.count() == rows
    if mode == "PERMISSIVE":
        assert [r[0] for r in df.filter("_corrupt_record is not null").select("_corrupt_record").collect()] == ["1\tu1"]
    with pytest.raises(Exception, match="2 fields after parsing, expected 6"):
        conn_log.read_conn_log(spark, path).collect()


def test_data_before_the_header_and_missing_header(spark, tmp_path):
    early = write(tmp_path / "a.log", "1\t2\n#fields\tlabel\tdetailed-label\n")
    with pytest.raises(Exception, match="before a '#fields' line"):
        conn_log.read_conn_log(spark, early).collect()
    none = write(tmp_path / "b.log", "1\t2\n")
    with pytest.raises(ValueError, match="no '#fields' line"):
        conn_log.read_conn_log(spark, none)
    # a file of its own without a header does not borrow another file's
    write(tmp_path / "c.log", HEADER + "1\tu1\th1\t-   Malicious   C&C\n")
    with pytest.raises(Exception, match="before a '#fields' line"):
        conn_log.read_conn_log(spark, [none, str(tmp_path / "c.log")]).collect()


def test_header_only_labels_and_bytes(spark, tmp_path):
    assert conn_log.read_conn_log(spark, write(tmp_path / "a.log", HEADER)).count() == 0
    with pytest.raises(ValueError, match="missing"):
        conn_log.read_conn_log(spark, write(tmp_path / "b.log", "#fields\tx\n1\n"))
    assert conn_log.read_conn_log(spark, str(tmp_path / "b.log"), require_labels=False).columns == ["x"]
    raw = b"#fields\tx\ty\nbad\xff\tok\n"
    path = write(tmp_path / "c.log", raw, "wb")
    assert conn_log.read_conn_log(spark, path, require_labels=False).first()["x"] == "bad\ufffd"


def test_csv_types_tokens_and_errors(spark, tmp_path):
    path = write(tmp_path / "t.csv", "i,d,s,b,n,mixed\n1,1.5,x,true,NA,1\n2,NaN,y,False,null,-\n,2e3,N/A,TRUE,,3\n")
    df = tables.read_table(spark, path)
    assert df.dtypes == [
        ("i", "bigint"), ("d", "double"), ("s", "string"), ("b", "boolean"), ("n", "double"), ("mixed", "string"),
    ]
    assert df.filter("i is null").first()["d"] == 2000.0
    assert profile.total_missing_cells(df).first()[0] == 1 + 1 + 1 + 3
    assert coerce_numeric(df, ["mixed"]).dtypes[-1] == ("mixed", "double")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(tables.TableError, match="empty"):
        tables.read_table(spark, write(tmp_path / "e.csv", ""))


def test_names_and_roles(spark):
    df = sanitise_columns(spark.createDataFrame([(1, "u", "h", "tcp", 2.0, "Benign", "-")], ["ts", "uid", "id.orig_h", "proto", "x", "label", "detailed-label"]))
    roles = Roles().resolve(df)
    assert safe_name("id.orig_h") == "id_orig_h"
    assert roles.numeric == ("ts", "x") and roles.categorical == ("proto",)
    assert labels.drop_identifiers(df, roles).columns == ["ts", "proto", "x", "label", "detailed_label"]
    with pytest.raises(ValueError, match="detailed_label"):
        labels.split_features_labels(df.drop("detailed_label"), roles)


def test_quality_and_label_summaries(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 4.0), (None, 5.0)], "a double, b double")
    assert tuple(profile.quality_summary(df).first()) == (3, 2, 0, 1, 1)
    assert tuple(profile.label_quality_summary(df).first()) == (None, None, None)
    named = spark.createDataFrame([("Benign",), ("benign",), ("Malicious",)], "label string")
    assert tuple(profile.label_quality_summary(named).first()) == (2, 2, 1)
    odd = spark.createDataFrame([(float("inf"), 1), (float("nan"), None), (float("inf"), 1)], "x double, y int")
    assert tuple(profile.quality_summary(odd).first()) == (3, 2, 1, 2, 4)
    assert profile.quality_summary(df.limit(0)).first()["rows"] == 0


def test_missing_audit_duplicates_and_schema(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0)], "a double, b double")
    assert profile.total_missing_cells(df).first()[0] == 2
    assert [tuple(r) for r in profile.missing_values_audit(df).collect()] == [("a", 1, 50.0), ("b", 1, 50.0)]
    assert profile.missing_values_audit(df.fillna(0.0)).count() == 0
    x = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "x int")
    assert profile.duplicate_row_count(x).first()[0] == 2
    assert profile.duplicate_key_count(x, "x").first()[0] == 2
    assert [tuple(r) for r in profile.schema_overview(x).collect()] == [("x", "int")]


def test_report_files(spark, tmp_path):
    report = spark.createDataFrame([("test", float("nan"), float("inf"), 0.5, None)], "split string, precision double, recall double, f1_score double, pr_auc double")
    assert sinks.report_json(report).first()[0] == '{"split":"test","precision":null,"recall":null,"f1_score":0.5,"pr_auc":null}'
    sinks.write_metrics(report, str(tmp_path / "m"), "json")
    back = sinks.read_metrics_json(spark, str(tmp_path / "m")).first()
    assert back["f1_score"] == 0.5 and back["precision"] is None
    assert sinks.read_metrics_json(spark, str(tmp_path / "absent")).count() == 0
    sinks.write_metrics(report, str(tmp_path / "c"), "csv")
    text = next((tmp_path / "c").glob("part-*")).read_text()
    assert text == "split,precision,recall,f1_score,pr_auc\ntest,,,0.5,\n"
    assert [tuple(r) for r in sinks.baseline_table(sinks.read_metrics_json(spark, str(tmp_path / "m"))).collect()] == [("f1_score", 0.5)]
    with pytest.raises(ValueError):
        sinks.write_metrics(report, str(tmp_path / "x"), "xml")


def test_file_stub():
    assert sinks.file_stub(" My Upload (v2).CSV ") == "my_upload_v2_csv"
    assert sinks.file_stub("—") == "metrics"
    assert len(sinks.file_stub("x" * 99)) == 48


def test_fingerprint_names_content(spark, tmp_path):
    import hashlib

    path = write(tmp_path / "f.bin", "abc")
    assert tables.dataset_fingerprint(spark, path).first()["sha256"] == hashlib.sha256(b"abc").hexdigest()
