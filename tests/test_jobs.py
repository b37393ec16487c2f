import numpy as np

from residua.operators.forest import IsolationForest
from residua.plans import jobs
from residua.roles import Roles
from residua.sources.sinks import read_metrics_json, read_scored


def test_from_log_to_reports(spark, tmp_path):
    rng = np.random.default_rng(3)
    for part in range(3):
        lines = ["#separator x", "#fields\tts\tuid\tid.orig_h\tproto\tduration\ttunnel_parents   label   detailed-label"]
        for i in range(200):
            bad = i % 5 == 0
            tail = "-   Malicious   DDoS" if bad else "-   Benign   -"
            value = rng.normal(50 if bad else 1)
            lines.append(f"{part * 200 + i}\tu{i}\th\t{'udp' if i % 2 else 'tcp'}\t{value:.4f}\t{tail}")
        (tmp_path / f"log{part}.log").write_text("\n".join(lines) + "\n")
    jobs.preprocess(spark, str(tmp_path / "log*.log"), str(tmp_path / "table"))
    df = jobs.load_processed(spark, str(tmp_path / "table"))
    assert dict(df.dtypes)["duration"] == "double" and dict(df.dtypes)["ts"] == "bigint"
    assert sorted(r["record_index"] for r in df.collect()) == list(range(600))

    out = str(tmp_path / "out")
    detector = jobs.build_detector(df, Roles(), out, forest=IsolationForest(n_trees=20))
    assert detector.roles.ids == ("uid", "id_orig_h", "id_resp_h") and "uid" not in detector.encoder.features
    report = read_metrics_json(spark, f"{out}/report").first()
    assert report["tp"] + report["fp"] + report["tn"] + report["fn"] == 90 and report["recall"] > 0.95
    assert read_metrics_json(spark, f"{out}/sweep").count() == 7
    assert read_scored(spark, f"{out}/scored").filter("flagged").count() == report["tp"] + report["fp"]

    again = str(tmp_path / "again")
    jobs.evaluate_saved(df, f"{out}/detector", again)
    second = read_metrics_json(spark, f"{again}/report").first()
    assert all(second[c] == report[c] for c in ("tp", "fp", "tn", "fn"))
