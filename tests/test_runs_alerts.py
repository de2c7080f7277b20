import json
import os

from pyspark.sql import functions as F

from ledgerflow.operators import alerts, runs
from ledgerflow.sources.readers import read_run_docs


def docs(spark, items):
    return spark.createDataFrame([(p, i, v) for i, (p, v) in enumerate(items)], "path string, doc_seq bigint, value string")


def test_flatten_shapes_defaults_and_drops(spark):
    d = docs(spark, [
        ("m/ingest", json.dumps({"step": "ingest", "start_time": 1.5, "end_time": 3, "duration_sec": 1,
                                 "records": {"customer": 7, "payment": 8}})),
        ("m/verify", json.dumps([{"format": "csv", "path": "", "is_table": True, "status": "success", "row_count": 5},
                                 42, {"step": "load", "path": "w/x", "status": "failed", "error": "boom"},
                                 {"step": None, "format": "orc"}])),
        ("m/bad", '{"step": "tra'),
        ("m/scalar", '"text"'),
        ("m/rec", json.dumps({"step": "transform", "records": "n/a"})),
    ])
    out = runs.flatten_runs(d, run_date="2024-01-01").collect()
    assert len(out) == 5
    by = {(r.step, r.format): r for r in out}
    ing = by[("ingest", None)]
    assert (ing.customer_records, ing.payment_records, ing.end_time, ing.path) == (7, 8, 3.0, "m/ingest")
    csv = by[("verify", "csv")]
    assert (csv.path, csv.is_table, csv.row_count) == ("m/verify", "true", 5)
    assert by[("load", None)].path == "w/x" and by[("load", None)].error == "boom"
    assert (None, "orc") in by  # an explicit null step stays null
    assert by[("transform", None)].customer_records is None


def test_flatten_compact_layout(spark):
    d = docs(spark, [("p", json.dumps({"step": "ingest", "start_time": 1, "records": {"customer": 1}})),
                     ("p", json.dumps({"step": "x", "records": {}})),
                     ("q", json.dumps([{"format": "csv", "step": "load", "path": "", "row_count": 3}, "s"]))])
    out = runs.flatten_runs_compact(d).collect()
    assert len(out) == 3
    rec = {r.step: r for r in out}
    assert rec["ingest"].records == '{"customer":1}' and rec["x"].records is None
    assert rec["verify"].path == "" and rec["verify"].row_count == 3 and rec["verify"].start_time is None


def test_read_run_docs_skips_missing_and_empty(spark, tmp_path):
    good = tmp_path / "verify_metadata.json"
    spark.createDataFrame([(json.dumps([{"format": "csv", "status": "success"}]),)], "value string") \
        .coalesce(1).write.text(str(good))
    empty = tmp_path / "empty"
    os.makedirs(empty)
    (empty / "part-00000.txt").write_text("")
    df, missing = read_run_docs(spark, [str(good), str(empty), str(tmp_path / "nope")])
    assert missing == [str(tmp_path / "nope")]
    rows = df.collect()
    assert len(rows) == 1 and rows[0].path.endswith("verify_metadata.json")
    flat = runs.flatten_runs(df, "2024-01-01").first()
    assert flat.path.endswith("verify_metadata.json")  # fallback to the written folder


def test_alert_rules_defaults(spark):
    res = spark.createDataFrame([
        ("csv", "success", 10.0, 500), ("orc", "success", 301.0, 500), ("json", "success", None, 99),
        ("delta", "failed", 0.5, None), ("hudi", None, 1.0, 200), ("ok", "success", None, None)],
        "format string, status string, duration_sec double, row_count bigint")
    lines = [r.alert for r in alerts.evaluate_alerts(res).collect()]
    assert lines == ["Format orc: status=success, duration=301s, row_count=500",
                     "Format json: status=success, duration=0s, row_count=99",
                     "Format delta: status=failed, duration=0.5s, row_count=1",
                     "Format hudi: status=null, duration=1s, row_count=200",
                     "Format ok: status=success, duration=0s, row_count=1"]


def test_alert_summary_and_notification(spark):
    empty = spark.createDataFrame([], "format string, status string, duration_sec double, row_count bigint")
    found = alerts.evaluate_alerts(empty)
    assert [r.line for r in alerts.alert_summary(found).collect()] == ["NO_ALERT"]
    note = alerts.notification_text(found).collect()
    assert len(note) == 1 and note[0].line.endswith("is in order")
    some = alerts.evaluate_alerts(spark.createDataFrame([("csv", "failed", 1.0, 5)],
                                                        "format string, status string, duration_sec double, row_count bigint"))
    assert [r.line for r in alerts.alert_summary(some).collect()] == ["Format csv: status=failed, duration=1s, row_count=5"]
    parts = sorted((r.part, r.line) for r in alerts.notification_text(some).collect())
    assert parts[0][1].startswith("ledgerflow:") and parts[1][1].startswith("Format csv")
    assert alerts.alert_status(some).first().n_alerts == 1


def test_step_metrics_status_and_line(spark):
    r = spark.createDataFrame([("ingest", 0.0, 301.7, 301.7), ("load", 10.0, None, None)],
                              "step string, start_time double, end_time double, duration_sec double")
    out = {x.task: x for x in alerts.step_metrics(r).collect()}
    assert out["ingest"].status == "warning" and out["ingest"].duration == 301
    assert out["ingest"].ts == "1970-01-01T00:05:01.700000"
    assert out["load"].status == "success" and out["load"].line.endswith(",load,None,success")


def test_row_drop_check(spark):
    r = spark.createDataFrame([("d", "ingest", 100, 50), ("d", "transform", 80, 50)],
                              "run_date string, step string, customer_records bigint, payment_records bigint")
    out = {x.table: x for x in runs.row_drop_check(r, 0.1).collect()}
    assert out["customer"].flagged and abs(out["customer"].drop_ratio - 0.2) < 1e-12
    assert not out["payment"].flagged


def test_total_loss_is_flagged(spark):
    r = spark.createDataFrame([("d", "ingest", 100, 50), ("e", "transform", 9, 9)],
                              "run_date string, step string, customer_records bigint, payment_records bigint")
    out = {(x.run_date, x.table): x for x in runs.row_drop_check(r, 0.1).collect()}
    assert out["d", "customer"].flagged and out["d", "customer"].drop_ratio == 1.0 and out["d", "customer"].records_after == 0
    assert not out["e", "customer"].flagged and out["e", "customer"].drop_ratio is None


def test_daily_status_keeps_every_status(spark):
    r = spark.createDataFrame([("d", "success"), ("d", "warning"), ("d", None), ("d", None)], "run_date string, status string")
    assert {x.status: x.n_results for x in runs.daily_status(r).collect()} == {"success": 1, "warning": 1, None: 2}


def test_huge_durations_do_not_raise_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    r = spark.createDataFrame([("ingest", 0.0, 1e30, 1e30)],
                              "step string, start_time double, end_time double, duration_sec double")
    out = alerts.step_metrics(r).first()
    assert out.duration is None and out.ts is None and out.status == "warning"
    assert runs.duration_by_step(r.withColumn("run_date", F.lit("d"))).first().avg_duration_sec is None


def test_step_metric_log_appends_lines(spark, tmp_path):
    from ledgerflow.sources.sinks import append_step_metric

    r = spark.createDataFrame([("ingest", 0.0, 12.5, 12.5)],
                              "step string, start_time double, end_time double, duration_sec double")
    metrics = alerts.step_metrics(r)
    for _ in range(2):
        append_step_metric(metrics, str(tmp_path / "log"))
    lines = sorted(x.value for x in spark.read.text(str(tmp_path / "log")).collect())
    assert lines == ["1970-01-01T00:00:12.500000,ingest,12,success"] * 2


def test_clean_alert_text(spark):
    df = spark.createDataFrame([("  NO_ALERT \n",), (" Format csv: status=failed ",)], "line string")
    assert [r.t for r in df.select(alerts.clean_alert_text().alias("t")).collect()] == [
        None, "Format csv: status=failed"]
