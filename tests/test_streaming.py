import json

from ledgerflow.streaming.run_docs import read_doc_stream, start_alert_stream, start_run_table


def test_text_stream_appends_once_and_resumes(spark, tmp_path):
    src, sink, ckpt = tmp_path / "docs", str(tmp_path / "runs"), str(tmp_path / "ckpt")

    def drop(name, obj):
        spark.createDataFrame([(json.dumps(obj),)], "value string").coalesce(1).write.text(str(src / name))

    drop("a", {"step": "ingest", "duration_sec": 3, "records": {"customer": 1, "payment": 2}})
    q = start_run_table(read_doc_stream(spark, str(src / "*")), sink, ckpt, run_date="2024-01-01")
    q.awaitTermination()
    assert spark.read.parquet(sink).count() == 1
    drop("b", [{"format": "csv", "status": "failed"}, {"format": "orc", "status": "success", "row_count": 500}])
    q = start_run_table(read_doc_stream(spark, str(src / "*")), sink, ckpt, run_date="2024-01-01")
    q.awaitTermination()  # resumes from the checkpoint: only the new file
    rows = spark.read.parquet(sink).collect()
    assert sorted(r.step for r in rows) == ["ingest", "verify", "verify"]
    assert all(r.path.endswith("/b") for r in rows if r.format == "csv")  # path falls back to the folder


def test_alert_stream(spark, tmp_path):
    src = tmp_path / "docs"
    spark.createDataFrame([(json.dumps([{"format": "csv", "status": "failed"},
                                        {"format": "orc", "status": "success", "row_count": 500}]),)],
                          "value string").coalesce(1).write.text(str(src / "v"))
    q = start_alert_stream(read_doc_stream(spark, str(src / "*")), str(tmp_path / "alerts"), str(tmp_path / "ck"))
    q.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "alerts")).collect()
    assert [r.alert for r in rows] == ["Format csv: status=failed, duration=0s, row_count=1"]
    assert rows[0].batch_id == 0
