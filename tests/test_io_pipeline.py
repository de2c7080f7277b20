import json

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.quality import schema_check, verify_table
from ledgerflow.plans.daily import run_pipeline
from ledgerflow.sources import fixtures as fx
from ledgerflow.sources.readers import UnknownFormat, format_available, read_csv, read_table
from ledgerflow.sources.sinks import Target, error_text, fan_out, hudi_options, load_table, write_table
from ledgerflow.plans.session import session_conf

SMOKE = "/root/testdata/sf0.001"


def test_fan_out_counts_once_and_captures_failures(spark, tmp_path):
    df = spark.range(50).select("id", (F.col("id") * 2).alias("v"))
    res = fan_out(df, [Target("parquet", str(tmp_path / "p")), Target("csv", str(tmp_path / "c")),
                       Target("nosuch", str(tmp_path / "x")), Target("orc", str(tmp_path / "o"))], table="t")
    assert [(r["format"], r["status"], r.get("row_count")) for r in res] == [
        ("parquet", "success", 50), ("csv", "success", 50), ("nosuch", "failed", None), ("orc", "success", 50)]
    assert "Unknown format" in res[2]["error"]


def test_csv_reads_text_or_typed(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "a")], "id int, x double, s string")
    write_table(df, Target("csv", str(tmp_path / "c")))
    assert dict(read_table(spark, "csv", str(tmp_path / "c")).dtypes) == {"id": "string", "x": "string", "s": "string"}
    assert read_csv(spark, str(tmp_path / "c"), schema=df.schema).first() == df.first()
    assert dict(read_csv(spark, str(tmp_path / "c"), infer=True).dtypes)["x"] == "double"


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,extra,a\n1,z,2\n")
    got = read_csv(spark, str(tmp_path / "x.csv"), schema="a int, b int").collect()
    assert [tuple(r) for r in got] == [(2, 1)]
    with pytest.raises(ValueError, match="lacks c"):
        read_csv(spark, str(tmp_path / "x.csv"), schema="a int, c int")


def test_error_text_is_whole():
    assert error_text(ValueError("one\n" + "two" * 400)) == "one\n" + "two" * 400 and error_text(KeyError()) == "KeyError"


def test_verify_unknown_and_missing_lakehouse_are_rows(spark, tmp_path):
    bad = verify_table(spark, Target("xml", str(tmp_path)))
    assert bad["status"] == "failed" and "Unknown format" in bad["error"]
    if not format_available(spark, "delta"):
        res = verify_table(spark, Target("delta", str(tmp_path / "d")))
        assert res["status"] == "failed" and res["error"]
    with pytest.raises(UnknownFormat):
        read_table(spark, "xml", "x")


def test_lakehouse_options():
    assert hudi_options("customer_hudi")["hoodie.datasource.write.recordkey.field"] == "id"
    conf = session_conf(("delta", "iceberg"))
    assert "io.delta.sql.DeltaSparkSessionExtension" in conf["spark.sql.extensions"]
    assert conf["spark.serializer"].endswith("KryoSerializer")


def test_load_truncate_and_append(spark, tmp_path):
    src = spark.range(7)
    for mode, want in (("truncate", 7), ("append", 14)):
        tgt = str(tmp_path / mode)
        for _ in range(2):
            res = load_table(spark, src, tgt, mode=mode, table="t")
        assert res["status"] == "success" and res["row_count"] == 7
        assert spark.read.parquet(tgt).count() == want


def test_schema_check(spark):
    a = spark.createDataFrame([(1, 2.0)], "id int, x double")
    b = spark.createDataFrame([("1", "2.0", "z")], "id string, x string, extra string")
    rows = {(r.column, r.issue) for r in schema_check(spark, {"parquet": a, "csv": b}, "parquet").collect()}
    assert rows == {("id", "type"), ("x", "type"), ("extra", "extra")}


def test_pipeline_end_to_end(spark, tmp_path):
    c = fx.dirty_customer(fx.load(spark, SMOKE, "customer"))
    p = fx.dirty_payment(fx.load(spark, SMOKE, "orders"))
    out = run_pipeline(spark, c, p, str(tmp_path / "run"), formats=["csv", "parquet", "orc"],
                       customer_order=["copy"], payment_order=["ord"], run_date="2026-01-01")
    n_c, n_p = out["ingest"]["records"]["customer"], out["ingest"]["records"]["payment"]
    assert out["transform"]["records"] == {"customer": n_c, "payment": n_p}
    assert all(r["status"] == "success" for r in out["verify"])
    assert {r["row_count"] for r in out["verify"] if r["table"] == "customer"} == {n_c}
    assert [c for c, _ in out["runs"].dtypes][:2] == ["run_date", "step"]
    assert dict(out["runs"].dtypes)["run_date"] == "string"
    steps = {r.step for r in out["runs"].collect()}
    assert steps == {"ingest", "transform", "verify", "load"}
    lines = [r.line for r in out["alerts"].collect()]
    # a copy alerts when it has fewer than 100 rows (all succeed here)
    expected = 3 * ((n_c < 100) + (n_p < 100))
    assert len(lines) == max(expected, 1) and all(("row_count=" in x) or x == "NO_ALERT" for x in lines)
    written = spark.read.text(str(tmp_path / "run/metadata/alert.txt")).collect()
    assert len(written) == max(expected, 1)
    doc = json.loads(spark.read.text(str(tmp_path / "run/metadata/ingest_metadata.json")).first().value)
    assert doc["step"] == "ingest" and doc["records"]["customer"] == n_c
