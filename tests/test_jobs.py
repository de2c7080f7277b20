import json

from ledgerflow.plans import jobs
from ledgerflow.plans.session import shuffle_partitions_for
from ledgerflow.sources import fixtures as fx

SMOKE = "/root/testdata/sf0.001"


def test_step_jobs_on_csv_inputs(spark, tmp_path, capsys):
    fx.dirty_customer(fx.load(spark, SMOKE, "customer")).drop("copy").write.option("header", True) \
        .csv(str(tmp_path / "customer"))
    fx.dirty_payment(fx.load(spark, SMOKE, "orders")).drop("ord").write.option("header", True) \
        .csv(str(tmp_path / "payment"))
    base = str(tmp_path / "out")
    args = ["--base", base]
    assert jobs.main(["ingest", *args, "--customer", str(tmp_path / "customer"),
                      "--payment", str(tmp_path / "payment")], spark=spark) == 0
    ingest = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["result"]
    assert ingest["records"]["customer"] > 0
    assert jobs.main(["transform", *args, "--formats", "csv,parquet"], spark=spark) == 0
    assert jobs.main(["verify", *args, "--formats", "csv,parquet"], spark=spark) == 0
    assert jobs.main(["verify", *args, "--formats", "csv,nosuch"], spark=spark) == 1  # a failed copy fails the job
    assert jobs.main(["load", *args], spark=spark) == 0
    assert jobs.main(["metadata", *args, "--run-date", "2026-01-01"], spark=spark) == 0
    assert jobs.main(["alert", *args], spark=spark) == 0
    assert spark.read.parquet(f"{base}/warehouse/pipeline_runs").count() > 0
    whole = ["all", "--customer", str(tmp_path / "customer"), "--payment", str(tmp_path / "payment"), "--base"]
    assert jobs.main([*whole, f"{base}2", "--formats", "csv,nosuch"], spark=spark) == 1
    assert jobs.main([*whole, f"{base}3", "--formats", "csv,parquet"], spark=spark) == 0


def test_shuffle_partitions_scale_with_input():
    assert shuffle_partitions_for(10 * 1024 ** 2, 8) == 16
    assert shuffle_partitions_for(100 * 1024 ** 4, 8000) == 409600
