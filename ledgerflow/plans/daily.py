"""The daily pipeline: ingest -> transform (fan-out) -> verify -> load ->
run metadata -> alerts.

Each step is a function over a base folder (the jobs hand data over
through files, so a step can run as its own job and be retried alone).
Step records and result lists are written as one JSON document per step;
the metadata step flattens them into the run table with Spark.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators import alerts, clean, runs
from ledgerflow.operators.quality import results_frame, step_record, verify_doc, verify_table
from ledgerflow.sources.readers import read_run_docs
from ledgerflow.sources.sinks import Target, fan_out, load_table, replace_partitions, write_alert, write_run_doc
from ledgerflow.specs import VERIFY_FORMATS

TABLES = ("customer", "payment")
MAX_CONCURRENT_JOBS = 8


def run_concurrently(tasks: list, workers: int = MAX_CONCURRENT_JOBS) -> list:
    """Run independent driver-side actions (each submits its own Spark
    jobs) from a thread pool; results keep the task order."""
    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


@dataclass(frozen=True)
class Layout:
    """Folder layout under one base path."""

    base: str

    def staged(self, table: str) -> str:
        return f"{self.base}/temp/{table}_clean"

    def copy(self, fmt: str, table: str) -> Target:
        if fmt == "iceberg":
            return Target("iceberg", f"lake.db.{table}", warehouse=f"{self.base}/iceberg")
        if fmt == "hudi":
            return Target("hudi", f"{self.base}/hudi/{table}", name=f"{table}_hudi")
        return Target(fmt, f"{self.base}/{fmt}/{table}")

    def doc(self, step: str) -> str:
        return f"{self.base}/metadata/{step}_metadata.json"

    def warehouse(self, table: str) -> str:
        return f"{self.base}/warehouse/{table}"

    @property
    def runs_table(self) -> str:
        return f"{self.base}/warehouse/pipeline_runs"

    @property
    def alert(self) -> str:
        return f"{self.base}/metadata/alert.txt"


def _write_counted(df: DataFrame, path: str, name: str) -> int:
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return int(obs.get["n"])


def ingest(spark: SparkSession, customer_raw: DataFrame, payment_raw: DataFrame, layout: Layout,
           customer_order: list[str] | None = None, payment_order: list[str] | None = None,
           scope: str = "raw") -> dict:
    """Clean both tables and stage them as Parquet; counts are observed
    during the writes (no second computation)."""
    start = time.time()
    cust = clean.clean_customer(customer_raw, order_by=customer_order, scope=scope)
    pay = clean.clean_payment(payment_raw, order_by=payment_order, scope=scope)
    n_c, n_p = run_concurrently([lambda: _write_counted(cust, layout.staged("customer"), f"ingest_c_{start}"),
                                 lambda: _write_counted(pay, layout.staged("payment"), f"ingest_p_{start}")])
    counts = {"customer": n_c, "payment": n_p}
    record = step_record("ingest", start, time.time(), counts)
    write_run_doc(spark, record, layout.doc("ingest"))
    return record


def transform(spark: SparkSession, layout: Layout, formats=VERIFY_FORMATS) -> tuple[dict, list[dict]]:
    """Rename to the conformed names and fan each table out to every format
    (the staged Parquet is re-scanned per format: a scan plus a rename is
    cheaper to repeat than to cache)."""
    start = time.time()
    conformed = {"customer": clean.conform_customer(spark.read.parquet(layout.staged("customer"))),
                 "payment": clean.conform_payment(spark.read.parquet(layout.staged("payment")))}
    per_table = run_concurrently([
        (lambda t=table, d=df: fan_out(d, [layout.copy(f, t) for f in formats], table=t, persist=False))
        for table, df in conformed.items()])
    results, counts = [], {}
    for table, res in zip(conformed, per_table):
        results += res
        counts[table] = next((r["row_count"] for r in res if r["status"] == "success"), None)
    record = step_record("transform", start, time.time(), counts)
    write_run_doc(spark, record, layout.doc("transform"))
    return record, results


def verify(spark: SparkSession, layout: Layout, formats=VERIFY_FORMATS, tables=TABLES) -> DataFrame:
    """Read back and count every copy; write the verify document."""
    copies = [(t, layout.copy(f, t)) for t in tables for f in formats]
    rows = run_concurrently([(lambda t=t, c=c: verify_table(spark, c, t)) for t, c in copies])
    results = results_frame(spark, rows)  # one row per copy (bounded)
    write_run_doc(spark, verify_doc(rows), layout.doc("verify"))
    return results


def load(spark: SparkSession, layout: Layout, mode: str = "truncate", fmt: str = "parquet") -> list[dict]:
    """Load the staged tables into the warehouse; write the load document."""
    results = run_concurrently([(lambda t=t: load_table(spark, layout.staged(t), layout.warehouse(f"{t}_clean"),
                                                        mode=mode, fmt=fmt, table=f"{t}_clean")) for t in TABLES])
    write_run_doc(spark, verify_doc(results), layout.doc("load"))
    return results


def collect_metadata(spark: SparkSession, layout: Layout, run_date: str | None = None,
                     steps=("ingest", "transform", "verify", "load")) -> DataFrame:
    """Flatten the step documents into the run table: the rows of the day, in place
    of those that an earlier run of the day has left."""
    run_date = run_date or datetime.now(timezone.utc).strftime("%Y-%m-%d")
    docs, missing = read_run_docs(spark, [layout.doc(s) for s in steps])
    table = runs.flatten_runs(docs, run_date=run_date)
    # partitioned by day: reading one day back prunes the rest of the history
    replace_partitions(table, layout.runs_table, ["run_date"])
    schema = ", ".join(f"{n} {t}" for n, t in runs.RUN_SCHEMA)  # keeps run_date a string, in place
    back = spark.read.schema(schema).parquet(layout.runs_table).filter(F.col("run_date") == run_date)
    return back.select(*[n for n, _ in runs.RUN_SCHEMA])


def check_alerts(spark: SparkSession, layout: Layout) -> DataFrame:
    """Alert rules over the verify document; writes the alert text."""
    docs, _ = read_run_docs(spark, [layout.doc("verify")], probe=False)  # written by the step before
    verify_rows = runs.flatten_runs(docs, run_date="", keep_position=True).filter(F.col("step") == "verify")
    found = alerts.evaluate_alerts(verify_rows)
    summary = alerts.alert_summary(found)
    write_alert(summary, layout.alert)
    return summary


def run_pipeline(spark: SparkSession, customer_raw: DataFrame, payment_raw: DataFrame, base: str,
                 formats=None, customer_order=None, payment_order=None, run_date: str | None = None) -> dict:
    """All steps in order.  Every format of the list is tried; one whose connector
    is absent gives ``failed`` rows and alerts, and the others still run.
    ``ok`` is False if any copy, check or load failed."""
    formats = tuple(formats or VERIFY_FORMATS)
    layout = Layout(base.rstrip("/"))
    out = {"ingest": ingest(spark, customer_raw, payment_raw, layout, customer_order, payment_order)}
    out["transform"], out["fan_out"] = transform(spark, layout, formats)
    out["verify"] = [r.asDict() for r in verify(spark, layout, formats).collect()]
    out["load"] = load(spark, layout)
    out["runs"] = collect_metadata(spark, layout, run_date)
    out["alerts"] = check_alerts(spark, layout)
    out["ok"] = all(r["status"] == "success" for step in ("fan_out", "verify", "load") for r in out[step])
    return out
