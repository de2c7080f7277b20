"""Verification of written copies and schema checks.

``verify_table`` reads one copy and counts it (one Spark job); a failure is
captured into the result, never raised.  Results are small records (one
per copy) and become a DataFrame with an explicit schema.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.sources.readers import read_table
from ledgerflow.sources.sinks import Target, error_text

VERIFY_SCHEMA = ("table string, format string, path string, is_table boolean, status string, "
                 "row_count bigint, error string, duration_sec double")
SCHEMA_DIFF_SCHEMA = "copy string, column string, expected_type string, actual_type string, issue string"
log = logging.getLogger("ledgerflow.verify")


def verify_table(spark: SparkSession, target: Target, table: str | None = None, preview: int = 0) -> dict:
    """Read ``target`` back, count it (and optionally show ``preview``
    rows); returns ``table, format, path, is_table, status, row_count |
    error, duration_sec``."""
    start = time.time()
    res = {"table": table, "format": target.fmt, "path": target.path, "is_table": target.is_table}
    log.info("Verifying %s from: %s", target.fmt.upper(), target.path)
    try:
        df = read_table(spark, target.fmt, target.path, catalog_warehouse=target.warehouse)
        if preview:
            df.show(preview)
        res.update(status="success", row_count=int(df.count()))
    except Exception as e:  # noqa: BLE001 - the result row carries the failure
        res.update(status="failed", error=error_text(e))
    res["duration_sec"] = round(time.time() - start, 2)
    return res


def verify_all(spark: SparkSession, targets: Iterable[tuple[str | None, Target]]) -> DataFrame:
    """Verify every ``(table, target)``; one row per copy."""
    rows = [verify_table(spark, t, table) for table, t in targets]
    return results_frame(spark, rows)


def results_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = [c.split()[0] for c in VERIFY_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], VERIFY_SCHEMA)


def verify_doc(rows: list[dict]) -> list[dict]:
    """The verify document: result records without empty fields."""
    return [{k: v for k, v in r.items() if v is not None} for r in rows]


def step_record(step: str, start: float, end: float, counts: dict[str, int]) -> dict:
    """Step metadata ``{step, start_time, end_time, duration_sec, records}``."""
    return {"step": step, "start_time": start, "end_time": end, "duration_sec": round(end - start, 2),
            "records": dict(counts)}


def schema_check(spark: SparkSession, copies: dict[str, DataFrame], reference: str) -> DataFrame:
    """Differences between the schema of each copy and ``copies[reference]``:
    missing / extra columns and type changes (one row each)."""
    ref = {f.name: f.dataType.simpleString() for f in copies[reference].schema.fields}
    rows = []
    for name, df in copies.items():
        if name == reference:
            continue
        got = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        for c, t in ref.items():
            if c not in got:
                rows.append((name, c, t, None, "missing"))
            elif got[c] != t:
                rows.append((name, c, t, got[c], "type"))
        for c, t in got.items():
            if c not in ref:
                rows.append((name, c, None, t, "extra"))
    return spark.createDataFrame(rows, SCHEMA_DIFF_SCHEMA)
