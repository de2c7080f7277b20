"""Writers: one table to many formats, run documents, warehouse loads,
metric and alert text, model artifacts and training-run logs.

``fan_out`` counts rows with an ``Observation`` during the first write
(no separate count job) and, for an expensive lineage, persists the source
so it runs once for all copies (the reference re-ran it per sink and again
per count).
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerflow.sources.readers import UnknownFormat, configure_iceberg_catalog, doc_frame


@dataclass
class Target:
    """One copy to write: ``fmt`` and a path (or ``catalog.db.table`` for
    Iceberg / warehouse tables)."""

    fmt: str
    path: str
    name: str | None = None  # Hudi table name
    key: str = "id"  # Hudi record key
    precombine: str = "id"  # Hudi precombine field
    warehouse: str | None = None  # Iceberg hadoop-catalog root
    options: dict[str, str] = field(default_factory=dict)

    @property
    def is_table(self) -> bool:
        return self.fmt == "iceberg"


def hudi_options(name: str, key: str = "id", precombine: str = "id", operation: str = "insert") -> dict[str, str]:
    # Hudi writer option names.
    return {
        "hoodie.table.name": name,
        "hoodie.datasource.write.recordkey.field": key,
        "hoodie.datasource.write.precombine.field": precombine,
        "hoodie.datasource.write.operation": operation,
    }


def write_table(df: DataFrame, target: Target, mode: str = "overwrite", partition_by: Iterable[str] = ()) -> None:
    """Write one copy.  CSV gets a header; Iceberg uses
    ``writeTo(...).createOrReplace()`` (a new snapshot per run)."""
    fmt = target.fmt
    if fmt == "iceberg":
        if target.warehouse:
            configure_iceberg_catalog(df.sparkSession, target.path.split(".")[0], target.warehouse)
        writer = df.writeTo(target.path).using("iceberg")
        for k, v in target.options.items():
            writer = writer.tableProperty(k, v)
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.createOrReplace()
        return
    if fmt not in ("csv", "parquet", "orc", "json", "delta", "hudi"):
        raise UnknownFormat(f"Unknown format: {fmt}")
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if fmt == "hudi":
        w = w.options(**hudi_options(target.name or "table", target.key, target.precombine))
    if target.options:
        w = w.options(**target.options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(target.path)


def fan_out(df: DataFrame, targets: Iterable[Target], table: str | None = None, persist: bool = True) -> list[dict]:
    """Write ``df`` to every target; rows are counted during the first write.

    ``persist=True`` computes an expensive lineage once for all targets;
    pass ``False`` when ``df`` is a plain scan (re-reading is cheaper than
    caching it).  Returns one result per target (``table, format, path,
    status, row_count | error, duration_sec``); a failing target is
    recorded, not raised, and the others still run.
    """
    targets = list(targets)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK) if persist else df
    results, rows = [], None
    try:
        for t in targets:
            start = time.time()
            res = {"table": table, "format": t.fmt, "path": t.path, "is_table": t.is_table}
            try:
                if rows is None:
                    obs = Observation(f"rows_{id(cached)}_{len(results)}")
                    write_table(cached.observe(obs, F.count(F.lit(1)).alias("n")), t)
                    rows = int(obs.get["n"])
                else:
                    write_table(cached, t)
                res.update(status="success", row_count=rows)
            except Exception as e:  # noqa: BLE001 - captured into the result row
                res.update(status="failed", error=error_text(e))
            res["duration_sec"] = round(time.time() - start, 2)
            results.append(res)
    finally:
        if persist:
            cached.unpersist()
    return results


def write_run_doc(spark: SparkSession, obj, path: str) -> None:
    """One JSON document as a text file (folder overwritten)."""
    doc_frame(spark, obj).coalesce(1).write.mode("overwrite").text(path)


def load_table(spark: SparkSession, source: DataFrame | str, target: str, mode: str = "truncate",
               fmt: str = "parquet", table: str | None = None) -> dict:
    """Load a staged table into the warehouse: ``truncate`` replaces it,
    ``append`` adds rows.  ``target`` is a table name (``saveAsTable``) or a
    path.  Returns the result record (failure captured, never raised)."""
    start = time.time()
    path = source if isinstance(source, str) else None
    res = {"step": "load", "table": table or target, "path": path or target}
    try:
        df = spark.read.parquet(source) if isinstance(source, str) else source
        obs = Observation(f"load_{abs(hash((target, start)))}")
        observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
        spark_mode = "overwrite" if mode == "truncate" else "append"
        writer = observed.write.mode(spark_mode).format(fmt)
        if "/" in target or ":" in target:
            writer.save(target)
        else:
            writer.saveAsTable(target)
        res.update(status="success", row_count=int(obs.get["n"]))
    except Exception as e:  # noqa: BLE001
        res.update(status="failed", error=error_text(e))
    res["duration_sec"] = round(time.time() - start, 2)
    return res


def append_rows(df: DataFrame, target: str, fmt: str = "parquet", partition_by: Iterable[str] = ()) -> None:
    """Warehouse append (run table, training-run log); ``partition_by`` lets
    readers of one day prune the others."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target or ":" in target:
        w.save(target)
    else:
        w.saveAsTable(target)


def replace_partitions(df: DataFrame, target: str, partition_by: Iterable[str], fmt: str = "parquet") -> None:
    """Write the partitions that ``df`` holds, each in place of what it held before:
    a load that runs again leaves the same rows.  Other partitions stay."""
    keys = list(partition_by)
    if "/" in target or ":" in target:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt).partitionBy(*keys).save(target)
    elif df.sparkSession.catalog.tableExists(target):
        df.select(*[c for c in df.columns if c not in keys], *keys).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").insertInto(target)
    else:
        df.write.format(fmt).partitionBy(*keys).saveAsTable(target)


def append_step_metric(metrics: DataFrame, path: str) -> None:
    """Append ``ts,task,duration,status`` lines (no header) to a log folder."""
    metrics.select("ts", "task", "duration", "status").write.mode("append").csv(path)


def write_alert(lines: DataFrame, path: str, order_cols: Iterable[str] = ("source_path", "doc_seq", "item_pos")) -> None:
    """The alert document: lines in a global order (range-partitioned sort,
    part files in order), or ``NO_ALERT``."""
    keys = [c for c in order_cols if c in lines.columns]
    lines.orderBy(*[F.col(c).asc_nulls_last() for c in keys]).select("line").write.mode("overwrite").text(path)


def save_model(model, path: str) -> None:
    """Persist a fitted Spark ML model (overwrite)."""
    model.write().overwrite().save(path)


def log_training_run(spark: SparkSession, target: str, run_id: str, run_name: str, params: dict,
                     metrics: dict) -> DataFrame:
    """Append a training run to the run log ``(run_id, run_name, kind, key,
    value, logged_at)``; returns the appended rows."""
    rows = [(run_id, run_name, "param", k, str(v)) for k, v in sorted(params.items())]
    rows += [(run_id, run_name, "metric", k, repr(float(v))) for k, v in sorted(metrics.items())]
    df = spark.createDataFrame(rows, "run_id string, run_name string, kind string, key string, value string")
    df = df.withColumn("logged_at", F.current_timestamp())
    append_rows(df, target)
    return df


def best_training_runs(log: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The run log read back: of each run name, the run with the highest ``metric``
    (of equal ones the first id): ``run_name, run_id, value, n_runs, params``."""
    runs = log.groupBy("run_name", "run_id").agg(
        F.max(F.when((F.col("kind") == "metric") & (F.col("key") == metric), F.col("value").try_cast("double"))).alias("value"),
        F.map_from_entries(F.array_sort(F.collect_set(F.when(F.col("kind") == "param", F.struct("key", "value"))))).alias("params"))
    runs = runs.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    best = F.min_by(F.struct("run_id", "value", "params"), F.struct((-F.col("value")).alias("v"), F.col("run_id")))
    return runs.groupBy("run_name").agg(best.alias("best"), F.count(F.lit(1)).alias("n_runs")).select(
        "run_name", "best.run_id", "best.value", "n_runs", "best.params")


def error_text(e: Exception) -> str:
    """The whole error message (of JVM errors the Java exception's), or the name
    of an error without one."""
    java = getattr(e, "java_exception", None)
    return (str(java.toString()) if java is not None else str(e)).strip() or type(e).__name__
