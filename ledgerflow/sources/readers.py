"""Readers: CSV / Parquet / ORC / JSON scans, lakehouse formats by name,
run-document text scans, and small literal frames for job metadata.

Explicit schemas are the default (an ``inferSchema`` pass reads the data
twice and one bad cell turns a numeric column into text); inference is an
opt-in flag.  Lakehouse formats (Delta, Hudi, Iceberg) are used through
their Spark data sources when their jars are on the class path.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Public entry classes that tell whether a connector is present.
FORMAT_PROBE_CLASSES = {
    "delta": "org.apache.spark.sql.delta.sources.DeltaDataSource",
    "hudi": "org.apache.hudi.DefaultSource",
    "iceberg": "org.apache.iceberg.spark.SparkCatalog",
}
BUILTIN_FORMATS = ("csv", "parquet", "orc", "json", "text")
LAKEHOUSE_FORMATS = ("delta", "hudi", "iceberg")


class UnknownFormat(ValueError):
    """Raised for a format name no reader handles."""


def format_available(spark: SparkSession, fmt: str) -> bool:
    """True when the format can be read/written in this session."""
    if fmt in BUILTIN_FORMATS:
        return True
    cls = FORMAT_PROBE_CLASSES.get(fmt)
    if cls is None:
        return False
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(
            cls, False, spark.sparkContext._jvm.Thread.currentThread().getContextClassLoader())
        return True
    except Exception:  # noqa: BLE001 - py4j wraps ClassNotFoundException
        return False


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
             infer: bool = False, as_strings: bool = False, header: bool = True) -> DataFrame:
    """CSV with a header.  ``schema`` (preferred) types the columns with no
    pass over the data: columns are found by their header names (columns it
    does not name are left out, one that no header has is an error), and every
    file's header is checked.  ``infer=True`` runs Spark's inference pass;
    ``as_strings`` (or neither) keeps every column as text."""
    reader = spark.read.option("header", header)
    if schema is not None and not as_strings:
        if header:
            wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            names = reader.csv(path).columns  # reads the first line
            if not names:
                return spark.createDataFrame([], wanted)
            absent = [f.name for f in wanted if f.name not in names]
            if absent:
                raise ValueError(f"CSV header lacks {', '.join(absent)}")
            types = {f.name: f.dataType for f in wanted}
            present = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
            return reader.option("enforceSchema", False).schema(present).csv(path).select(*wanted.names)
        reader = reader.schema(schema)
    elif infer and not as_strings:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def configure_iceberg_catalog(spark: SparkSession, catalog: str, warehouse: str, kind: str = "hadoop") -> None:
    """Register a Hadoop-type Iceberg catalog ``catalog`` rooted at ``warehouse``."""
    spark.conf.set(f"spark.sql.catalog.{catalog}", "org.apache.iceberg.spark.SparkCatalog")
    spark.conf.set(f"spark.sql.catalog.{catalog}.type", kind)
    spark.conf.set(f"spark.sql.catalog.{catalog}.warehouse", warehouse)


def read_table(spark: SparkSession, fmt: str, path_or_table: str, schema: T.StructType | None = None,
               catalog_warehouse: str | None = None) -> DataFrame:
    """Read one copy by format name.

    ``csv`` reads the header and keeps text columns unless ``schema`` is
    given (as a verifying reader does); ``iceberg`` reads a catalog table
    ``catalog.db.table`` (the catalog is registered when
    ``catalog_warehouse`` is given).  Unknown names raise ``UnknownFormat``.
    """
    if fmt == "csv":
        return read_csv(spark, path_or_table, schema=schema, as_strings=schema is None)
    if fmt in ("parquet", "orc", "json"):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.format(fmt).load(path_or_table)
    if fmt in ("delta", "hudi"):
        return spark.read.format(fmt).load(path_or_table)
    if fmt == "iceberg":
        if catalog_warehouse:
            configure_iceberg_catalog(spark, path_or_table.split(".")[0], catalog_warehouse)
        return spark.read.table(path_or_table)
    raise UnknownFormat(f"Unknown format: {fmt}")


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> tuple[list[str], list[str]]:
    """Split paths (globs allowed) into those that match files and those that
    do not, with a file-system listing on the driver (metadata only)."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    found, missing = [], []
    for p in paths:
        try:
            hp = jvm.org.apache.hadoop.fs.Path(p)
            matches = hp.getFileSystem(hconf).globStatus(hp)
            (found if matches is not None and len(matches) > 0 else missing).append(p)
        except Exception:  # noqa: BLE001 - bad scheme, permission: report and skip
            missing.append(p)
    return found, missing


class SkippedPath(str):
    """A path that was not read, and why."""

    error: str

    def __new__(cls, path: str, error: str) -> "SkippedPath":
        out = super().__new__(cls, path)
        out.error = error
        return out


def _read_error(spark: SparkSession, paths: list[str]) -> str | None:
    """Why the text files under ``paths`` cannot be read to their end, if so."""
    try:
        spark.read.text(paths).agg(F.count(F.lit(1))).collect()
        return None
    except Exception as e:  # noqa: BLE001 - whatever stops the read is the answer
        java = getattr(e, "java_exception", None)
        return (str(java.toString()) if java is not None else str(e)).strip() or type(e).__name__


def readable_files(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[SkippedPath]]:
    """Paths that read to their end, and files that do not.

    One pass tells whether all of them do.  If not, their files are listed, and
    halves that cannot be read are divided until the files are found: a broken
    file costs a few short passes, the others are kept.
    """
    paths = list(paths)
    if not paths or _read_error(spark, paths) is None:
        return paths, []
    listed = spark.read.format("binaryFile").load(paths).select("path").orderBy("path")  # names only, no content
    todo, good, bad = [[r.path for r in listed.collect()]], [], []
    while todo:
        part = todo.pop()
        error = _read_error(spark, part)
        if error is None:
            good += part
        elif len(part) == 1:
            bad.append(SkippedPath(part[0], error))
        else:
            todo += [part[:len(part) // 2], part[len(part) // 2:]]
    return sorted(good), sorted(bad)


def read_run_docs(spark: SparkSession, paths: Iterable[str], probe: bool = True) -> tuple[DataFrame, list[SkippedPath]]:
    """Run documents from text files/folders (globs allowed) as
    ``(path, doc_seq, value)``.  Paths that match nothing, and files that cannot
    be read to their end (``probe``: found by a pass over them), are reported in
    the second return value and skipped; empty files give no row; ``path`` is
    the written folder of a ``part-*`` file (the path the job wrote to)."""
    found, missing = existing_paths(spark, paths)
    skipped = [SkippedPath(p, "no such path") for p in missing]
    if probe:
        found, broken = readable_files(spark, found)
        skipped += broken
    if not found:
        empty = spark.createDataFrame([], "path string, doc_seq bigint, value string")
        return empty, skipped
    df = spark.read.text(found).select(
        F.regexp_replace(F.col("_metadata.file_path"), r"/part-[^/]*$", "").alias("path"),
        F.lit(None).cast("bigint").alias("doc_seq"),
        F.col("value"))
    return df.filter(F.length(F.trim("value")) > 0), skipped


def skipped_frame(spark: SparkSession, skipped: list[SkippedPath]) -> DataFrame:
    """The skipped paths as rows ``(path, error)``."""
    return spark.createDataFrame([(str(p), p.error) for p in skipped], "path string, error string")


def doc_frame(spark: SparkSession, obj) -> DataFrame:
    """A one-row ``value`` table holding ``obj`` as JSON text (job metadata,
    bounded by construction)."""
    return spark.createDataFrame([(json.dumps(obj),)], "value string")


def runs_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Run-table rows with the explicit 13-column schema."""
    from ledgerflow.operators.runs import RUN_SCHEMA

    schema = ", ".join(f"{n} {t}" for n, t in RUN_SCHEMA)
    return spark.createDataFrame([tuple(r.get(n) for n, _ in RUN_SCHEMA) for r in rows], schema)
