"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.sources.scratch import scratch_path

HELD_OUT_REMAINDER = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_recorders: list[list[str]] = []


@contextmanager
def recording(paths: list[str]) -> Iterator[None]:
    """Note in ``paths`` every scratch table that is staged meanwhile."""
    _recorders.append(paths)
    try:
        yield
    finally:
        _recorders.remove(paths)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove scratch tables whose readers are done."""
    while paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.pop())
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_given_back(spark: SparkSession) -> Iterator[None]:
    """Meanwhile the shuffle files of a query go when it ends, not when the driver
    happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def staged(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once into the shared scratch folder and read it back: a
    result that several passes use, and that outlives a lost executor."""
    path = scratch_path(df.sparkSession, name)
    for paths in _recorders:
        paths.append(path)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """The fold that no model learns from: crc32 of the id as text, modulo 4, is 2.
    A null id counts as held out."""
    fold = F.crc32(F.col(column).cast("string")) % 4
    return F.coalesce(fold == HELD_OUT_REMAINDER, F.lit(True))
