"""Shared folders for checkpoints and scratch tables.

On a cluster the folder is ``spark.checkpoint.dir`` as the cluster names it
(a shared file system that survives executor loss).  Only when it is unset
and the master is local (tests, benches) is a private folder created.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="ledgerflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return (sc.getCheckpointDir() or path).rstrip("/")


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and cut its
    lineage (never a node-local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, removed when the
    driver ends."""
    base = f"{ensure_checkpoint_dir(spark)}/scratch/{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    system.deleteOnExit(folder)
    return f"{base}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared scratch folder and read it back:
    a result that several passes read, columns pruned, and that outlives a lost
    executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
