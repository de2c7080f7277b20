"""Session construction (Kryo, AQE, optional lakehouse extensions)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerflow.sources.scratch import ensure_checkpoint_dir

# Session extension / catalog classes of the optional table formats
# (fixed values: public class names of the connectors).
FORMAT_EXTENSIONS = {
    "delta": ("io.delta.sql.DeltaSparkSessionExtension", "org.apache.spark.sql.delta.catalog.DeltaCatalog"),
    "iceberg": ("org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions", None),
    "hudi": ("org.apache.spark.sql.hudi.HoodieSparkSessionExtension", None),
}


ADVISORY_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Initial shuffle partitions for an input volume: about one advisory
    partition (256 MiB) per partition, at least two waves of the cores; AQE
    coalesces small ones and splits skewed ones at run time."""
    return max(2 * cores, -(-input_bytes // ADVISORY_PARTITION_BYTES))


def session_conf(formats: tuple[str, ...] = (), shuffle_partitions: int | None = None) -> dict[str, str]:
    """Configuration the jobs need: Kryo, AQE with skew-join handling and
    partition coalescing, UTC session zone, UI off, plus the extension
    classes of the requested lakehouse formats."""
    conf = {
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ADVISORY_PARTITION_BYTES),
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    exts = [FORMAT_EXTENSIONS[f][0] for f in formats if f in FORMAT_EXTENSIONS]
    if exts:
        conf["spark.sql.extensions"] = ",".join(exts)
    if "delta" in formats:
        conf["spark.sql.catalog.spark_catalog"] = FORMAT_EXTENSIONS["delta"][1]
    return conf


def build_session(master: str | None = None, app_name: str = "ledgerflow", formats: tuple[str, ...] = (),
                  shuffle_partitions: int | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**session_conf(formats, shuffle_partitions), **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark
