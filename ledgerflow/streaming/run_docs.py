"""Incremental ingestion of run documents.

The batch metadata step re-reads every document of the day; as a stream,
each new document file is parsed once: a file source feeds the same
``flatten_runs`` plan, and a Parquet sink with a checkpoint appends the run
rows exactly once (a restarted query resumes from its checkpoint, so a
lost executor or driver does not duplicate or drop rows).
``trigger(availableNow=True)`` processes what has arrived and stops - the
daily-batch cadence of the reference - while a processing-time trigger
keeps it running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.operators import alerts, runs

DOC_SCHEMA = "path string, doc_seq bigint, value string"


def read_doc_stream(spark: SparkSession, source: str, fmt: str = "text",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming ``(path, doc_seq, value)`` frame.

    ``fmt="text"``: one document per line of each new file, ``path`` = the
    folder the file was written to.  ``fmt="json"``: JSON lines that already
    carry ``path``, ``doc_seq``, ``value``.
    """
    reader = spark.readStream.format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "json":
        return reader.schema(DOC_SCHEMA).load(source)
    return reader.load(source).select(
        F.regexp_replace(F.col("_metadata.file_path"), r"/part-[^/]*$", "").alias("path"),
        F.lit(None).cast("bigint").alias("doc_seq"), "value")


def start_run_table(docs: DataFrame, sink: str, checkpoint: str, run_date, available_now: bool = True,
                    processing_time: str | None = None) -> StreamingQuery:
    """Flatten a document stream into the run table (Parquet, append)."""
    flat = runs.flatten_runs(docs, run_date=run_date)
    writer = flat.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "1 minute")
    return writer.start(sink)


def start_alert_stream(docs: DataFrame, sink: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Evaluate alert rules on every micro-batch of verify results and write
    the alert lines (with their document positions) to ``sink``, one
    ``batch_id=N`` partition per micro-batch."""
    flat = runs.flatten_runs(docs, run_date="", keep_position=True).filter(F.col("step") == "verify")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # a replayed batch (after a failure) overwrites its own partition:
        # the sink stays exactly-once although foreachBatch is at-least-once
        found = alerts.evaluate_alerts(batch).select("source_path", "doc_seq", "item_pos", "alert")
        found.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    writer = flat.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
