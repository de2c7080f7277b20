"""Alert rules over verify results, alert documents, step metrics and the
notification text.

The alert text is kept as ordered rows (one line per alert with its sort
keys), never concatenated into one value: the number of alerts grows with
the number of results, so building one string would pull an unbounded group
into one task.  Writers sort the rows (range-partitioned, distributed) when
they write the document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.columns import alert_line, epoch_to_iso, step_status
from ledgerflow.specs import ALERT_HEADER, ALL_GOOD_TEXT, MIN_ROW_COUNT, NO_ALERT, PIPELINE_NAME, SLOW_STEP_SECONDS

ORDER_COLUMNS = ("source_path", "doc_seq", "item_pos")


def evaluate_alerts(results: DataFrame, max_sec: float = SLOW_STEP_SECONDS, min_rows: int = MIN_ROW_COUNT) -> DataFrame:
    """Keep the results that alert: status not ``success`` (missing status
    alerts), duration above ``max_sec`` (missing -> 0) or fewer than
    ``min_rows`` rows (missing -> 1, so a failed read alerts).  Adds
    ``alert`` = ``Format X: status=S, duration=Ds, row_count=N``."""
    d = F.coalesce(F.col("duration_sec"), F.lit(0.0))
    n = F.coalesce(F.col("row_count"), F.lit(1).cast("bigint"))
    cond = ~F.col("status").eqNullSafe(F.lit("success")) | (d > F.lit(max_sec)) | (n < F.lit(min_rows))
    return results.filter(cond).withColumn("alert", alert_line(F.col("format"), F.col("status"), d, n))


def alert_status(alerts: DataFrame) -> DataFrame:
    """One row: ``has_alert``, ``n_alerts`` (a global count, map-side partials)."""
    return alerts.agg(F.count(F.lit(1)).alias("n_alerts")).select(
        (F.col("n_alerts") > 0).alias("has_alert"), "n_alerts")


def _key_columns(alerts: DataFrame, order_cols) -> list[str]:
    return [c for c in order_cols if c in alerts.columns]


def alert_summary(alerts: DataFrame, order_cols=ORDER_COLUMNS) -> DataFrame:
    """The alert document as rows ``(*order_cols, line)``: one line per
    alert, or a single ``NO_ALERT`` line when nothing alerts."""
    keys = _key_columns(alerts, order_cols)
    types = dict(alerts.dtypes)
    lines = alerts.select(*keys, F.col("alert").alias("line"))
    empty = (alert_status(alerts).filter(~F.col("has_alert"))
             .select(*[F.lit(None).cast(types[k]).alias(k) for k in keys], F.lit(NO_ALERT).alias("line")))
    return lines.unionByName(empty)


def notification_text(alerts: DataFrame, order_cols=ORDER_COLUMNS, pipeline: str = PIPELINE_NAME) -> DataFrame:
    """Notification as rows ``(part, *order_cols, line)``: a header naming the
    ``pipeline`` (part 0) followed by the alert lines (part 1), or the all-good
    sentence."""
    keys = _key_columns(alerts, order_cols)
    types = dict(alerts.dtypes)
    nulls = [F.lit(None).cast(types[k]).alias(k) for k in keys]
    status = alert_status(alerts)
    header = status.select(F.lit(0).alias("part"), *nulls,
                           F.when(F.col("has_alert"), F.lit(ALERT_HEADER % pipeline)).otherwise(F.lit(ALL_GOOD_TEXT % pipeline)).alias("line"))
    body = alerts.select(F.lit(1).alias("part"), *keys, F.col("alert").alias("line"))
    return header.unionByName(body)


def clean_alert_text(text_col: str = "line"):
    """Alert text stripped of surrounding whitespace (newlines included);
    ``NO_ALERT`` becomes NULL."""
    return F.nullif(F.regexp_replace(F.col(text_col), r"^\s+|\s+$", ""), F.lit(NO_ALERT))


def step_metrics(runs: DataFrame, threshold: float = SLOW_STEP_SECONDS) -> DataFrame:
    """Step duration status rows ``ts, task, duration, status, line`` for the
    step records (documents that carry a ``step`` and a ``start_time``).
    ``ts`` is the UTC ISO time the step ended; ``duration`` whole seconds."""
    steps = runs.filter(F.col("step").isNotNull() & F.col("start_time").isNotNull())
    duration = F.col("duration_sec").try_cast("bigint")
    out = steps.select(
        epoch_to_iso(F.coalesce(F.col("end_time"), F.col("start_time"))).alias("ts"),
        F.col("step").alias("task"),
        duration.alias("duration"),
        step_status(F.col("duration_sec"), threshold).alias("status"),
    )
    return out.withColumn("line", F.concat_ws(",", "ts", "task", F.coalesce(F.col("duration").cast("string"),
                                                                          F.lit("None")), "status"))


def alert_trend(alerts: DataFrame) -> DataFrame:
    """Alerts per day (documented dashboard)."""
    return alerts.groupBy("run_date").agg(F.count(F.lit(1)).alias("n_alerts"))
