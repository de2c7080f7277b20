"""Run-metadata documents -> run table, and the documented dashboards.

A run document is one JSON text: an object (ingest / transform step record)
or a list of result objects (verify / load).  Parsing is
``try_parse_json`` (VARIANT) + ``posexplode``: JVM-side, per row, no Python
worker, no driver collect.  Malformed texts and non-object list items are
dropped (the item only, not its whole document).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.specs import DEFAULT_LIST_STEP

# Columns and types of the run-metadata table (epoch seconds
# and durations widened to double, counts to bigint).
RUN_SCHEMA = (
    ("run_date", "string"),
    ("step", "string"),
    ("start_time", "double"),
    ("end_time", "double"),
    ("duration_sec", "double"),
    ("customer_records", "bigint"),
    ("payment_records", "bigint"),
    ("format", "string"),
    ("path", "string"),
    ("is_table", "string"),
    ("status", "string"),
    ("error", "string"),
    ("row_count", "bigint"),
)
COMPACT_SCHEMA = (
    ("step", "string"),
    ("start_time", "double"),
    ("end_time", "double"),
    ("duration_sec", "double"),
    ("records", "string"),
    ("format", "string"),
    ("path", "string"),
    ("status", "string"),
    ("row_count", "bigint"),
)
POSITION_COLUMNS = ("source_path", "doc_seq", "item_pos")


# What a run document's object may hold: read in one pass over the object.  A field
# of another kind is NULL; ``step`` and ``records`` keep theirs.
ITEM = ("struct<step:variant,start_time:double,end_time:double,duration_sec:double,records:variant,format:string,"
        "path:string,is_table:string,status:string,error:string,row_count:bigint>")


def explode_documents(docs: DataFrame, value_col: str = "value", path_col: str = "path",
                      seq_col: str | None = "doc_seq") -> DataFrame:
    """One row per object of every parseable document.

    Output: ``source_path, doc_seq, item_pos, is_list, item`` (item is an ``ITEM``
    struct).  Objects keep position 0; list items keep their index among objects.
    """
    v = F.try_parse_json(F.col(value_col))
    # an object reads as the struct (``{}`` included); nothing else does
    items = F.coalesce(F.filter(F.try_variant_get(F.col("_v"), "$", f"array<{ITEM}>"), lambda x: x.isNotNull()),
                       F.array(F.try_variant_get(F.col("_v"), "$", ITEM)))
    seq = F.col(seq_col) if seq_col and seq_col in docs.columns else F.lit(None).cast("bigint")
    return (docs
            .select(F.col(path_col).alias("source_path"), seq.alias("doc_seq"), F.col(value_col).rlike(r"^\s*\[").alias("is_list"), v.alias("_v"))
            .filter(F.col("_v").isNotNull())
            .select("source_path", "doc_seq", "is_list", F.posexplode(items).alias("item_pos", "item"))
            .filter(F.col("item").isNotNull()))


def flatten_runs(docs: DataFrame, run_date: str | Column, value_col: str = "value", path_col: str = "path",
                 seq_col: str | None = "doc_seq", keep_position: bool = False) -> DataFrame:
    """Flatten heterogeneous run documents into the 13-column run table.

    * list items without a ``step`` field get ``verify``;
    * ``customer_records`` / ``payment_records`` only when ``records`` is
      an object;
    * ``path`` falls back to the document's source path when missing/empty;
    * ``is_table`` keeps its JSON text (``true`` / ``false``).
    ``run_date`` is a ``yyyy-MM-dd`` string or a column (e.g. derived from
    the source path of a daily folder).
    """
    items = explode_documents(docs, value_col, path_col, seq_col)
    step = F.try_variant_get("item.step", "$", "string")
    rd = F.lit(run_date) if isinstance(run_date, str) else run_date
    cols = [
        rd.cast("string").alias("run_date"),
        F.when(F.col("is_list") & F.col("item.step").isNull(), F.lit(DEFAULT_LIST_STEP)).otherwise(step).alias("step"),
        "item.start_time", "item.end_time", "item.duration_sec",
        F.try_variant_get("item.records", "$.customer", "bigint").alias("customer_records"),
        F.try_variant_get("item.records", "$.payment", "bigint").alias("payment_records"),
        "item.format",
        F.coalesce(F.nullif("item.path", F.lit("")), F.col("source_path")).alias("path"),
        "item.is_table", "item.status", "item.error", "item.row_count",
    ]
    if keep_position:
        cols += [F.col(c) for c in POSITION_COLUMNS]
    return items.select(*cols)


def flatten_runs_compact(docs: DataFrame, value_col: str = "value", path_col: str = "path",
                         seq_col: str | None = "doc_seq") -> DataFrame:
    """Legacy 9-column layout: ``records`` kept as JSON text (only when it is
    a non-empty value), start/end only for step records, every list item is
    ``verify``, no path fallback."""
    items = explode_documents(docs, value_col, path_col, seq_col)
    is_list = F.col("is_list")
    rec = F.to_json("item.records")
    truthy = rec.isNotNull() & ~rec.isin("null", "{}", "[]", '""', "0", "0.0", "false")
    return items.select(
        F.when(is_list, F.lit(DEFAULT_LIST_STEP)).otherwise(F.try_variant_get("item.step", "$", "string")).alias("step"),
        F.when(~is_list, F.col("item.start_time")).alias("start_time"),
        F.when(~is_list, F.col("item.end_time")).alias("end_time"),
        "item.duration_sec",
        F.when(~is_list & truthy, rec).alias("records"),
        F.when(is_list, F.col("item.format")).alias("format"),
        F.when(is_list, F.col("item.path")).alias("path"),
        "item.status",
        F.when(is_list, F.col("item.row_count")).alias("row_count"),
    )


def run_date_from_path(path: str | Column = "path") -> Column:
    """``yyyy-MM-dd`` embedded in a daily folder or file name."""
    c = F.col(path) if isinstance(path, str) else path
    return F.nullif(F.regexp_extract(c, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


# -- documented dashboards (grouped aggregates with map-side partials) -------

def duration_by_step(runs: DataFrame, digits: int = 4) -> DataFrame:
    """Run duration per day and step: mean, max, total, number of records.

    The mean is exact and independent of row order: durations are summed as
    whole microseconds (a long sum is associative, a double sum is not) and
    divided with half-up rounding to ``digits`` decimals.
    """
    micros = F.round(F.col("duration_sec") * F.lit(1_000_000.0)).try_cast("long")
    agg = runs.groupBy("run_date", "step").agg(
        F.sum(micros).alias("_us"), F.count(micros).alias("_n"),
        F.max("duration_sec").alias("max_duration_sec"),
        F.sum("duration_sec").alias("total_duration_sec"),
        F.count(F.lit(1)).alias("n_records"),
    )
    step = 10 ** (6 - digits)
    half_up = F.expr(f"signum(_us) * ((abs(_us) * 2 + {step} * _n) div ({2 * step} * _n))")
    mean = F.when(F.col("_n") > 0, half_up / F.lit(float(10 ** digits)))
    return agg.select("run_date", "step", mean.alias("avg_duration_sec"), "max_duration_sec",
                      "total_duration_sec", "n_records")


def daily_status(runs: DataFrame) -> DataFrame:
    """Count of results per day and status, every status that occurs and NULL
    (records without one) as rows of their own."""
    return runs.groupBy("run_date", "status").agg(F.count(F.lit(1)).alias("n_results"))


def row_drop_check(runs: DataFrame, max_drop: float = 0.1,
                   before_step: str = "ingest", after_step: str = "transform") -> DataFrame:
    """Unexpected row drop between two steps of the same day.

    Record counts are summed per day and step (conditional aggregation, one
    shuffle on ``run_date``; no pairing of documents), then the relative
    drop per table is compared with ``max_drop``.  A day without the later
    step has lost everything: its count there is 0.
    """
    def total(step: str, col: str) -> Column:
        return F.sum(F.when(F.col("step") == step, F.col(col))).alias(f"{col}_{step}")

    per_day = runs.groupBy("run_date").agg(
        total(before_step, "customer_records"), total(after_step, "customer_records"),
        total(before_step, "payment_records"), total(after_step, "payment_records"))
    tables = []
    for table, col in (("customer", "customer_records"), ("payment", "payment_records")):
        before = F.col(f"{col}_{before_step}")
        after = F.when(before.isNotNull(), F.coalesce(F.col(f"{col}_{after_step}"), F.lit(0).cast("bigint"))).otherwise(
            F.col(f"{col}_{after_step}"))
        ratio = F.lit(1.0) - F.try_divide(after.cast("double"), before.cast("double"))
        tables.append(per_day.select(
            "run_date", F.lit(table).alias("table"), before.alias("records_before"),
            after.alias("records_after"), ratio.alias("drop_ratio"),
            F.coalesce(ratio > F.lit(max_drop), F.lit(False)).alias("flagged")))
    return tables[0].unionByName(tables[1])
