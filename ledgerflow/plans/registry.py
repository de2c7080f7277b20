"""Query registry: one entry per operator of the inventory.

Each query takes ``(spark, sf_dir)``, reads the driver tables (or fixtures
Spark derives from them) in full, and returns a DataFrame whose column names
match the oracle SQL.  Doubles are rounded to 4 decimals at the boundary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators import alerts, clean, features, metrics, ml, quantiles, runs, sampling, smote
from ledgerflow.sources import fixtures as fx
from ledgerflow.plans.daily import run_pipeline
from ledgerflow.operators.quality import results_frame, schema_check, verify_table
from ledgerflow.sources import readers, sinks
from ledgerflow.sources.scratch import reliable_checkpoint, scratch_path
from ledgerflow.specs import CUSTOMER_SPEC, PAYMENT_SPEC

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def boundary(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column so engines compare equal."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not fl:
        return df
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in fl else F.col(c) for c in df.columns])


# -- fixtures -----------------------------------------------------------------

def raw_customer(spark: SparkSession, sf: str) -> DataFrame:
    return fx.dirty_customer(fx.load(spark, sf, "customer"))


def raw_payment(spark: SparkSession, sf: str) -> DataFrame:
    return fx.dirty_payment(fx.load(spark, sf, "orders"))


def cleaned_customer(spark: SparkSession, sf: str, scope: str = "raw") -> DataFrame:
    return clean.clean_customer(raw_customer(spark, sf), order_by=["copy"], scope=scope).drop("copy")


def cleaned_payment(spark: SparkSession, sf: str, scope: str = "raw") -> DataFrame:
    return clean.clean_payment(raw_payment(spark, sf), order_by=["ord"], scope=scope).drop("ord")


# -- cleaning -----------------------------------------------------------------

@register("dedupe_by_key")
def q_dedupe(spark, sf):
    df = clean.dedupe_by_key(raw_payment(spark, sf), ["id"], order_by=["ord"])
    return df.select("id", "ord", "OVD_t1", "OVD_t2", "OVD_t3", "OVD_sum", "pay_normal", "prod_code")


@register("tolerant_cast")
def q_tolerant_cast(spark, sf):
    df = clean.tolerant_cast(raw_payment(spark, sf), PAYMENT_SPEC.double_columns)
    return boundary(df.select("id", "ord", *PAYMENT_SPEC.double_columns))


@register("parse_dates")
def q_parse_dates(spark, sf):
    df = clean.parse_dates(raw_payment(spark, sf), PAYMENT_SPEC.date_columns, PAYMENT_SPEC.date_format)
    return df.select("id", "ord", *PAYMENT_SPEC.date_columns)


@register("not_null_filter")
def q_not_null(spark, sf):
    df = clean.tolerant_cast(raw_customer(spark, sf), CUSTOMER_SPEC.double_columns)
    df = clean.not_null_filter(df, CUSTOMER_SPEC.not_null)
    return boundary(df.select("id", "copy", "fea_2", "fea_3", "fea_4"))


@register("upper_bound_filter")
def q_upper_bound(spark, sf):
    col, bound = CUSTOMER_SPEC.upper_bounds[0]
    return boundary(clean.upper_bound_filter(raw_customer(spark, sf), col, bound).select("id", "copy", col))


@register("sentinel_filter")
def q_sentinel(spark, sf):
    df = clean.sentinel_filter(raw_customer(spark, sf), dict(CUSTOMER_SPEC.sentinels))
    return df.select("id", "copy", "fea_7", "fea_8")


@register("range_filter")
def q_range(spark, sf):
    col, lo, hi = PAYMENT_SPEC.ranges[0]
    df = clean.tolerant_cast(raw_payment(spark, sf), [col])
    return boundary(clean.range_filter(df, col, lo, hi).select("id", "ord", col))


@register("impute_mean_raw")
def q_impute_raw(spark, sf):
    raw = raw_payment(spark, sf)
    df = clean.impute_mean(clean.tolerant_cast(raw, ["highest_balance"]), ["highest_balance"], source=raw)
    return boundary(df.select("id", "ord", "highest_balance"))


@register("impute_mean_filtered")
def q_impute_filtered(spark, sf):
    return boundary(cleaned_payment(spark, sf, scope="filtered"))


@register("clean_customer")
def q_clean_customer(spark, sf):
    return boundary(cleaned_customer(spark, sf))


@register("clean_payment")
def q_clean_payment(spark, sf):
    return boundary(cleaned_payment(spark, sf))


@register("conform_columns")
def q_conform(spark, sf):
    return boundary(clean.conform_customer(cleaned_customer(spark, sf)))


# -- run metadata, alerts, dashboards ---------------------------------------

EPOCH_COLUMNS = ("start_time", "end_time")


def floor4(df: DataFrame, cols=EPOCH_COLUMNS) -> DataFrame:
    """Epoch seconds carry microseconds; flooring to 4 decimals (exact in
    IEEE arithmetic on both engines) avoids rounding ties at the boundary."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.floor(F.col(c) * 10000) / 10000 for c in present}) if present else df


def run_table(spark: SparkSession, sf: str, keep_position: bool = False) -> DataFrame:
    docs = fx.run_docs(fx.load(spark, sf, "events"))
    return runs.flatten_runs(docs, run_date=runs.run_date_from_path("source_path"), keep_position=keep_position)


def verify_alerts(spark: SparkSession, sf: str) -> DataFrame:
    table = run_table(spark, sf, keep_position=True)
    return alerts.evaluate_alerts(table.filter(F.col("step") == "verify"))


@register("flatten_runs")
def q_flatten_runs(spark, sf):
    return boundary(floor4(run_table(spark, sf)))


@register("flatten_runs_compact")
def q_flatten_runs_compact(spark, sf):
    docs = fx.run_docs(fx.load(spark, sf, "events"))
    return boundary(floor4(runs.flatten_runs_compact(docs)))


@register("evaluate_alerts")
def q_evaluate_alerts(spark, sf):
    out = verify_alerts(spark, sf)
    return boundary(out.select("doc_seq", "item_pos", "format", "status", "duration_sec", "row_count", "alert"))


@register("alert_status")
def q_alert_status(spark, sf):
    return alerts.alert_status(verify_alerts(spark, sf))


@register("alert_summary")
def q_alert_summary(spark, sf):
    return alerts.alert_summary(verify_alerts(spark, sf))


@register("notification_text")
def q_notification_text(spark, sf):
    return alerts.notification_text(verify_alerts(spark, sf))


@register("step_metrics")
def q_step_metrics(spark, sf):
    return alerts.step_metrics(run_table(spark, sf))


@register("duration_by_step")
def q_duration_by_step(spark, sf):
    return boundary(runs.duration_by_step(run_table(spark, sf)))


@register("daily_status")
def q_daily_status(spark, sf):
    return runs.daily_status(run_table(spark, sf))


@register("alert_trend")
def q_alert_trend(spark, sf):
    return alerts.alert_trend(verify_alerts(spark, sf))


@register("row_drop_check")
def q_row_drop_check(spark, sf):
    return boundary(runs.row_drop_check(run_table(spark, sf), max_drop=0.1))


# -- features, split, scaling, metrics ----------------------------------------

def joined_frame(spark: SparkSession, sf: str) -> DataFrame:
    c = clean.conform_customer(cleaned_customer(spark, sf))
    p = clean.conform_payment(cleaned_payment(spark, sf))
    return features.customer_payment_join(c, p)


def feature_frame(spark: SparkSession, sf: str) -> DataFrame:
    c = clean.conform_customer(cleaned_customer(spark, sf))
    p = clean.conform_payment(cleaned_payment(spark, sf))
    return features.build_features(c, p)


def scored_frame(spark: SparkSession, sf: str) -> DataFrame:
    return fx.scored(fx.load(spark, sf, "labels"), fx.load(spark, sf, "documents"))


@register("customer_payment_left_join")
def q_join(spark, sf):
    return boundary(joined_frame(spark, sf))


@register("impute_median_all")
def q_impute_median(spark, sf):
    return boundary(features.impute_median(joined_frame(spark, sf)))


@register("debt_ratio")
def q_debt_ratio(spark, sf):
    df = features.add_credit_features(joined_frame(spark, sf))
    return boundary(df.select("id", "new_balance", "credit_limit", "debt_ratio"))


@register("over_limit_flag")
def q_over_limit(spark, sf):
    df = features.add_credit_features(joined_frame(spark, sf))
    return boundary(df.select("id", "new_balance", "credit_limit", "is_over_limit"))


@register("row_mean_overdue")
def q_row_mean(spark, sf):
    df = features.add_credit_features(joined_frame(spark, sf))
    return boundary(df.select("id", "OVD_t1", "OVD_t2", "OVD_t3", "mean_ovd"))


@register("build_features")
def q_build_features(spark, sf):
    return boundary(feature_frame(spark, sf))


@register("stratified_split")
def q_split(spark, sf):
    return sampling.stratified_split(joined_frame(spark, sf)).select("id", "label", "split")


@register("standardise")
def q_standardise(spark, sf):
    df = sampling.stratified_split(feature_frame(spark, sf))
    cols = features.feature_columns(df, drop=("id", "label", "update_date", "report_date", "split"))
    out = sampling.standardise(df, cols, train=df.filter(F.col("split") == "train"))
    return boundary(out.select("id", "label", "split", *cols))


@register("roc_auc")
def q_roc_auc(spark, sf):
    return boundary(metrics.roc_auc(scored_frame(spark, sf)))


@register("confusion_matrix")
def q_confusion(spark, sf):
    return metrics.confusion_matrix(scored_frame(spark, sf))


@register("classification_report")
def q_report(spark, sf):
    return boundary(metrics.classification_report(scored_frame(spark, sf)))


# -- resampling and models -------------------------------------------------------

EMBED_DIMS = 64  # the whole vector


@register("smote_balance")
def q_smote(spark, sf):
    df = fx.embedding_matrix(fx.load(spark, sf, "embeddings"), EMBED_DIMS)
    cols = [f"x{i}" for i in range(EMBED_DIMS)]
    return boundary(smote.smote_balance(df, cols))


def trained_model(spark: SparkSession, sf: str):
    """Split the training frame, fit scale -> SMOTE -> trees on the training
    part with the parameters of the reference's logged run."""
    df = sampling.stratified_split(feature_frame(spark, sf))
    cols = features.feature_columns(df, drop=("id", "label", "update_date", "report_date", "split"))
    df = reliable_checkpoint(df)
    train, test = df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test")
    est = ml.ResampledClassifier(featureCols=cols, maxIter=100, maxDepth=3, stepSize=0.05, subsamplingRate=0.8)
    return est.fit(train), test, cols


@register("gbt_predict")
def q_gbt_predict(spark, sf):
    model, test, _ = trained_model(spark, sf)
    return boundary(ml.predict(model, test))


@register("top_k_importance")
def q_top_k_importance(spark, sf):
    model, _, cols = trained_model(spark, sf)
    return boundary(ml.top_importances(model, cols, spark))


# Trees whose fit is sums over few values of a feature, without chance: three
# stumps, no row sampling, no resampling.  SQL repeats the whole fit.
FEW_VALUED = ["region_code", "fea_3", "fea_5", "fea_6", "fea_7", "fea_9", "OVD_t1", "OVD_t2", "OVD_sum", "pay_normal"]
STUMPS = {"maxIter": 3, "maxDepth": 1, "stepSize": 0.1, "subsamplingRate": 1.0}


def fitted_stumps(frame: DataFrame):
    """Model and test rows of the reproducible fit."""
    df = reliable_checkpoint(sampling.stratified_split(frame).select("id", "label", "split", *FEW_VALUED))
    est = ml.ResampledClassifier(featureCols=FEW_VALUED, resample=False, **STUMPS)
    return est.fit(df.filter(F.col("split") == "train")), df.filter(F.col("split") == "test")


@register("stumps_predict")
def q_stumps_predict(spark, sf):
    """Class and score of the test rows (fit, apply)."""
    return boundary(ml.predict(*fitted_stumps(feature_frame(spark, sf))))


@register("stumps_importance")
def q_stumps_importance(spark, sf):
    """Top-k features by gain; features without any are left out."""
    model, _ = fitted_stumps(feature_frame(spark, sf))
    return boundary(ml.top_importances(model, FEW_VALUED, spark).filter("importance > 0"))


@register("model_round_trip")
def q_model_round_trip(spark, sf):
    """The model written, read into a new object, and applied to raw rows."""
    model, test = fitted_stumps(feature_frame(spark, sf))
    path = scratch_path(spark, "model")
    ml.save_resampled(model, path)
    return boundary(ml.predict(ml.load_resampled(spark, path), test))


@register("train_from_csv")
def q_train_from_csv(spark, sf):
    """Both cleaned tables written as CSV, read with inferred types, and trained on."""
    copies = {}
    for table, df in conformed(spark, sf).items():
        path = scratch_path(spark, f"{table}_csv")
        sinks.write_table(df, sinks.Target("csv", path))
        copies[table] = readers.read_csv(spark, path, infer=True).withColumn("id", F.col("id").cast("bigint"))
    return boundary(ml.predict(*fitted_stumps(features.build_features(copies["customer"], copies["payment"]))))


@register("grid_search_folds")
def q_grid_search_folds(spark, sf):
    """A grid search by folds from its staged steps: interrupted after the first point,
    it goes on with the others."""
    df = sampling.stratified_split(feature_frame(spark, sf)).filter(F.col("split") == "train")
    df = reliable_checkpoint(df.select("id", "label", *FEW_VALUED))
    base = scratch_path(spark, "grid")
    fixed = {k: [v] for k, v in STUMPS.items() if k != "maxIter"}
    ml.grid_search_folds(df, FEW_VALUED, base, {"maxIter": [1], **fixed}, resample=False)
    return boundary(ml.grid_search_folds(df, FEW_VALUED, base, {"maxIter": [1, 3], **fixed}, resample=False))


@register("fold_resampling")
def q_fold_resampling(spark, sf):
    """Class sizes of each fold's fitted rows: balanced inside every fold, none of the
    rows left out among them."""
    df = sampling.stratified_split(feature_frame(spark, sf)).filter(F.col("split") == "train")
    base = scratch_path(spark, "grid")
    ml.grid_search_folds(reliable_checkpoint(df.select("id", "label", *FEW_VALUED)), FEW_VALUED, base,
                         {"maxIter": [1], "maxDepth": [1]})
    fitted = spark.read.parquet(f"{base}/resampled").groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n_fitted"))
    left = spark.read.parquet(f"{base}/rows").groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n_left_out"))
    return fitted.join(left, ["fold", "label"])


@register("best_training_runs")
def q_best_training_runs(spark, sf):
    """Runs of two scores on each language, logged one by one, and the log read back."""
    langs = fx.load(spark, sf, "documents").filter("lang is not null").select("doc_id", "lang")
    scored = scored_frame(spark, sf).join(langs, "doc_id")
    log = scratch_path(spark, "training_runs")
    for name, score in (("long_texts", F.col("score")), ("short_texts", -F.col("score"))):
        found = metrics.roc_auc(scored.withColumn("score", score), by=["lang"]).filter("roc_auc is not null")
        for r in found.collect():  # one row a language
            sinks.log_training_run(spark, log, r["lang"], name, {"lang": r["lang"]}, {"roc_auc": r["roc_auc"], "n_pos": r["n_pos"]})
    return boundary(sinks.best_training_runs(spark.read.parquet(log)).drop("params"))


@register("median_sketches")
def q_median_sketches(spark, sf):
    """Medians from sketches stored by day and merged, and whether the exact rank of each
    is within 2 % of the middle."""
    df = reliable_checkpoint(cleaned_payment(spark, sf))
    columns = ["prod_limit", "new_balance", "highest_balance"]
    path = scratch_path(spark, "sketches")
    sinks.replace_partitions(quantiles.daily_sketches(df, "update_date", columns), path, ["day"])
    found = quantiles.merged_quantile(spark.read.parquet(path))
    value = {r["column"]: r["quantile"] for r in found.collect()}  # one row a column
    exact = df.agg(*[F.count(F.when(cond, 1)).alias(f"{c}_{side}") for c in value
                     for side, cond in (("below", F.col(c) < value[c]), ("upto", F.col(c) <= value[c]))]).first()
    within = {c: (exact[f"{c}_below"], exact[f"{c}_upto"]) for c in value}
    rows = [(r["column"], r["n"], within[r["column"]][0] <= 0.52 * r["n"] and within[r["column"]][1] >= 0.48 * r["n"])
            for r in found.collect()]
    return spark.createDataFrame(rows, "column string, n bigint, within_error boolean")


# -- sources and sinks (written to a scratch folder under the shared
#    checkpoint folder, then read back) ------------------------------------

IO_FORMATS = ("csv", "parquet", "orc", "json")


def conformed(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"customer": clean.conform_customer(cleaned_customer(spark, sf)),
            "payment": clean.conform_payment(cleaned_payment(spark, sf))}


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    df = conformed(spark, sf)["payment"]
    path = scratch_path(spark, "payment_csv")
    sinks.write_table(df, sinks.Target("csv", path))
    return boundary(readers.read_table(spark, "csv", path, schema=df.schema))


@register("parquet_roundtrip")
def q_parquet_roundtrip(spark, sf):
    df = conformed(spark, sf)["customer"]
    path = scratch_path(spark, "customer_parquet")
    sinks.write_table(df, sinks.Target("parquet", path))
    return boundary(readers.read_table(spark, "parquet", path))


def _fan_out_all(spark, sf):
    base = scratch_path(spark, "fan_out")
    results, targets = [], []
    for table, df in conformed(spark, sf).items():
        tg = [sinks.Target(f, f"{base}/{f}/{table}") for f in IO_FORMATS]
        results += sinks.fan_out(df, tg, table=table)
        targets += [(table, t) for t in tg]
    return results, targets


@register("fan_out_counts")
def q_fan_out(spark, sf):
    results, _ = _fan_out_all(spark, sf)
    return results_frame(spark, results).select("table", "format", "status", "row_count")


@register("verify_tables")
def q_verify(spark, sf):
    _, targets = _fan_out_all(spark, sf)
    rows = [verify_table(spark, t, table) for table, t in targets]
    return results_frame(spark, rows).select("table", "format", "status", "row_count")


@register("run_pipeline_status")
def q_run_pipeline_status(spark, sf):
    """The daily pipeline over all five copy formats: one row per copy written,
    copy checked and table loaded; formats without a connector fail."""
    out = run_pipeline(spark, raw_customer(spark, sf), raw_payment(spark, sf), scratch_path(spark, "daily"),
                       customer_order=["copy"], payment_order=["ord"], run_date="2026-01-01")
    rows = [(step, r["table"], r.get("format"), r["status"], r.get("row_count"))
            for step in ("fan_out", "verify", "load") for r in out[step]]  # one a copy or table
    return spark.createDataFrame(rows, "step string, table string, format string, status string, row_count bigint")


@register("schema_check")
def q_schema_check(spark, sf):
    """The payment table written as Parquet and as CSV, read back the way a
    verifier reads them: the CSV copy carries text columns."""
    df = conformed(spark, sf)["payment"]
    base = scratch_path(spark, "schema_check")
    sinks.write_table(df, sinks.Target("parquet", f"{base}/parquet"))
    sinks.write_table(df, sinks.Target("csv", f"{base}/csv"))
    copies = {"parquet": readers.read_table(spark, "parquet", f"{base}/parquet"),
              "csv": readers.read_table(spark, "csv", f"{base}/csv")}
    return schema_check(spark, copies, "parquet")


@register("load_table_modes")
def q_load_modes(spark, sf):
    """Two daily loads per mode: ``truncate`` keeps one copy, ``append`` two."""
    rows = []
    for table, df in conformed(spark, sf).items():
        staged = scratch_path(spark, f"{table}_staged")
        df.write.parquet(staged)
        for mode in ("truncate", "append"):
            target = scratch_path(spark, f"{table}_{mode}")
            for _ in range(2):
                sinks.load_table(spark, staged, target, mode=mode)
            held = spark.read.parquet(target).agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"),
                                                  F.count_distinct("id").alias("keys")).first()
            rows.append((table, mode, held["n"], held["ids"], held["keys"]))
    return spark.createDataFrame(rows, "table string, mode string, row_count bigint, id_sum bigint, distinct_ids bigint")


@register("ingest_run_docs")
def q_ingest_run_docs(spark, sf):
    """Run documents from text files: two folders, one of them found by a glob,
    an empty file and a path that matches nothing."""
    docs = fx.run_docs(fx.load(spark, sf, "events"))
    base = scratch_path(spark, "doc_files")
    docs.filter(F.col("doc_seq") % 2 == 0).select("value").write.text(f"{base}/even")
    docs.filter(F.col("doc_seq") % 2 == 1).select("value").write.text(f"{base}/more/odd")
    fx.zero_byte_file(spark, f"{base}/more/empty.json")
    found, missing = readers.read_run_docs(spark, [f"{base}/even", f"{base}/more/*", f"{base}/nothing/here"])
    table = runs.flatten_runs(found, run_date="2026-01-01")
    return boundary(table.select("step", "format", "status", "row_count", "duration_sec", "error",
                                 F.lit(len(missing)).alias("missing_paths")))


@register("unreadable_run_docs")
def q_unreadable_run_docs(spark, sf):
    """Compressed run documents under one glob, some of the files cut short: the rows of
    the whole files, and how many files were reported."""
    docs = fx.run_docs(fx.load(spark, sf, "events"))
    base = scratch_path(spark, "doc_files")
    for i in range(4):
        docs.filter(F.col("doc_seq") % 4 == i).select("value").coalesce(1).write.option("compression", "gzip").text(f"{base}/r{i}")
    fx.cut_short(spark, f"{base}/r3")
    found, skipped = readers.read_run_docs(spark, [f"{base}/r*"])
    table = runs.flatten_runs(found, run_date="2026-01-01")
    return boundary(table.select("step", "format", "status", "row_count", "duration_sec", "error",
                                 F.lit(len(skipped)).alias("unreadable_files")))


@register("rerun_run_table")
def q_rerun_run_table(spark, sf):
    """The run table after some of its days were loaded again: the same rows."""
    table = run_table(spark, sf)
    path = scratch_path(spark, "runs")
    sinks.replace_partitions(table, path, ["run_date"])
    sinks.replace_partitions(table.filter(F.substring("run_date", 10, 1).isin("0", "2", "4", "6", "8")), path, ["run_date"])
    schema = ", ".join(f"{n} {t}" for n, t in runs.RUN_SCHEMA)
    return boundary(floor4(spark.read.schema(schema).parquet(path).select(*[n for n, _ in runs.RUN_SCHEMA])))


@register("infer_csv_types")
def q_infer_csv_types(spark, sf):
    """Column types that an inference pass finds in the dirty tables as CSV."""
    rows = []
    for table, df in (("customer", raw_customer(spark, sf)), ("payment", raw_payment(spark, sf))):
        path = scratch_path(spark, f"{table}_raw")
        sinks.write_table(df, sinks.Target("csv", path))
        rows += [(table, name, kind) for name, kind in readers.read_csv(spark, path, infer=True).dtypes]
    return spark.createDataFrame(rows, "table string, column string, type string")


@register("step_metric_log")
def q_step_metric_log(spark, sf):
    """The step-metric log, appended in two loads and read back."""
    metrics_ = alerts.step_metrics(run_table(spark, sf))
    path = scratch_path(spark, "step_log")
    slow = F.col("status") == "warning"
    for part in (metrics_.filter(slow), metrics_.filter(~slow)):
        sinks.append_step_metric(part, path)
    return spark.read.schema("ts string, task string, duration bigint, status string").csv(path)


@register("alert_file")
def q_alert_file(spark, sf):
    """The alert document as its file holds it."""
    path = scratch_path(spark, "alert")
    sinks.write_alert(alerts.alert_summary(verify_alerts(spark, sf)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


# -- streaming ------------------------------------------------------------------

@register("stream_flatten_runs")
def q_stream_flatten_runs(spark, sf):
    """The run documents land as JSON-lines files; an available-now stream
    flattens them into a Parquet run table, which is read back."""
    from ledgerflow.streaming.run_docs import read_doc_stream, start_run_table

    docs_dir = scratch_path(spark, "docs")
    fx.run_docs(fx.load(spark, sf, "events")).repartition(4).write.json(docs_dir)
    sink, ckpt = scratch_path(spark, "runs"), scratch_path(spark, "runs_ckpt")
    q = start_run_table(read_doc_stream(spark, docs_dir, fmt="json", max_files_per_trigger=2), sink, ckpt,
                        run_date=runs.run_date_from_path("source_path"))
    q.awaitTermination()
    return boundary(floor4(spark.read.parquet(sink)))
