"""Command-line jobs, one per pipeline step (``spark-submit`` entry points).

    python -m ledgerflow.plans.jobs ingest    --customer C.csv --payment P.csv --base OUT
    python -m ledgerflow.plans.jobs transform --base OUT [--formats csv,parquet,delta,hudi,iceberg]
    python -m ledgerflow.plans.jobs verify    --base OUT [--formats ...]
    python -m ledgerflow.plans.jobs load      --base OUT [--mode truncate|append]
    python -m ledgerflow.plans.jobs metadata  --base OUT [--run-date yyyy-MM-dd]
    python -m ledgerflow.plans.jobs alert     --base OUT
    python -m ledgerflow.plans.jobs train     --base OUT [--folds 3] [--parallelism 4] [--grid JSON]
    python -m ledgerflow.plans.jobs all       --customer C.csv --payment P.csv --base OUT

Every job exits non-zero when its step fails (the reference's wrappers
swallowed failures), and prints its step record as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import functions as F

from ledgerflow.plans import daily as P
from ledgerflow.plans.session import build_session, shuffle_partitions_for
from ledgerflow.sources.readers import read_csv
from ledgerflow.specs import CUSTOMER_RAW_SCHEMA, PAYMENT_RAW_SCHEMA, VERIFY_FORMATS


def size_shuffles(spark, paths: list[str]) -> int:
    """Set the initial shuffle partitions from the input volume (AQE then
    coalesces / splits at run time)."""
    jvm, hconf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        total += hp.getFileSystem(hconf).getContentSummary(hp).getLength()
    n = shuffle_partitions_for(total, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def _formats(arg: str | None) -> tuple[str, ...]:
    if arg:
        return tuple(f.strip() for f in arg.split(",") if f.strip())
    return VERIFY_FORMATS


def train(spark, layout: P.Layout, folds: int, parallelism: int, grid: dict | None = None) -> dict:
    """The training job: features -> split -> grid search (scale + SMOTE +
    trees per fold) -> test metrics -> model, importances and run log."""
    from ledgerflow.operators import features, metrics, ml, sampling
    from ledgerflow.sources.scratch import reliable_checkpoint
    from ledgerflow.sources.sinks import log_training_run

    customer = spark.read.parquet(layout.copy("parquet", "customer").path)
    payment = spark.read.parquet(layout.copy("parquet", "payment").path)
    frame = reliable_checkpoint(sampling.stratified_split(features.build_features(customer, payment)))
    cols = features.feature_columns(frame, drop=("id", "label", "update_date", "report_date", "split"))
    train_df = frame.filter(F.col("split") == "train")
    test_df = frame.filter(F.col("split") == "test")
    cv = ml.grid_search(train_df, cols, grid=grid, folds=folds, parallelism=parallelism)
    scored = reliable_checkpoint(ml.predict(cv.bestModel, test_df))
    auc = metrics.roc_auc(scored).first()["roc_auc"]
    base = f"{layout.base}/model"
    ml.save_resampled(cv.bestModel, f"{base}/classifier")
    metrics.classification_report(scored).write.mode("overwrite").parquet(f"{base}/report")
    metrics.confusion_matrix(scored).write.mode("overwrite").parquet(f"{base}/confusion")
    ml.top_importances(cv.bestModel, cols, spark).write.mode("overwrite").parquet(f"{base}/importance")
    params = ml.best_params(cv)
    log_training_run(spark, f"{layout.base}/warehouse/training_runs", ml.new_run_id(), "gbt_smote_gridsearch",
                     params, {"roc_auc": auc})
    return {"step": "train", "params": params, "roc_auc": auc}


def main(argv: list[str] | None = None, spark=None) -> int:
    """Run one step; ``spark`` reuses an existing session (left running)."""
    ap = argparse.ArgumentParser(prog="ledgerflow")
    ap.add_argument("step", choices=["ingest", "transform", "verify", "load", "metadata", "alert", "train", "all"])
    ap.add_argument("--base", required=True, help="output base folder")
    ap.add_argument("--customer", help="dirty customer CSV (ingest/all)")
    ap.add_argument("--payment", help="dirty payment CSV (ingest/all)")
    ap.add_argument("--formats", help="comma-separated copy formats")
    ap.add_argument("--mode", default="truncate", choices=["truncate", "append"])
    ap.add_argument("--run-date")
    ap.add_argument("--scope", default="raw", choices=["raw", "filtered"])
    ap.add_argument("--folds", type=int, default=3)
    ap.add_argument("--parallelism", type=int, default=4)
    ap.add_argument("--grid", help='JSON grid override, e.g. {"maxIter": [20], "maxDepth": [3]}')
    ap.add_argument("--lakehouse", default="", help="session extensions to load: delta,iceberg,hudi (jars needed)")
    args = ap.parse_args(argv)

    lake = tuple(f for f in args.lakehouse.split(",") if f)
    own = spark is None
    spark = spark or build_session(app_name=f"ledgerflow-{args.step}", formats=lake)
    layout = P.Layout(args.base.rstrip("/"))
    if own and args.customer and args.payment:
        size_shuffles(spark, [args.customer, args.payment])
    start = time.time()
    if args.step in ("ingest", "all") and not (args.customer and args.payment):
        ap.error("--customer and --payment are required")
    if args.step == "ingest":
        out = P.ingest(spark, read_csv(spark, args.customer, schema=CUSTOMER_RAW_SCHEMA),
                       read_csv(spark, args.payment, schema=PAYMENT_RAW_SCHEMA), layout, scope=args.scope)
        ok = True
    elif args.step == "transform":
        out, results = P.transform(spark, layout, _formats(args.formats))
        ok = all(r["status"] == "success" for r in results)
    elif args.step == "verify":
        rows = [r.asDict() for r in P.verify(spark, layout, _formats(args.formats)).collect()]
        out, ok = rows, all(r["status"] == "success" for r in rows)
    elif args.step == "load":
        out = P.load(spark, layout, mode=args.mode)
        ok = all(r["status"] == "success" for r in out)
    elif args.step == "metadata":
        n = P.collect_metadata(spark, layout, args.run_date).count()
        out, ok = {"step": "metadata", "rows": n}, n > 0
    elif args.step == "alert":
        lines = P.check_alerts(spark, layout)
        out, ok = {"step": "alert", "lines": lines.count()}, True
    elif args.step == "train":
        grid = json.loads(args.grid) if args.grid else None
        out, ok = train(spark, layout, args.folds, args.parallelism, grid), True
    else:
        res = P.run_pipeline(spark, read_csv(spark, args.customer, schema=CUSTOMER_RAW_SCHEMA),
                             read_csv(spark, args.payment, schema=PAYMENT_RAW_SCHEMA), args.base,
                             formats=_formats(args.formats), run_date=args.run_date)
        out, ok = {"ingest": res["ingest"], "transform": res["transform"]}, res["ok"]
    print(json.dumps({"result": out, "seconds": round(time.time() - start, 2)}, default=str))
    if own:
        spark.stop()
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
