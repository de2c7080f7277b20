"""Classification metrics as distributed DataFrame jobs.

* ``roc_auc``: exact rank-sum AUC (ties get average ranks), of all rows or of
  each group.  Scores are first collapsed to distinct values (partial
  aggregation, so a hot score is one row), dealt by ranges of (group, score)
  whose number follows the distinct scores, and summed within ranges; a range
  starts from the totals of the ranges before it - no window holds more than a
  range, or one row a range.
* ``confusion_matrix`` / ``classification_report``: one aggregate over
  (label, prediction) - a handful of rows - then per-class arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.sources.scratch import staged

RANGE_ROWS = 200_000  # distinct scores of a range


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (),
            range_rows: int = RANGE_ROWS) -> DataFrame:
    """``(*by, roc_auc, n_pos, n_neg)``, one row a group, or one row in all;
    positives are ``label == 1``.  NULL where a class is absent.  The distinct
    scores and their ranges are staged in the scratch folder."""
    by = list(by)
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]
    names = [f"_k{i}" for i in range(len(by))]
    per_score = staged(
        scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*keys, F.col(score).cast("double").alias("_s")).agg(
            F.sum((F.col(label) == 1).cast("long")).alias("pos"),
            F.sum((F.col(label) != 1).cast("long")).alias("neg")), "scores")
    ranges = max(-(-per_score.count() // range_rows), 1)
    placed = staged(per_score.repartitionByRange(ranges, *names, "_s").withColumn("_part", F.spark_partition_id()), "ranges")
    order = Window.partitionBy("_part", *names).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part", *names).agg(F.sum("neg").alias("_total"))
    earlier = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*[F.col(c).alias(f"b{c}") for c in ("_part", *names)], F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    below = F.coalesce(F.sum("neg").over(order), F.lit(0))
    same = F.col("_part") == F.col("b_part")
    for c in names:
        same &= F.col(c).eqNullSafe(F.col(f"b{c}"))
    ranked = placed.withColumn("_below", below).join(base, same)
    u = F.sum(F.col("pos") * (F.col("_base") + F.col("_below") + F.col("neg") * 0.5))
    agg = ranked.groupBy(*names).agg(u.alias("u"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return agg.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(by)],
        F.try_divide(F.col("u"), (F.col("n_pos") * F.col("n_neg")).cast("double")).alias("roc_auc"),
        F.coalesce(F.col("n_pos"), F.lit(0)).cast("long").alias("n_pos"),
        F.coalesce(F.col("n_neg"), F.lit(0)).cast("long").alias("n_neg"))


def confusion_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).count()


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)``: a row for every pair that occurs, of any class
    and NULL included."""
    return confusion_counts(scored, label, prediction).select("label", "prediction", F.col("count").alias("n"))


def classification_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class precision, recall, f1 and support, then ``accuracy``,
    ``macro avg`` and ``weighted avg`` rows; 0/0 counts as 0."""
    cm = confusion_counts(scored, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(F.lit(0))
    sides = cm.select(F.inline(F.array(
        F.struct(F.col("label").alias("c"), F.col("count").cast("long").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 hit.cast("long").alias("tp")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).cast("long").alias("support"),
                 F.col("count").cast("long").alias("predicted"), F.lit(0).cast("long").alias("tp")))))
    per = sides.groupBy("c").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
                                 F.sum("tp").alias("tp"))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    per = per.select("c", "support", "tp", p.alias("precision"), r.alias("recall"))
    per = per.withColumn("f1_score", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                              F.col("precision") + F.col("recall")), F.lit(0.0)))
    classes = per.select(F.col("c").cast("string").alias("class"), "precision", "recall", "f1_score",
                         F.col("support").cast("long").alias("support"))
    total = F.sum("support")
    summary = per.agg(
        (F.sum("tp") / total).alias("accuracy"), total.alias("n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("wr"),
        (F.sum(F.col("f1_score") * F.col("support")) / total).alias("wf"))
    def row(name, p_, r_, f_):
        return F.struct(F.lit(name).alias("class"), p_.cast("double").alias("precision"),
                        r_.cast("double").alias("recall"), f_.cast("double").alias("f1_score"),
                        F.col("n").cast("long").alias("support"))

    none = F.lit(None)
    rows = summary.select(F.inline(F.array(
        row("accuracy", none, none, F.col("accuracy")),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.col("wp"), F.col("wr"), F.col("wf")))))
    return classes.unionByName(rows)
