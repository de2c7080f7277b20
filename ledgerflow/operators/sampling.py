"""Seeded, repeatable row selection and scaling.

* ``hash_key``: a 60-bit key from ``md5(id:seed)``; the same rule in SQL
  reproduces it, so splits are checkable and stable under recomputation
  (no ``rand()``, which changes with partitioning).
* ``stratified_split``: exact per-class test size ``round(f * n_c)``; the
  test rows are the ones with the smallest keys of their class.  The k-th
  key per class comes from ``select_ranks`` (bounded bands), and the
  thresholds (one row per class) are broadcast.
* ``fold_column``: every class is cut into k folds of equal size (within one
  row) at ranks of its seeded keys, found the same way.
* ``standardise``: mean 0 and population std 1, fitted on training rows
  only; a constant column is only centred (scale 1).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.quantiles import select_ranks
from ledgerflow.sources.scratch import staged
from ledgerflow.specs import SEED, TEST_FRACTION


def hash_key(id_col: str | Column, seed: int = SEED) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "id", test_fraction: float = TEST_FRACTION,
                     seed: int = SEED, split_col: str = "split") -> DataFrame:
    """Adds ``split`` = ``test`` / ``train`` with exactly
    ``round(test_fraction * n_c)`` test rows in every class ``c``.  ``df`` runs
    once: its rows are staged, the thresholds read two columns of them."""
    keyed = staged(df, "split_rows").withColumn("_u", hash_key(id_col, seed))
    picked = select_ranks(keyed, [label], ["_u", id_col], lambda n: [F.round(n * F.lit(test_fraction))])
    # one threshold row per class (bounded by the number of classes)
    rows = picked.select(label, F.col("_u").alias("_tu"), F.col(id_col).alias("_tid")).collect()
    thr = df.sparkSession.createDataFrame(rows, f"{label} {dict(df.dtypes)[label]}, _tu bigint, "
                                                f"_tid {dict(df.dtypes)[id_col]}")
    joined = keyed.join(F.broadcast(thr), label, "left")
    before = (F.col("_u") < F.col("_tu")) | ((F.col("_u") == F.col("_tu")) & (F.col(id_col) <= F.col("_tid")))
    is_test = F.coalesce(before, F.lit(False))
    return joined.withColumn(split_col, F.when(is_test, F.lit("test")).otherwise(F.lit("train"))).drop(
        "_u", "_tu", "_tid")


def fold_column(df: DataFrame, id_col: str = "id", folds: int = 3, seed: int = SEED, name: str = "fold",
                label: str = "label") -> DataFrame:
    """Adds ``fold``: the rows of each class, in the order of their seeded keys,
    cut after ranks ``floor(n_c * j / folds)``.  Rows without a label: fold 0."""
    keyed = df.withColumn("_u", hash_key(id_col, seed + 1))
    picked = select_ranks(keyed, [label], ["_u", id_col],
                          lambda n: [F.floor(n * F.lit(j) / F.lit(folds)) for j in range(1, folds)])
    cuts: dict = {}
    for r in picked.collect():  # at most ``folds - 1`` rows a class
        cuts.setdefault(r[label], []).append((r["_u"], r[id_col]))
    types = dict(df.dtypes)
    table = df.sparkSession.createDataFrame(list(cuts.items()), f"{label} {types[label]}, "
                                                                f"_cuts array<struct<u:bigint,id:{types[id_col]}>>")
    above = F.size(F.filter("_cuts", lambda c: F.struct(F.col("_u"), F.col(id_col)) > F.struct(c["u"], c["id"])))
    return (keyed.join(F.broadcast(table), label, "left")
            .withColumn(name, F.when(F.col("_cuts").isNull(), 0).otherwise(above).cast("int")).drop("_u", "_cuts"))


def scaler_stats(train: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: ``<c>_mean`` and ``<c>_std`` (population) per column."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}_mean"), F.stddev_pop(x).alias(f"{c}_std")]
    return train.agg(*aggs)


def standardise(df: DataFrame, columns: Iterable[str], train: DataFrame | None = None) -> DataFrame:
    """``(x - mean) / std`` with stats of ``train`` (default: ``df``)."""
    columns = list(columns)
    st = scaler_stats(df if train is None else train, columns).first()  # one row
    out = {}
    for c in columns:
        mean, std = st[f"{c}_mean"], st[f"{c}_std"]
        scale = 1.0 if std is None or std == 0 else std
        out[c] = (F.col(c).cast("double") - F.lit(mean).cast("double")) / F.lit(scale)
    return df.withColumns(out)
