import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import metrics, sampling
from ledgerflow.operators.quantiles import exact_medians, select_ranks


@pytest.mark.parametrize("max_band", [5, 1_000_000])
def test_select_ranks_matches_sorting(spark, max_band):
    rnd = random.Random(7)
    rows = [(g, float(rnd.randint(0, 40)), i) for i in range(600) for g in ["a", "b"][i % 2:i % 2 + 1]]
    df = spark.createDataFrame(rows, "g string, v double, i long")
    got = select_ranks(df, ["g"], ["v", "i"], lambda n: [F.lit(1), F.floor(n / 3), n], max_band=max_band).collect()
    for r in got:
        ordered = sorted((v, i) for g, v, i in rows if g == r.g)
        assert (r.v, r.i) == ordered[r.rank - 1]
    assert len(got) == 6


def test_exact_medians_match_numpy(spark):
    rnd = np.random.default_rng(3)
    a = rnd.normal(size=301)
    b = rnd.integers(0, 9, size=301).astype(float)
    b[::7] = np.nan
    pdf = [(float(x), None if np.isnan(y) else float(y)) for x, y in zip(a, b)]
    df = spark.createDataFrame(pdf, "a double, b double")
    got = exact_medians(df, ["a", "b"], max_band=20).first()
    assert got.a == pytest.approx(float(np.median(a)))
    assert got.b == pytest.approx(float(np.nanmedian(b)))


def test_roc_auc_matches_pairwise_count_with_ties(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 15))) for _ in range(400)]
    pos = [s for l, s in rows if l == 1]
    neg = [s for l, s in rows if l == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "label int, score double")
    got = metrics.roc_auc(df, range_rows=3).first()
    assert got.roc_auc == pytest.approx(brute) and got.n_pos == len(pos)


def test_report_and_confusion(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (1, 1)], "label int, prediction int")
    cm = {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 2, (1, 0): 1, (1, 1): 2}
    other = spark.createDataFrame([(1, 2), (None, 1)], "label int, prediction int")
    assert {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(other).collect()} == {(1, 2): 1, (None, 1): 1}
    rep = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert rep["1"].precision == 1.0 and rep["1"].recall == pytest.approx(2 / 3)
    assert rep["accuracy"].f1_score == pytest.approx(0.8) and rep["accuracy"].support == 5
    assert rep["0"].f1_score == pytest.approx(0.8)


def test_stratified_split_exact_sizes_and_repeatable(spark):
    df = spark.range(1003).select(F.col("id"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    out = sampling.stratified_split(df)
    sizes = {(r.label, r.split): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert sizes[(1, "test")] == round(0.2 * 201) and sizes[(0, "test")] == round(0.2 * 802)
    again = sampling.stratified_split(df.repartition(7))
    assert sorted(out.collect()) == sorted(again.collect())


def test_standardise_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, c double")
    out = sampling.standardise(df, ["a", "c"]).collect()
    assert [round(r.a, 6) for r in out] == [round(-1 / np.std([1, 2, 3]), 6), 0.0, round(1 / np.std([1, 2, 3]), 6)]
    assert [r.c for r in out] == [0.0, 0.0, 0.0]


def test_select_ranks_hot_value_larger_than_band(spark):
    # a third of the rows share one value: the band cannot narrow on it
    rows = [(7.0 if i % 3 == 0 else float(i), i) for i in range(300)]
    df = spark.createDataFrame(rows, "v double, i long")
    got = select_ranks(df, [], ["v", "i"], lambda n: [F.lit(5), F.lit(20), F.lit(150)], max_band=10).collect()
    ordered = sorted(rows)
    assert sorted((r.rank, r.v, r.i) for r in got) == [(k, *ordered[k - 1]) for k in (5, 20, 150)]
    med = exact_medians(spark.createDataFrame([(float(i % 3),) for i in range(301)], "a double"), ["a"],
                        max_band=10).first()
    assert med.a == 1.0


def test_edge_cases(spark):
    from ledgerflow.operators import features

    empty = spark.createDataFrame([], "g string, v double")
    assert select_ranks(empty, ["g"], ["v"], lambda n: [F.lit(1)]).collect() == []
    nulls = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert exact_medians(nulls, ["a", "b"]).first().asDict() == {"a": None, "b": 1.5}
    assert [r.a for r in features.impute_median(nulls, ["a", "b"]).collect()] == [None, None]
    one_class = spark.createDataFrame([(1, 1, 0.3)], "id long, label int, score double")
    assert metrics.roc_auc(one_class).first().roc_auc is None
    tiny = sampling.stratified_split(spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id long, label int"))
    assert {r.split for r in tiny.collect()} == {"train"}  # round(0.2 * n) = 0 per class


def test_report_zero_division_counts_as_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "label int, prediction int")
    rep = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert (rep["1"].precision, rep["1"].recall, rep["1"].f1_score, rep["1"].support) == (0.0, 0.0, 0.0, 1)
    assert rep["macro avg"].precision == pytest.approx((2 / 3) / 2)
