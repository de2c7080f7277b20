import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import ml, smote


def brute_slots(points, k):
    out = {}
    for vid, vec, mult in points:
        cands = [(0.0, vid, mult - 1)] if mult > 1 else []
        for v2, vec2, m2 in points:
            if v2 != vid:
                cands.append((float(sum((a - b) * (a - b) for a, b in zip(vec, vec2))), v2, m2))
        cands.sort()
        slots, filled = [], 0
        for d, v2, w in cands:
            for _ in range(w):
                if filled < k:
                    slots.append(v2)
                    filled += 1
        out[vid] = slots
    return out


def gaussian_points(spark, n, dims, seed=5):
    rnd = random.Random(seed)
    rows = [(i, [9.0] * dims if i % 10 == 0 else [round(rnd.gauss(0, 1), 3) for _ in range(dims)]) for i in range(n)]
    return smote.distinct_points(spark.createDataFrame(rows, "id long, vec array<double>"), "vec", "id")


def slots_of(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.vid, {})[r.slot] = r.nvid
    return {v: [s[i] for i in range(len(s))] for v, s in got.items()}


def test_slots_with_duplicates(spark):
    points = gaussian_points(spark, 120, 4)
    want = brute_slots([(r.vid, r.vec, r.mult) for r in points.collect()], 5)
    assert slots_of(smote.neighbour_slots(points, 4, 5)) == want


@pytest.mark.parametrize("dims, clusters", [(23, 0), (64, 0), (64, 40)])
def test_neighbours_are_the_true_ones(spark, monkeypatch, dims, clusters):
    monkeypatch.setattr(smote, "BLOCK_BYTES", 8 * dims * 256)
    monkeypatch.setattr(smote, "VISITS", 3)
    rng = np.random.default_rng(11)
    x = np.round(rng.standard_normal((4000, dims)), 3)
    if clusters:
        x = np.round(x * 0.3 + 3 * rng.standard_normal((clusters, dims))[rng.integers(0, clusters, len(x))], 3)
    x[::50] = x[0]  # a hot vector
    points = smote.distinct_points(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>"), "vec", "id")
    rows = sorted((r.vid, r.mult) for r in points.collect())
    ids, mult = np.array(rows).T
    y = x[ids]
    want = {}
    for i, v in enumerate(ids):
        d2 = ((y - y[i]) ** 2).sum(axis=1)
        w = mult - (np.arange(len(ids)) == i)
        order = np.lexsort((ids, d2))
        want[int(v)] = np.repeat(ids[order], w[order])[:5].tolist()
    assert slots_of(smote.neighbour_slots(points, dims, 5)) == want


def test_neighbours_without_finite_features_come_last(spark, monkeypatch):
    monkeypatch.setattr(smote, "BLOCK_BYTES", 64)
    rows = [(i, [float(i), 0.0]) for i in range(20)] + [(20, [None, 1.0]), (21, [float("nan"), 2.0])]
    points = smote.distinct_points(spark.createDataFrame(rows, "id long, vec array<double>"), "vec", "id")
    got = slots_of(smote.neighbour_slots(points, 2, 3))
    assert got[0] == [1, 2, 3] and got[10] == [9, 11, 8] and got[20] == got[21] == [0, 1, 2]


def test_pairs_grow_with_the_points_on_clustered_data(spark, monkeypatch):
    monkeypatch.setattr(smote, "BLOCK_BYTES", 8 * 16 * 128)
    per_point = []
    for n in (2000, 8000):
        rng = np.random.default_rng(7)
        clusters = 10 * rng.standard_normal((n // 50, 16))
        x = clusters[np.arange(n) % len(clusters)] + 0.1 * rng.standard_normal((n, 16))
        points = smote.distinct_points(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>"), "vec", "id")
        log = []
        got = slots_of(smote.neighbour_slots(points, 16, 5, log=log))
        per_point.append(sum(log) / n)
        for i in range(0, n, 97):
            d2 = ((x - x[i]) ** 2).sum(axis=1)
            d2[i] = np.inf
            assert got[i] == np.argsort(d2, kind="stable")[:5].tolist()
    assert per_point[1] < 1.5 * per_point[0] + 50


def test_blocks_travel_in_bounded_batches(spark):
    """Rows of several MB reach Python a few at a time, not ten thousand."""
    rows = spark.range(40).repartition(1).selectExpr("id", "cast(repeat('x', 4000000) as binary) as m")

    def sizes(batches):
        for pdf in batches:
            yield pdf.assign(n=len(pdf))[["n"]]

    assert max(r.n for r in rows.mapInPandas(sizes, "n long").collect()) <= 32


def test_smote_balances_and_interpolates(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, int(i % 4 == 0), float(x), float(y)) for i, (x, y) in enumerate(rnd.normal(size=(203, 2)))]
    df = spark.createDataFrame(rows, "id long, label int, a double, b double")
    out = smote.smote_balance(df, ["a", "b"])
    counts = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0] == counts[1] == 152
    synth = out.filter(F.col("sample").isNotNull())
    assert synth.filter(F.col("id").isNotNull()).count() == 0
    lo = [min(r[c] for r in rows if r[1] == 1) for c in (2, 3)]
    hi = [max(r[c] for r in rows if r[1] == 1) for c in (2, 3)]
    for r in synth.collect():  # inside the minority's bounding box
        assert lo[0] - 1e-9 <= r.a <= hi[0] + 1e-9 and lo[1] - 1e-9 <= r.b <= hi[1] + 1e-9


def test_grid_search_applies_grid_and_predicts(spark):
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(240, 3))
    y = ((x[:, 0] + 0.5 * x[:, 1]) > 0.8).astype(int)
    df = spark.createDataFrame([(i, int(l), *map(float, v)) for i, (l, v) in enumerate(zip(y, x))],
                               "id long, label int, f0 double, f1 double, f2 double")
    cv = ml.grid_search(df, ["f0", "f1", "f2"], grid={"maxIter": [3], "maxDepth": [1, 3]}, parallelism=2)
    assert len(set(round(m, 9) for m in cv.avgMetrics)) == 2  # the grid really changes the model
    assert ml.best_params(cv)["maxDepth"] in (1, 3)
    pred = ml.predict(cv.bestModel, df)
    assert pred.count() == 240 and pred.filter("score < 0 or score > 1").count() == 0
    top = ml.top_importances(cv.bestModel, ["f0", "f1", "f2"], spark, k=2).collect()
    assert len(top) == 2 and top[0].importance >= top[1].importance


def test_folds_are_stratified(spark):
    from ledgerflow.operators.sampling import fold_column

    df = spark.range(1000).select("id", (F.col("id") % 7 == 0).cast("int").alias("label"))
    got = {}
    for r in fold_column(df, folds=3).groupBy("label", "fold").count().collect():
        got.setdefault(r.label, {})[r.fold] = r["count"]
    for label, sizes in got.items():
        assert set(sizes) == {0, 1, 2} and max(sizes.values()) - min(sizes.values()) <= 1, (label, sizes)


def test_saved_model_scores_raw_rows(spark, tmp_path):
    rnd = np.random.default_rng(3)
    x = rnd.normal(loc=50, scale=9, size=(120, 2))
    df = spark.createDataFrame([(i, int(v[0] > 55), *map(float, v)) for i, v in enumerate(x)], "id long, label int, f0 double, f1 double")
    model = ml.ResampledClassifier(featureCols=["f0", "f1"], maxIter=2, maxDepth=1).fit(df)
    ml.save_resampled(model, str(tmp_path / "m"))
    again = ml.load_resampled(spark, str(tmp_path / "m"))
    key = lambda d: sorted((r.id, r.prediction, round(r.score, 12)) for r in d.collect())
    assert key(ml.predict(again, df)) == key(ml.predict(model, df))


def test_grid_search_resamples_once_a_fold(spark, monkeypatch):
    calls = []
    plain = ml.smote_balance
    monkeypatch.setattr(ml, "smote_balance", lambda *a, **k: calls.append(1) or plain(*a, **k))
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(150, 2))
    df = spark.createDataFrame([(i, int(v[0] > 0.7), *map(float, v)) for i, v in enumerate(x)], "id long, label int, f0 double, f1 double")
    ml.grid_search(df, ["f0", "f1"], grid={"maxIter": [1, 2], "maxDepth": [1]}, folds=2, parallelism=2)
    assert len(calls) == 3  # two folds, and the best point on all rows


def test_block_search_holds_a_bounded_number_of_distances():
    rng = np.random.default_rng(3)
    x, y = rng.random((300, 2)), rng.random((40_000, 2))
    tracemalloc.start()
    i, j, d2 = smote._nearest(5)(x, np.full(len(x), np.inf), y, np.ones(len(y), np.int64), np.full(len(x), -1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * 8 * smote.PAIRS  # 256 rows at a time, whatever the block, took 175 MB
    true = ((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2)
    assert (j.reshape(-1, 5) == np.argsort(true, axis=1)[:, :5]).all()
