"""Loads that run again, paths that cannot be read, searches that go on, sketches."""

import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import metrics, ml, quantiles
from ledgerflow.plans import daily
from ledgerflow.sources import fixtures, readers, sinks


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_day_loaded_again_leaves_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "runs")
    days = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2")], "id int, v string, run_date string")
    sinks.replace_partitions(days, path, ["run_date"])
    sinks.replace_partitions(days.filter("run_date = 'd1'"), path, ["run_date"])
    back = lambda: rows_of(spark.read.schema(days.schema).parquet(path))
    assert back() == rows_of(days)
    sinks.replace_partitions(days.filter("id = 2"), path, ["run_date"])  # the day now has one row
    assert back() == [(2, "b", "d1"), (3, "c", "d2")]


def test_metadata_step_twice(spark, tmp_path):
    layout = daily.Layout(str(tmp_path))
    for step in ("ingest", "transform"):
        sinks.write_run_doc(spark, {"step": step, "start_time": 1.0, "end_time": 2.0, "duration_sec": 1.0,
                                    "records": {"customer": 3, "payment": 4}}, layout.doc(step))
    first = rows_of(daily.collect_metadata(spark, layout, "2026-01-01"))
    daily.collect_metadata(spark, layout, "2026-01-02")
    assert rows_of(daily.collect_metadata(spark, layout, "2026-01-01")) == first and len(first) == 2
    assert spark.read.parquet(layout.runs_table).count() == 4


def test_broken_files_are_reported_and_the_others_read(spark, tmp_path):
    for i in range(9):
        with gzip.open(tmp_path / f"doc{i}.json.gz", "wt") as f:
            f.write("".join(f'{{"step": "s{i}", "n": {k}}}\n' for k in random.Random(i).sample(range(10**9), 400)))
    for i in (2, 7):
        held = (tmp_path / f"doc{i}.json.gz").read_bytes()
        (tmp_path / f"doc{i}.json.gz").write_bytes(held[:len(held) // 2])
    fixtures.zero_byte_file(spark, str(tmp_path / "nothing.json"))
    (tmp_path / "plain.json").write_text('{"step": "plain"}\n')
    df, skipped = readers.read_run_docs(spark, [str(tmp_path / "*.json*"), str(tmp_path / "absent")])
    assert df.count() == 7 * 400 + 1
    assert [p.rsplit("/", 1)[-1] for p in skipped] == ["absent", "doc2.json.gz", "doc7.json.gz"]
    assert all(r.error for r in readers.skipped_frame(spark, skipped).collect())
    good, bad = readers.readable_files(spark, [str(tmp_path / "plain.json")])
    assert good == [str(tmp_path / "plain.json")] and bad == []


def test_best_run_of_each_name(spark, tmp_path):
    log = str(tmp_path / "log")
    for run, name, auc in (("r1", "a", 0.7), ("r2", "a", 0.9), ("r3", "a", 0.9), ("r4", "b", float("nan")), ("r5", "b", 0.2)):
        sinks.log_training_run(spark, log, run, name, {"depth": 3, "run": run}, {"roc_auc": auc, "n": 1})
    got = {r.run_name: r for r in sinks.best_training_runs(spark.read.parquet(log)).collect()}
    assert (got["a"].run_id, got["a"].value, got["a"].n_runs) == ("r2", 0.9, 3)
    assert got["a"].params == {"depth": "3", "run": "r2"}
    assert (got["b"].run_id, got["b"].n_runs) == ("r5", 1)


def test_merged_sketches_keep_the_rank(spark, tmp_path):
    rng = np.random.default_rng(3)
    values = np.exp(rng.standard_normal(20000) * 2)
    rows = [(int(i % 37), float(v), None if i % 3 else float("nan")) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "day int, v double, gone double")
    path = str(tmp_path / "sketches")
    sinks.replace_partitions(quantiles.daily_sketches(df, "day", ["v", "gone"]), path, ["day"])
    sinks.replace_partitions(quantiles.daily_sketches(df.filter("day < 5"), "day", ["v", "gone"]), path, ["day"])
    stored = spark.read.parquet(path)
    for p in (0.1, 0.5, 0.9):
        got = quantiles.merged_quantile(stored, p).collect()
        assert [(r["column"], r["n"]) for r in got] == [("v", 20000)]
        assert abs((values <= got[0]["quantile"]).mean() - p) < 0.02


def test_auc_of_groups(spark):
    rnd = random.Random(9)
    rows = [(g, int(rnd.random() < 0.4), rnd.randrange(12) / 10) for g in ("a", "b", None) for _ in range(80)] + [("c", 1, 0.5), ("c", None, 0.5)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    got = {r.g: r for r in metrics.roc_auc(df, by=["g"], range_rows=5).collect()}
    for g in ("a", "b", None):
        pos, neg = ([s for h, y, s in rows if h == g and y == want] for want in (1, 0))
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert got[g].roc_auc == pytest.approx(wins / len(pos) / len(neg)) and got[g].n_neg == len(neg)
    assert got["c"].roc_auc is None and got["c"].n_pos == 1


def test_interrupted_grid_search_goes_on(spark, tmp_path, monkeypatch):
    rnd = np.random.default_rng(2)
    x = rnd.integers(0, 6, size=(180, 2))
    df = spark.createDataFrame([(i, int(a + b > 6), float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, label int, f0 double, f1 double")
    fits, plain = [], ml.ResampledClassifier._fit_trees
    monkeypatch.setattr(ml.ResampledClassifier, "_fit_trees", lambda self, *a: fits.append(self.getOrDefault("maxIter")) or plain(self, *a))
    search = lambda rounds: ml.grid_search_folds(
        df, ["f0", "f1"], str(tmp_path / "grid"), {"maxIter": rounds, "maxDepth": [1], "subsamplingRate": [1.0]}, folds=2)
    first = rows_of(search([1]))
    assert fits == [1, 1] and len(first) == 2
    both = rows_of(search([1, 2]))
    assert fits == [1, 1, 2, 2] and both[:2] == first and len(both) == 4
    assert all(0.5 < r[-1] <= 1 for r in both)
