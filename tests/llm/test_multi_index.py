import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import multi_index as M

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """vec_id (unique) -> (n_links, component) by comparing all pairs."""
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows
          if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    link = {i: set() for i, _, _ in rows}
    for a, (i, x) in enumerate(ok):
        for j, y in ok[:a]:
            if len(x) == len(y) and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.9:
                link[i].add(j)
                link[j].add(i)
    out = {}
    for i in sorted(link):
        if i in out:
            continue
        todo, seen = [i], {i}
        while todo:
            for j in link[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out |= {j: i for j in seen}
    return {i: (len(link[i]), out[i]) for i in link}


def noisy(rng, n, dim=16, clusters=30, noise=0.02):
    centres = rng.standard_normal((clusters, dim))
    rows = []
    for i in range(n):
        x = centres[rng.integers(clusters)] if rng.random() < 0.6 else rng.standard_normal(dim)
        rows.append((i, (x + noise * rng.standard_normal(dim)).tolist(), 0))
    return rows


def found(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_links_match_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = noisy(rng, 500)
    rows += [(1000 + i, rows[3][1], 1) for i in range(40)]
    rows += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [1.0] * 15 + [float("nan")], 0), (2003, [1.0] * 15 + [float("inf")], 0),
             (2004, [1.0] * 15 + [None], 0), (2005, [], 0), (2006, [1.0, 0.0], 0), (2007, [2.0, 0.0], 0), (2008, [5.0], 0), (2009, [3e38] * 16, 0)]
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for cell_rows, block in ((16, 8), (128, 512)):
        monkeypatch.setattr(M, "BLOCK", block)
        monkeypatch.setattr(M.fit_grids, "__defaults__", (cell_rows, M.SEED))
        got = found(M.near_duplicates(df))
        assert set(got) == set(want)
        assert all(got[i][0] <= want[i][0] for i in want)  # nothing below the threshold
        assert sum(g[0] for g in got.values()) >= 0.95 * sum(w[0] for w in want.values())
        if cell_rows == 128:
            assert got == want


def test_traversal_is_the_nearest_cells():
    rng = np.random.default_rng(2)
    grid = M.Grid((rng.standard_normal((7, 3)), rng.standard_normal((5, 4))))
    x = M._unit(rng.standard_normal((50, 7)))
    d1, d2 = grid.distances(x)
    every = (d1[:, :, None] + d2[:, None, :]).reshape(50, -1)
    for n in (1, 4, 12, 35, 99):
        assert (grid.traverse(x, n) == np.argsort(every, axis=1, kind="stable")[:, :n]).all()


def test_edge_tables(spark):
    assert M.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    one = M.near_duplicates(spark.createDataFrame([(5, [1.0, 2.0], 0)], SCHEMA)).collect()
    assert [tuple(r) for r in one] == [(5, 0, 5, True)]
    twice = spark.createDataFrame([(5, [1.0, 2.0], 0), (5, [1.0, 2.0], 0), (4, [2.0, 4.0], 0), (None, [1.0, 2.0], 0)], SCHEMA)
    twice = twice.withColumn("key", F.lit(1)).withColumn("node", F.lit("x"))
    got = sorted((tuple(r) for r in M.near_duplicates(twice).collect()), key=str)
    assert got == [(4, 2, 4, True), (5, 2, 4, False), (5, 2, 4, False), (None, 0, None, True)]


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query_recall_on_planted_copies(spark, sf):
    base = [(r.vec_id, list(r.embedding), 0) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    rng = np.random.default_rng(4)
    rows = base + [(10_000 + i, (np.array(v) + 0.03 * rng.standard_normal(len(v))).tolist(), 0) for i, v, _ in base[:200]]
    want, got = brute(rows), found(M.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    assert sum(g[0] for g in got.values()) >= 0.9 * sum(w[0] for w in want.values()) > 0


@pytest.mark.parametrize("hot, paired", [(0, 0.02), (0, 0.1), (2700, 0.1)])
def test_recall_of_sparse_pairs_beside_a_hot_group(spark, monkeypatch, hot, paired):
    """400 cells or more (k >= 20): pairs across cells are found whatever else there is."""
    rng = np.random.default_rng(6)
    n, dim = 8000, 64
    x = rng.standard_normal((n, dim))
    x[:hot] = rng.standard_normal(dim) + 0.1 * rng.standard_normal((hot, dim))
    pairs = int(n * paired / 2)
    a = np.arange(hot, hot + pairs)
    x[a + pairs] = x[a] + rng.uniform(0.3, 0.45, (pairs, 1)) * rng.standard_normal((pairs, dim))
    u = x / np.sqrt((x * x).sum(1))[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    want = near.sum(1)
    monkeypatch.setattr(M.fit_grids, "__defaults__", (16, M.SEED))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(u)], "vec_id long, embedding array<double>, label int").repartition(8)
    got = found(M.near_duplicates(df))
    got = np.array([got[i][0] for i in range(n)])
    small = (want > 0) & (np.arange(n) >= hot)
    assert small.sum() > 0.8 * 2 * pairs and (got <= want).all()
    for part in (small, (want > 0) & ~small):
        assert not part.any() or (got[part] / want[part]).mean() >= 0.98
