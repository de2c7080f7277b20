"""Embedding near-duplicates with an inverted multi-index.

Unit vectors are cut in half; each half has its own k-means codebook, and the
two code words of a vector name its cell in the product grid.  A vector visits
the grid's cells in order of summed distance to its halves (the multi-sequence
order) and meets the members of the first ``visits`` cells; every pair that
meets is verified by its cosine in double precision.

How many cells to visit is measured, not guessed, for each vector length: a
bounded sample of vectors is compared with all rows, and ``visits`` is the rank
within which the target share of the true links of those with a partner in
another cell lies, with each vector weighing the same and with each group of
like vectors weighing the same.  The rank is seen from one side; a pair also
meets if the other side visits, so the share found is at least that.  Codebooks are fitted on a bounded sample whose
size follows the square root of the number of vectors; every row is indexed.

Equal vectors are one class with a multiplicity.  A pair whose members visit
each other's cells is counted in the smaller cell only.  Large cells are dealt
in blocks, so no task holds more than a few blocks; a task returns one row per
vector (its links there, and the least vector it is connected to), never pairs.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component, and rows without an id, link with nothing; vectors of different
length do not link; repeated rows are separate vectors; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged
from ledgerflow.llm.components import components

THRESHOLD = 0.9
TARGET_RECALL = 0.99
CELL_ROWS = 128
BLOCK = 512
MIN_VISITS = 4
MAX_CALIBRATION = 1024  # vectors asked at first
CROSSING = 200  # draw more until so many groups have a partner in another cell
MAX_QUERIES = 16384  # or so many vectors are asked
SEED = 5
DISTANCES = 4_000_000  # held at a time


@dataclass
class Grid:
    """Codebooks of both halves (``k`` words each) for vectors of one length."""

    words: tuple[np.ndarray, np.ndarray]

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = unit.shape[1] // 2
        return tuple(((x * x).sum(1)[:, None] - 2 * x @ w.T + (w * w).sum(1)[None, :])
                     for x, w in ((unit[:, :half], self.words[0]), (unit[:, half:], self.words[1])))

    def traverse(self, unit: np.ndarray, visits: int) -> np.ndarray:
        """The nearest ``visits`` cells of each vector, nearest first.

        With both codebooks in order of distance, the n-th cell of the
        multi-sequence order has ``(a + 1) * (b + 1) <= n``: only that staircase
        is looked at, so only that many words of a half are sorted; a bounded number
        of distances at a time."""
        k1, k2 = (len(w) for w in self.words)
        visits = min(visits, k1 * k2)
        a, b = np.array([(a, b) for a in range(min(k1, visits)) for b in range(min(k2, visits // (a + 1)))]).T
        rows = max(DISTANCES // max(k1, k2, len(a)), 1)
        out = np.empty((len(unit), visits), np.int64)
        for at in range(0, len(unit), rows):
            d1, d2 = self.distances(unit[at:at + rows])
            o1, o2 = (_least(d, visits) for d in (d1, d2))
            total = np.take_along_axis(d1, o1[:, a], 1) + np.take_along_axis(d2, o2[:, b], 1)
            cells = o1[:, a] * k2 + o2[:, b]
            first = np.lexsort((cells, total), axis=1)[:, :visits]
            out[at:at + rows] = np.take_along_axis(cells, first, 1)
        return out


def _least(d: np.ndarray, n: int) -> np.ndarray:
    """Columns of the ``n`` least values of each row, in order (ties by column)."""
    if n >= d.shape[1]:
        return np.argsort(d, axis=1, kind="stable")
    some = np.sort(np.argpartition(d, n - 1, axis=1)[:, :n], axis=1)
    return np.take_along_axis(some, np.argsort(np.take_along_axis(d, some, 1), axis=1, kind="stable"), 1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    words = x[rng.choice(len(x), k, replace=False)]
    rows = max(DISTANCES // k, 1)
    for _ in range(rounds):
        near = np.concatenate([((words * words).sum(1)[None, :] - 2 * x[at:at + rows] @ words.T).argmin(1) for at in range(0, len(x), rows)])
        count = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, column, k) for column in x.T], axis=1)
        words = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], words)
    return words


def _unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return x / np.sqrt((x * x).sum(1))[:, None]


def fit_grids(classes: DataFrame, cell_rows: int = CELL_ROWS, seed: int = SEED) -> dict[int, Grid]:
    """A grid for each vector length.  ``k = sqrt(vectors / cell_rows)`` code words
    a half, fitted on about ``40 k`` (at least 2000) vectors."""
    grids = {}
    for dim, n in sorted((r.dim, r.n) for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()):
        k = max(1, round(math.sqrt(n / cell_rows)))
        want = max(2000, 40 * k)
        chance = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sample = classes.filter((F.col("dim") == dim) & (chance < F.lit(want / n))).select("key", "vector").toPandas()
        if not len(sample):
            sample = classes.filter(F.col("dim") == dim).select("key", "vector").limit(1).toPandas()
        unit = _unit(sample.sort_values("key")["vector"])
        half, rng = dim // 2, np.random.default_rng(seed)
        k = min(k, len(unit))
        grids[dim] = Grid(tuple(_kmeans(x, k, rng) if x.shape[1] else np.zeros((1, 0)) for x in (unit[:, :half], unit[:, half:])))
    return grids


def _links_of(classes: DataFrame, grids: dict[int, Grid], asked: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """``dim, q, cell, n``: links of the asked vectors to others, by the cell of the other
    one; ``q`` counts the asked vectors of a length."""
    queries = {dim: (_unit(part["vector"]), part["key"].to_numpy()) for dim, part in asked.groupby("dim")}

    def compare(batches):
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                if dim not in queries:
                    continue
                ask, keys = queries[dim]
                place = {key: q for q, key in enumerate(keys)}
                unit, own = _unit(part["vector"]), np.array([place.get(key, -1) for key in part["key"]])
                cell = grids[dim].traverse(unit, 1)[:, 0]
                rows = max(1, (1 << 22) // len(ask))
                for at in range(0, len(unit), rows):
                    near = unit[at:at + rows] @ ask.T >= threshold
                    here = np.flatnonzero(own[at:at + rows] >= 0)
                    near[here, own[at + here]] = False  # a vector is no partner of its own
                    row, q = np.nonzero(near)
                    if len(row):
                        found = pd.DataFrame({"dim": dim, "q": q, "cell": cell[at + row]})
                        yield found.groupby(["dim", "q", "cell"]).size().reset_index(name="n")

    return (classes.select("key", "vector", "dim").mapInPandas(compare, "dim int, q int, cell long, n long")
            .groupBy("dim", "q", "cell").agg(F.sum("n").alias("n")).toPandas())


def calibrate(classes: DataFrame, grids: dict[int, Grid], threshold: float = THRESHOLD,
              target: float = TARGET_RECALL) -> dict[int, int]:
    """Cells to visit for each vector length: the rank within which ``target`` of the true
    links of asked vectors lie, at least ``MIN_VISITS``.  Vectors with all partners in their
    own cell say nothing and are left out; about ``MAX_CALIBRATION`` vectors are asked, then
    four times as many, until ``CROSSING`` groups (or ``MAX_QUERIES`` vectors, or all) are seen."""
    visits = {}
    turn = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    for dim, grid in grids.items():
        mine = classes.filter(F.col("dim") == dim)
        n, low, want = mine.count(), 0.0, MAX_CALIBRATION
        ranks, evenly, by_group = [], [], []
        while True:
            high = min(want / n, 1.0)
            asked = mine.filter((turn >= F.lit(low)) & (turn < F.lit(high))).select("key", "vector", "dim").toPandas()
            links = _links_of(mine, {dim: grid}, asked, threshold) if len(asked) else pd.DataFrame(columns=["q", "cell", "n"])
            unit = _unit(asked["vector"]) if len(asked) else None
            for q, part in links.groupby("q"):
                d1, d2 = grid.distances(unit[int(q):int(q) + 1])
                total = (d1[0][:, None] + d2[0][None, :]).reshape(-1)
                all_ranks = [1 + int((total < total[cell]).sum()) for cell in part["cell"]]
                if max(all_ranks) == 1:
                    continue
                share = part["n"].to_numpy() / part["n"].sum()
                ranks += all_ranks
                evenly += share.tolist()
                by_group += (share * 2 / (1 + part["n"].sum())).tolist()
            if high >= 1 or want >= MAX_QUERIES or sum(by_group) >= CROSSING:
                break
            low, want = high, min(4 * want, MAX_QUERIES)
        visits[dim] = MIN_VISITS
        order = np.argsort(ranks, kind="stable")
        for weights in (evenly, by_group) if ranks else ():
            seen = np.cumsum(np.array(weights)[order])
            at = min(int(np.searchsorted(seen, target * seen[-1])), len(order) - 1)
            visits[dim] = max(visits[dim], ranks[order[at]])
    return visits


def _meet(threshold: float):
    """Verify all pairs that meet in one group of blocks."""

    def meet(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, _, low, high, part = key
        unit = _unit(pdf["vector"])
        node, weight = pdf["node"].to_numpy(), pdf["weight"].to_numpy()
        member = (pdf["kind"] == 0).to_numpy()
        block = pdf["block"].to_numpy()
        cell, visited = pdf["own"].to_numpy(), np.stack(pdf["visits"].to_numpy())
        links = np.zeros(len(pdf), np.int64)
        right = np.flatnonzero(member & (block == high))
        edges = []
        for at in range(0, len(pdf), BLOCK):
            left = np.arange(at, min(at + BLOCK, len(pdf)))
            near = unit[left] @ unit[right].T >= threshold
            # members of the same cell: pairs of two blocks, or within one block once
            inside = (block[left][:, None] == low) & ((low != high) | ((part == 0) & (left[:, None] < right[None, :])))
            # a visitor: unless the member's own visit is the one that counts
            mutual = np.zeros(near.shape, bool)
            for t in range(visited.shape[1]):
                mutual |= visited[right, t][None, :] == cell[left][:, None]
            outside = (part >= 0) & ~(mutual & (cell[left][:, None] < cell[right][None, :]))
            near &= np.where(member[left][:, None], inside, outside)
            links[left] += near @ weight[right]
            np.add.at(links, right, weight[left] @ near)
            # each vector's edge to the least one it is connected to in this block
            a, b = np.nonzero(near)
            a, b = left[a], right[b]
            root = node.copy()
            while True:
                both = np.minimum(root[a], root[b])
                if (both == root[a]).all() and (both == root[b]).all():
                    break
                np.minimum.at(root, a, both)
                np.minimum.at(root, b, both)
            moved = root != node
            edges.append(pd.DataFrame({"node": node[moved], "links": 0, "root": root[moved]}))
        some = links > 0
        counts = pd.DataFrame({"node": node[some], "links": links[some], "root": node[some]})
        return pd.concat([counts, *edges], ignore_index=True).drop_duplicates()

    return meet


def link_classes(classes: DataFrame, grids: dict[int, Grid], visits: dict[int, int], threshold: float = THRESHOLD) -> DataFrame:
    """``node, links, root``: partial link counts, and an edge of the node's component."""

    def index(batches):
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                cells = grids[dim].traverse(_unit(part["vector"]), visits[dim])
                yield pd.DataFrame({"node": part["node"], "dim": dim, "weight": part["weight"], "vector": part["vector"],
                                    "own": cells[:, 0], "visits": list(cells[:, 1:].astype(np.int64))})

    indexed = staged(classes.select("node", "dim", "weight", "vector").mapInPandas(
        index, "node long, dim int, weight long, vector array<double>, own long, visits array<long>"), "indexed")
    seen = indexed.select("dim", "own", F.explode(F.concat(F.array(F.lit(-1).cast("long")), "visits")).alias("to")).select(
        "dim", F.when(F.col("to") < 0, F.col("own")).otherwise(F.col("to")).alias("cell"), (F.col("to") < 0).cast("int").alias("member"))
    load = seen.groupBy("dim", "cell").agg(F.sum("member").alias("members"), F.sum(1 - F.col("member")).alias("visitors"))
    blocks = lambda n: F.ceil(F.col(n) / F.lit(float(BLOCK))).cast("int")
    load = staged(load.filter("members > 0").select("dim", "cell", blocks("members").alias("m"),
                                                    F.greatest(blocks("visitors"), F.lit(1)).alias("v")), "load")

    turn = F.xxhash64("node")
    one = F.col("node"), F.col("dim"), F.col("weight"), F.col("vector"), F.col("own"), F.col("visits")
    members = indexed.withColumn("cell", F.col("own")).join(load, ["dim", "cell"]).withColumn("block", F.pmod(turn, F.col("m")).cast("int"))
    others = F.transform(F.filter(F.sequence(F.lit(0), F.col("m") - 1), lambda j: j != F.col("block")),
                         lambda j: F.struct(F.least(j, F.col("block")).alias("low"), F.greatest(j, F.col("block")).alias("high"),
                                            F.lit(-1).alias("part")))
    diagonal = F.transform(F.sequence(F.lit(0), F.col("v") - 1),
                           lambda u: F.struct(F.col("block").alias("low"), F.col("block").alias("high"), u.alias("part")))
    members = members.select(*one, "cell", "block", F.lit(0).alias("kind"), F.explode(F.concat(others, diagonal)).alias("to"))
    visitors = indexed.withColumn("cell", F.explode("visits")).join(load, ["dim", "cell"])
    each = F.transform(F.sequence(F.lit(0), F.col("m") - 1),
                       lambda j: F.struct(j.alias("low"), j.alias("high"), F.pmod(turn, F.col("v")).cast("int").alias("part")))
    visitors = visitors.select(*one, "cell", F.lit(-1).alias("block"), F.lit(1).alias("kind"), F.explode(each).alias("to"))
    dealt = members.unionByName(visitors).select("*", "to.*").drop("to")
    return staged(dealt.groupBy("dim", "cell", "low", "high", "part").applyInPandas(
        _meet(threshold), "node long, links long, root long"), "links")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> DataFrame:
    """``(vec_id, embedding)`` -> ``vec_id, n_links, component_id, kept``."""
    v = F.col("embedding")
    good = (F.col("vec_id").isNotNull() & v.isNotNull()
            & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
            & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))
    rows = staged(vectors.select("vec_id", "embedding").withColumn("key", F.when(good, F.sha2(v.cast("string"), 256))), "vectors")
    classes = rows.filter("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"),
        F.first(F.col("embedding").cast("array<double>")).alias("vector"))
    classes = staged(classes.withColumn("dim", F.size("vector")).withColumn("node", F.monotonically_increasing_id()), "classes")

    grids = fit_grids(classes)
    links = link_classes(classes, grids, calibrate(classes, grids, threshold, target), threshold)
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    told = (classes.select("key", "node", "weight", "least").join(counts, "node", "left").join(joined, "node", "left")
            .withColumn("component", F.coalesce("component", "node")))
    ids = told.groupBy("component").agg(F.min("least").alias("component_id"))
    told = told.join(ids, "component").select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    return rows.drop("embedding").join(told, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"))
