"""SMOTE: lift the minority class to the majority count by interpolating
each minority row toward one of its k nearest minority neighbours.

Neighbours are the true ones, in order of (distance, id), at every size:

* identical vectors are merged first (``groupBy`` on the features, with a
  multiplicity), so a value repeated in a third of the rows is one point;
* distinct points fall into cells around spread-out centres, a cell into blocks
  of at most about ``BLOCK_BYTES``; a block is one row (ids and one binary matrix);
* a block first searches itself, then visits other blocks in rounds, those of the
  nearest cells first, with the points that the triangle inequality (distance to
  the centre, radius of the cell) leaves open; each round keeps the ``k`` best so
  far, and blocks none of whose points are open stop;
* points still open after the rounds meet all blocks that are left, matrix by
  matrix.  Distances that decide are sums from left to right in double precision.

On clustered data a point meets a bounded number of blocks.  Where nothing can be
ruled out, as in many dimensions without clusters, all pairs are compared: ``n``
vectors go to each of ``n / B`` blocks (``B`` points of ``BLOCK_BYTES``: 8192 in 64
dimensions), a visit in a row of its own, ``VISITS`` of them a copy of the block.
Vectors with a null or NaN feature are farthest from all.

Randomness is md5 of ``(id, sample, seed)`` - reproducible, partition
independent, and expressible in SQL for an independent check.  Every
minority row gets ``S // m`` samples; the ``S % m`` rows with the smallest
seeded keys get one more (exact total, chosen with ``select_ranks``).
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.quantiles import select_ranks
from ledgerflow.operators.sampling import hash_key
from ledgerflow.sources.scratch import reliable_checkpoint, staged
from ledgerflow.specs import SEED, SMOTE_NEIGHBOURS

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

BLOCK_BYTES = 4 << 20  # packed vectors of a block
MAX_CENTRES = 4096
ROUNDS = (2, 6)  # blocks that a block visits in each round, before it meets all that are left
VISITS = 16  # visits of a block in one task, when all that are left meet
PAIRS = 1 << 20  # distances in memory at a time, whatever the sizes of two blocks


def md5_unit(*parts: Column) -> Column:
    """A double in [0, 1) from md5 of the parts (32 bits, exact)."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def md5_int(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def distinct_points(rows: DataFrame, vec: str, id_col: str) -> DataFrame:
    """``(vid, vec, mult)``: one point per distinct feature vector."""
    return rows.groupBy(vec).agg(F.min(id_col).alias("vid"), F.count(F.lit(1)).alias("mult"))


def _nearest(k: int):
    """Search in one block: a function that travels to the executors by value."""

    def nearest(x: np.ndarray, limit: np.ndarray, y: np.ndarray, weight: np.ndarray, own: np.ndarray):
        """``(i, j, d2)``: for each row of ``x`` the rows of ``y`` within ``limit`` that fill its
        first ``k`` places (a row counts ``weight`` times), nearest first, then in order of ``y``;
        ``own`` is each row's place in ``y`` (-1 if not there), with the other copies of itself."""
        with np.errstate(all="ignore"):
            middle = np.nan_to_num(y[np.isfinite(y).all(axis=1)].mean(axis=0)) if len(y) else 0.0
            yc = y - middle
            yy = (yc * yc).sum(axis=1)
            widest = np.max(yy[np.isfinite(yy)], initial=0.0)
            out, some_rows = [], max(PAIRS // max(len(y), 1), 1)
            for at in range(0, len(x), some_rows):
                part, mine = x[at:at + some_rows], own[at:at + some_rows]
                xc = part - middle
                xx = (xc * xc).sum(axis=1)
                rough = xx[:, None] + yy[None, :] - 2 * xc @ yc.T
                known = np.isfinite(rough)
                rough[~known] = np.inf
                here = np.flatnonzero(mine >= 0)
                rough[here, mine[here]] = np.inf
                slack = 1e-11 * (xx + widest)
                bound = limit[at:at + some_rows] + slack
                if len(y) > k:
                    bound = np.minimum(bound, np.partition(rough, k - 1, axis=1)[:, k - 1] + 2 * slack)
                bound[~np.isfinite(bound)] = np.inf
                some = (rough <= bound[:, None]) | ~known
                some[here, mine[here]] = weight[mine[here]] > 1
                i, j = np.nonzero(some)
                d2 = np.zeros(len(i))
                for c in range(y.shape[1]):  # left to right, as in SQL
                    step = part[i, c] - y[j, c]
                    d2 += step * step
                d2[np.isnan(d2)] = np.inf
                itself = mine[i] == j
                d2[itself] = 0.0
                within = d2 <= limit[at + i]
                i, j, d2, itself = i[within], j[within], d2[within], itself[within]
                order = np.lexsort((j, d2, i))
                i, j, d2 = i[order], j[order], d2[order]
                w = weight[j] - itself[order]
                before = np.cumsum(w) - w
                first = np.searchsorted(i, i, side="left")
                take = before - before[first] < k
                out.append((at + i[take], j[take], d2[take]))
        return tuple(np.concatenate(p) for p in zip(*out))

    return nearest


def spread_centres(sample: np.ndarray, want: int) -> np.ndarray:
    """``want`` of the sampled vectors, each the farthest from those before it, so
    that every dense region has a centre near by."""
    if len(sample) <= want:
        return sample
    picked = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(picked) < want and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[picked[-1]]) ** 2).sum(axis=1))
    return sample[picked]


class Cells:
    """Cells around centres: which block lies in which cell, and which blocks a point
    may have neighbours in.  Travels to the executors with what uses it."""

    def __init__(self, centres: np.ndarray):
        self.centres = centres
        self.middle = centres.mean(axis=0) if len(centres) else 0.0
        self.shifted = centres - self.middle
        self.norms = (self.shifted * self.shifted).sum(axis=1) if len(centres) else np.zeros(0)

    def fill(self, sizes: dict[int, tuple[int, float]], block_points: int) -> None:
        """``sizes``: cell -> its points, and the radius that holds them."""
        self.cells = np.array(sorted(sizes))
        self.parts = np.array([-(-sizes[c][0] // block_points) for c in self.cells.tolist()])
        self.radius = np.array([sizes[c][1] for c in self.cells.tolist()])
        self.start = np.cumsum(self.parts) - self.parts
        self.cell_of = np.repeat(np.arange(len(self.cells)), self.parts)  # of every block

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """To all centres, and how far off they may be."""
        xc = x - self.middle
        xx = (xc * xc).sum(axis=1)
        d = np.sqrt(np.maximum(xx[:, None] + self.norms[None, :] - 2 * xc @ self.shifted.T, 0))
        return np.where(np.isnan(d), np.inf, d), 1e-5 * np.sqrt(xx + self.norms.max())

    def open(self, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each cell may hold a point within ``bound`` (squared) of each row,
        and how near the cell comes to any row."""
        if not len(self.centres):
            return np.ones((len(x), len(self.cells)), bool), np.zeros(len(self.cells))
        needs, near = [], np.full(len(self.cells), np.inf)
        with np.errstate(all="ignore"):
            for lo in range(0, len(x), 512):
                d, off = self.distances(x[lo:lo + 512])
                low = d[:, self.cells] - self.radius[None, :]
                reach = np.sqrt(bound[lo:lo + 512]) * (1 + 1e-9) + off
                needs.append(~(low > reach[:, None]))
                near = np.minimum(near, np.where(np.isnan(low), 0.0, low).min(axis=0))
        return np.concatenate(needs), near


def _bounds(at: np.ndarray, d2: np.ndarray, w: np.ndarray, rows: int, k: int) -> np.ndarray:
    """Squared distance of each row's ``k``-th neighbour so far."""
    bound = np.full(rows, -np.inf)
    np.maximum.at(bound, at, d2)
    return np.where(np.bincount(at, w, rows) >= k, bound, np.inf)


def _nearest_pairs(points: DataFrame, n: int, k: int, vec: str, dims: int, log: list | None = None) -> DataFrame:
    """``(vid, y_vid, d2, w)``: among them the nearest points that fill the ``k`` slots of each.
    ``log`` takes the number of pairs compared across blocks in each round."""
    spark = points.sparkSession
    kind = points.schema["vid"].dataType.simpleString()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nearest, bounds = _nearest(k), _bounds
    rows = f"vid {kind}, y_vid {kind}, d2 double, w long"
    size = max(BLOCK_BYTES // (8 * max(dims, 1)), 1)
    want = min(-(-4 * n // size), MAX_CENTRES) if n > size else 0
    turn = F.xxhash64("vid")
    drawn = points.select(F.col(vec).alias("_v"), turn.alias("_t")).orderBy("_t").limit(4 * want).collect() if want else []
    drawn = np.array([r["_v"] for r in drawn], np.float64).reshape(-1, dims)
    cells = Cells(spread_centres(drawn[np.isfinite(drawn).all(axis=1)], want))

    def place(batches):
        for pdf in batches:
            some = 512 if len(cells.centres) else len(pdf)
            for lo in range(0, len(pdf), some or 1):
                part = pdf.iloc[lo:lo + some].assign(cell=0, far=np.inf)
                if len(cells.centres):
                    with np.errstate(all="ignore"):
                        d, off = cells.distances(np.array(part["v"].tolist(), np.float64))
                        far = d.min(axis=1) + off
                    part["cell"], part["far"] = d.argmin(axis=1), np.where(np.isnan(far), np.inf, far)
                yield part

    base = points.select("vid", F.col(vec).alias("v"), F.col("mult").cast("long").alias("w"))
    placed = staged(base.mapInPandas(place, f"vid {kind}, v array<double>, w long, cell int, far double"), "placed")
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far"))
    cells.fill({r.cell: (r.n, r.far) for r in sizes.collect()}, size)  # at most MAX_CENTRES rows
    blocks = int(cells.parts.sum())
    pieces = F.element_at(F.create_map(*[F.lit(int(v)) for pair in zip(cells.cells, cells.parts) for v in pair]), F.col("cell")) \
        if cells.parts.max() > 1 else F.lit(1)

    def pack(pdf):
        pdf = pdf.sort_values("vid", ignore_index=True)
        x, w, vids = np.array(pdf["v"].tolist(), "<f8").reshape(-1, dims), pdf["w"].to_numpy(), pdf["vid"].to_numpy()
        i, j, d2 = nearest(x, np.full(len(x), np.inf), x, w, np.arange(len(x)))
        number = int(cells.start[np.searchsorted(cells.cells, pdf["cell"][0])] + pdf["part"][0])
        return pd.DataFrame({"block": [number], "vids": [vids], "w": [w], "vectors": [x.tobytes()],
                             "at": [i], "y": [vids[j]], "d2": [d2], "yw": [w[j] - (i == j)], "seen": [[number]]})

    best_schema = f"at array<int>, y array<{kind}>, d2 array<double>, yw array<long>, seen array<int>"
    packed = placed.withColumn("part", F.pmod(turn, pieces).cast("int")).repartition(tasks, "cell", "part").groupBy("cell", "part")
    packed = staged(packed.applyInPandas(pack, f"block int, vids array<{kind}>, w array<long>, vectors binary, {best_schema}"), "blocks")
    body = packed.select("block", "vids", "w", "vectors")
    best = packed.drop("vids", "w", "vectors")
    visit_schema = f"block int, to int, part int, rows array<int>, x_vids array<{kind}>, x binary, bound array<double>"
    several = -(-blocks // VISITS)

    def visits(limit: int | None) -> DataFrame:
        """A row for each block that some points of a block have yet to meet: these points."""

        def visit(batches):
            for pdf in batches:
                for block, vids, vectors, at, d2, yw, seen in zip(*(pdf[c] for c in ("block", "vids", "vectors", "at", "d2", "yw", "seen"))):
                    x = np.frombuffer(vectors, "<f8").reshape(-1, dims)
                    bound = bounds(at, d2, yw, len(x), k)
                    needs, near = cells.open(x, bound)
                    left = np.setdiff1d(np.flatnonzero(needs.any(axis=0)[cells.cell_of]), seen)
                    for to in left[np.argsort(near[cells.cell_of[left]], kind="stable")][:limit].tolist():
                        some = np.flatnonzero(needs[:, cells.cell_of[to]])
                        yield pd.DataFrame({"block": [block], "to": [to], "part": [block % several], "rows": [some], "x_vids": [vids[some]],
                                            "x": [x[some].tobytes()], "bound": [bound[some]]})

        return body.join(best, "block").select("block", "vids", "vectors", "at", "d2", "yw", "seen").mapInPandas(visit, visit_schema)

    def met(limit: int | None):
        """The visits beside the blocks that they meet."""
        hosts = body.select(F.col("block").alias("to"), F.col("vids").alias("y_vids"), "w", F.col("vectors").alias("y"))
        if limit is None:
            return visits(limit).join(hosts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(several - 1)))), ["to", "part"])
        return visits(limit).join(hosts, "to")

    def compare(r):
        x, y = (np.frombuffer(m, "<f8").reshape(-1, dims) for m in (r.x, r.y))
        return *nearest(x, r.bound, y, r.w, np.full(len(x), -1)), len(x) * len(y)

    def across(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                i, j, d2, pairs = compare(r)
                yield pd.DataFrame({"block": [r.block], "at": [r.rows[i]], "y": [r.y_vids[j]], "d2": [d2], "yw": [r.w[j]],
                                    "seen": [[r.to]], "pairs": [pairs]})

    def merge(pdf, new):
        names = "at", "y", "d2", "yw"
        both = pd.DataFrame({c: np.concatenate([*pdf[c], *new[c]]) for c in names}).sort_values(["at", "d2", "y"])
        upto = both.groupby("at")["yw"].cumsum()
        both = both[upto - both["yw"] < k]
        return pd.DataFrame({"block": pdf["block"], **{c: [both[c].to_numpy()] for c in names}, "seen": [np.concatenate([*pdf["seen"], *new["seen"]])]})

    def unpack(batches):
        for pdf in batches:
            for vids, at, y, d2, yw in zip(*(pdf[c] for c in ("vids", "at", "y", "d2", "yw"))):
                yield pd.DataFrame({"vid": vids[at], "y_vid": y, "d2": d2, "w": yw})

    def rest(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                i, j, d2, _ = compare(r)
                yield pd.DataFrame({"vid": r.x_vids[i], "y_vid": r.y_vids[j], "d2": d2, "w": r.w[j]})

    for limit in ROUNDS if blocks > 1 else ():
        found = staged(met(limit).mapInPandas(across, f"block int, {best_schema}, pairs long"), "met")
        count, pairs = found.agg(F.count(F.lit(1)), F.sum("pairs")).first()
        if log is not None:
            log.append(pairs or 0)
        if not count:
            break
        best = staged(best.groupBy("block").cogroup(found.groupBy(F.col("block").alias("of"))).applyInPandas(
            merge, f"block int, {best_schema}"), "best")
    near = body.join(best, "block").select("vids", "at", "y", "d2", "yw").mapInPandas(unpack, rows)
    if blocks == 1:
        return near
    if log is not None:
        some = visits(None).join(body.select(F.col("block").alias("to"), F.size("vids").alias("n")), "to")
        log.append(some.agg(F.sum(F.size("rows") * F.col("n"))).first()[0] or 0)
    return near.unionByName(met(None).mapInPandas(rest, rows))


def neighbour_slots(points: DataFrame, dims: int, k: int, vec: str = "vec", log: list | None = None) -> DataFrame:
    """``(vid, slot, nvid)``: for every distinct point, its nearest neighbours filling
    slots ``0..k-1`` in order of (distance, vid); a point repeated ``m``
    times has ``m - 1`` copies of itself at distance 0."""
    sizes = points.agg(F.count(F.lit(1)).alias("n"), F.sum("mult").alias("rows")).first()
    if sizes["n"] == 0:
        return points.sparkSession.createDataFrame([], "vid bigint, slot int, nvid bigint")
    k = min(k, int(sizes["rows"]) - 1)
    if k <= 0:  # a single row: its only "neighbour" is itself
        return points.select("vid", F.lit(0).alias("slot"), F.col("vid").alias("nvid"))
    pairs = _nearest_pairs(points, int(sizes["n"]), k, vec, dims, log)
    order = Window.partitionBy("vid").orderBy("d2", "y_vid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = pairs.withColumn("cum", F.sum("w").over(order)).withColumn("before", F.col("cum") - F.col("w"))
    return reliable_checkpoint(ranked.filter(F.col("before") < k).select(
        "vid", F.explode(F.sequence(F.col("before"), F.least(F.col("cum"), F.lit(k)) - 1)).alias("slot"),
        F.col("y_vid").alias("nvid")).withColumn("slot", F.col("slot").cast("int")))


def smote_balance(df: DataFrame, features: Sequence[str], label: str = "label", id_col: str = "id",
                  k: int = SMOTE_NEIGHBOURS, seed: int = SEED) -> DataFrame:
    """Original rows plus synthetic minority rows; adds ``src_id`` (the
    minority row a sample grew from) and ``sample`` (NULL for originals).
    Synthetic rows have a NULL ``id``.  The minority is the smaller class."""
    features = list(features)
    by_class = df.filter(F.col(label).isNotNull()).groupBy(label).count()
    low = by_class.orderBy("count", label).limit(2).collect()
    counts = [(r["count"], r[label]) for r in low]
    if len(counts) == 2:
        counts[1:] = [(by_class.agg(F.max("count")).first()[0], None)]
    base = df.withColumns({"src_id": F.col(id_col), "sample": F.lit(None).cast("int")})
    if len(counts) < 2 or counts[0][0] == counts[-1][0]:
        return base
    (m, minority), (big, _) = counts[0], counts[-1]
    total = big - m
    vec = F.array(*[F.col(c).cast("double") for c in features])
    rows = df.filter(F.col(label) == F.lit(minority)).select(id_col, vec.alias("vec"))
    points = reliable_checkpoint(distinct_points(rows, "vec", id_col))
    slots = neighbour_slots(points, len(features), k)
    kk = slots.agg(F.max("slot")).first()[0] + 1

    per, extra = divmod(total, m)
    keyed = rows.withColumn("_u", hash_key(id_col, seed))
    if extra:
        thr = select_ranks(keyed, [], ["_u", id_col], lambda n: [F.lit(extra)]).first()  # one row
        tu, tid = F.lit(thr["_u"]), F.lit(thr[id_col])
        bonus = (F.col("_u") < tu) | ((F.col("_u") == tu) & (F.col(id_col) <= tid))
        keyed = keyed.withColumn("_s", F.lit(per) + bonus.cast("int"))
    else:
        keyed = keyed.withColumn("_s", F.lit(per))
    # each row's distinct point (null-safe equality of the vectors)
    pv = points.select("vid", F.col("vec").alias("_pvec"))
    with_vid = keyed.join(pv, F.col("vec").eqNullSafe(F.col("_pvec"))).select(id_col, "vid", "_s")
    samples = (with_vid.filter(F.col("_s") > 0)
               .select(id_col, "vid", F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("sample")))
    samples = samples.withColumns({
        "slot": F.pmod(md5_int(F.col(id_col), F.col("sample"), F.lit(seed), F.lit("slot")), F.lit(kk)).cast("int"),
        "gap": md5_unit(F.col(id_col), F.col("sample"), F.lit(seed), F.lit("gap")),
    })
    # both ends of every slot, one row a distinct point and slot: samples then join
    # once, and a hot point is skewed on the side that adaptive execution can split
    xs = points.select("vid", F.col("vec").alias("x_vec"))
    ys = points.select(F.col("vid").alias("nvid"), F.col("vec").alias("n_vec"))
    ends = slots.join(xs, "vid").join(ys, "nvid").select("vid", "slot", "x_vec", "n_vec")
    step = F.zip_with(F.col("x_vec"), F.col("n_vec"), lambda x, y: x + F.col("gap") * (y - x))
    synth = samples.join(ends, ["vid", "slot"]).select(
        F.lit(None).cast(dict(df.dtypes)[id_col]).alias(id_col),
        F.lit(minority).cast(dict(df.dtypes)[label]).alias(label),
        step.alias("_new"), F.col(id_col).alias("src_id"), F.col("sample").cast("int").alias("sample"))
    synth = synth.select(id_col, label, *[F.col("_new")[i].alias(c) for i, c in enumerate(features)],
                         "src_id", "sample")
    other = [c for c in df.columns if c not in (id_col, label, *features)]
    synth = synth.select(*[F.lit(None).cast(dict(df.dtypes)[c]).alias(c) for c in other], *synth.columns)
    return base.unionByName(synth)
