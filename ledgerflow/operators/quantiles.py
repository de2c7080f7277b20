"""Exact order statistics without a single-task window.

``select_ranks`` returns, per group, the rows at given 1-based ranks of an
ordering.  It never sorts a whole large group in one task:

1. one aggregate pass: the non-null count per group (map-side partials);
2. a group larger than ``max_band`` is bracketed with ``percentile_approx``
   over a fixed probability grid (a bounded, mergeable sketch); one more
   aggregate pass counts the rows below and inside the bracket exactly, so
   a sketch error is detected (that group then falls back to its range);
3. only the verified band - whose size is checked against ``max_band`` - is
   ranked with a window partitioned by group.  A band still above the
   limit is narrowed again from its own sketch, after a reliable
   checkpoint into the session's checkpoint folder.

Groups must be few (feature columns, classes): the per-group plan rows are
collected and broadcast, and their number is checked.  The answer (one row
per requested rank) is returned as a small, already computed frame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.sources.scratch import reliable_checkpoint

GRID = 1000
MAX_TARGETS = 100_000


def _grid() -> list[float]:
    return [i / GRID for i in range(GRID + 1)]


def _key(row, group_cols) -> tuple:
    return tuple(row[g] for g in group_cols)


def select_ranks(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    ranks_fn: Callable[[Column], list[Column]],
    accuracy: int = 10_000,
    max_band: int = 2_000_000,
    max_rounds: int = 8,
) -> DataFrame:
    """Rows at 1-based ranks of ``order_cols`` within each group.

    ``order_cols[0]`` must be numeric; later columns break ties.  Rows whose
    first order column is NULL are ignored.  ``ranks_fn(n)`` gives the rank
    expressions from the group's non-null count ``n`` (ranks outside
    ``1..n`` select nothing).  Output: ``group_cols, rank_idx, rank, n,
    order_cols`` (``rank_idx`` = position in the list ``ranks_fn`` returns).
    Group keys must be non-NULL.  A value repeated more than ``max_band``
    times is answered without ranking its rows: by the value itself, or by
    selecting on the next order column among its rows.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    v = order_cols[0]
    gkey = group_cols or ["_g"]
    cand = df.select(*group_cols, *order_cols).filter(F.col(v).isNotNull())
    if not group_cols:
        cand = cand.withColumn("_g", F.lit(0))
    # the projected candidates are read by every pass: keep them (spilling
    # to disk as needed) for the duration of the selection
    cand = cand.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _select_eager(cand, group_cols, gkey, order_cols, ranks_fn, accuracy, max_band, max_rounds)
    finally:
        cand.unpersist()


def _select_eager(cand, group_cols, gkey, order_cols, ranks_fn, accuracy, max_band, max_rounds) -> DataFrame:
    counts = cand.groupBy(*gkey).agg(F.count(F.lit(1)).alias("n"))
    targets = counts.select(*gkey, "n", F.posexplode(F.array(*[r.cast("long") for r in ranks_fn(F.col("n"))]))
                            .alias("rank_idx", "rank")).filter((F.col("rank") >= 1) & (F.col("rank") <= F.col("n")))
    tgt_rows = [(_key(t, gkey), t["rank_idx"], t["rank"], t["n"]) for t in targets.collect()]
    if len(tgt_rows) > MAX_TARGETS:
        raise ValueError(f"select_ranks: {len(tgt_rows)} targets exceed the bound of {MAX_TARGETS}")
    if not tgt_rows:  # no rows, or no rank inside 1..n
        types = dict(cand.dtypes)
        ddl = ", ".join([f"{g} {types[g]}" for g in group_cols] + ["rank_idx int", "rank long", "n long"]
                        + [f"{c} {types[c]}" for c in order_cols])
        return cand.sparkSession.createDataFrame([], ddl)
    out = _select(cand, gkey, order_cols, [(*t, t[3]) for t in tgt_rows], accuracy, max_band, max_rounds)
    out = out.select(*group_cols, "rank_idx", "rank", "n", *order_cols)
    # at most one row per target (bounded above): return them as a small frame
    return cand.sparkSession.createDataFrame(out.collect(), out.schema)


def _select(cand: DataFrame, gkey: list[str], order_cols: list[str], tgt_rows: list[tuple], accuracy: int,
            max_band: int, max_rounds: int) -> DataFrame:
    """Targets ``(key, rank_idx, rank, n, size)``: ``rank`` is within
    ``cand`` (whose group holds ``size`` rows); ``n`` is only reported.

    Every target is its own problem ``(key, rank_idx)`` with a band
    ``[lo, hi]`` (ends open or closed) on ``v``.  A round sketches the band,
    verifies the bracket with exact counts and keeps only the part that
    holds the rank: the rows equal to ``lo``, strictly between, or equal to
    ``hi`` - so the band shrinks every round even under heavy ties.
    """
    spark = cand.sparkSession
    v = order_cols[0]
    vtype = dict(cand.dtypes)[v]
    gtypes = cand.select(*gkey).dtypes
    pkey = [*gkey, "rank_idx"]
    tdf = spark.createDataFrame([(*k, i, r, n) for k, i, r, n, _ in tgt_rows],
                                ", ".join([f"{g} {t}" for g, t in gtypes] + ["rank_idx int", "rank long", "n long"]))
    # problem -> [rank within band, band size, lo, hi, lo closed, hi closed]
    probs = {(*k, i): [r, size, None, None, True, True] for k, i, r, _, size in tgt_rows}
    widen: set = set()  # problems whose sketch bracket missed: use the full band
    pieces: list[DataFrame] = []
    work = cand.join(F.broadcast(tdf.select(*gkey, "rank_idx")), gkey)

    def band_filter() -> DataFrame:
        rows = [(*p, st[2], st[3], st[4], st[5]) for p, st in probs.items()]
        bdf = spark.createDataFrame(rows, ", ".join([f"{g} {t}" for g, t in gtypes] + [
            "rank_idx int", f"_lo {vtype}", f"_hi {vtype}", "_lc boolean", "_hc boolean"]))
        lo_ok = F.col("_lo").isNull() | (F.col(v) > F.col("_lo")) | (F.col("_lc") & (F.col(v) == F.col("_lo")))
        hi_ok = F.col("_hi").isNull() | (F.col(v) < F.col("_hi")) | (F.col("_hc") & (F.col(v) == F.col("_hi")))
        return work.join(F.broadcast(bdf), pkey).filter(lo_ok & hi_ok).select(*pkey, *order_cols)

    for _ in range(max_rounds):
        big = {p for p, st in probs.items() if st[1] > max_band}
        if not big:
            break
        sketch = work.groupBy(*pkey).agg(F.min(v).alias("vmin"), F.max(v).alias("vmax"),
                                         F.percentile_approx(v, _grid(), accuracy).alias("q"))
        srows = {_key(r, pkey): r for r in sketch.collect()}
        brk = {}
        for p in big:
            st, sk = probs[p], srows[p]
            pos = (st[0] - 1) / max(st[1] - 1, 1) * GRID
            brk[p] = ((sk["vmin"], sk["vmax"]) if p in widen
                      else (sk["q"][max(int(pos) - 2, 0)], sk["q"][min(int(pos) + 3, GRID)]))
        bdf = spark.createDataFrame([(*p, lo, hi) for p, (lo, hi) in brk.items()],
                                    ", ".join([f"{g} {t}" for g, t in gtypes] + [
                                        "rank_idx int", f"_blo {vtype}", f"_bhi {vtype}"]))
        x = work.join(F.broadcast(bdf), pkey)
        crow = {_key(r, pkey): r for r in x.groupBy(*pkey).agg(
            F.count(F.when(F.col(v) < F.col("_blo"), 1)).alias("nb"),
            F.count(F.when(F.col(v) == F.col("_blo"), 1)).alias("nlo"),
            F.count(F.when(F.col(v) == F.col("_bhi"), 1)).alias("nhi"),
            F.count(F.when((F.col(v) >= F.col("_blo")) & (F.col(v) <= F.col("_bhi")), 1)).alias("nin")).collect()}
        missed = {p for p in big if not (crow[p]["nb"] < probs[p][0] <= crow[p]["nb"] + crow[p]["nin"])}
        if missed:  # the sketch missed a rank: bracket those with the full band
            widen |= missed
            continue
        widen.clear()
        for p in big:
            st, c, (lo, hi) = probs[p], crow[p], brk[p]
            local = st[0] - c["nb"]
            if local <= c["nlo"]:
                probs[p] = [local, c["nlo"], lo, lo, True, True]
            elif local > c["nin"] - c["nhi"]:
                probs[p] = [local - (c["nin"] - c["nhi"]), c["nhi"], hi, hi, True, True]
            else:
                probs[p] = [local - c["nlo"], c["nin"] - c["nlo"] - c["nhi"], lo, hi, False, False]
        # a band of one repeated value needs no ranking on v
        for p in [p for p, st in probs.items() if st[1] > max_band and st[2] is not None and st[2] == st[3]]:
            local, size, value = probs.pop(p)[:3]
            key, idx = p[:-1], p[-1]
            rank, n = next((r, nn) for k, i, r, nn, _ in tgt_rows if k == key and i == idx)
            if len(order_cols) == 1:
                ddl = ", ".join([f"{g} {t}" for g, t in gtypes] + ["rank_idx int", "rank long", "n long", f"{v} {vtype}"])
                pieces.append(spark.createDataFrame([(*key, idx, rank, n, value)], ddl))
            else:
                sub = cand.filter(F.col(v) == F.lit(value))
                for g, val in zip(gkey, key):
                    sub = sub.filter(F.col(g) == F.lit(val))
                inner = _select(sub.drop(v), gkey, order_cols[1:], [(key, idx, local, n, size)], accuracy,
                                max_band, max_rounds)
                pieces.append(inner.withColumn("rank", F.lit(rank).cast("long"))
                              .withColumn(v, F.lit(value).cast(vtype)))
        if not probs:
            break
        work = reliable_checkpoint(band_filter())
    else:
        raise RuntimeError("select_ranks: bands did not converge; raise max_band or accuracy")

    if probs:
        band = band_filter() if any(st[2] is not None for st in probs.values()) else work
        w = Window.partitionBy(*pkey).orderBy(*[F.col(c) for c in order_cols])
        local = spark.createDataFrame([(*p, st[0]) for p, st in probs.items()],
                                      ", ".join([f"{g} {t}" for g, t in gtypes] + ["rank_idx int", "_rn int"]))
        hit = band.withColumn("_rn", F.row_number().over(w)).join(F.broadcast(local), [*pkey, "_rn"])
        pieces.append(hit.join(F.broadcast(tdf), pkey).select(*gkey, "rank_idx", "rank", "n", *order_cols))
    out = pieces[0]
    for p in pieces[1:]:
        out = out.unionByName(p.select(*out.columns))
    return out


def exact_medians(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000, max_band: int = 2_000_000) -> DataFrame:
    """One row: the exact median of every listed column (mean of the two
    middle values for an even count; NULL for an all-NULL column; NaN is
    skipped).

    All columns go through the same wide passes over ``df``: counts, a bracket
    of approximate percentiles around each middle, exact counts around the
    bracket (a bracket that misses is not used; one of more than ``max_band``
    rows is bracketed again).  Only rows inside a bracket become (column,
    value) rows, counted per value and accumulated.  One row of numbers a
    pass reaches the driver.
    """
    columns = list(columns)
    spark = df.sparkSession
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    row = df.agg(*[f(value[c]) for c in columns for f in (F.count, F.min, F.max)]).first()
    # column -> [middle ranks, rows below, rows inside, low, high]
    state = {c: [((n + 1) // 2, n // 2 + 1), 0, n, lo, hi]
             for c, (n, lo, hi) in zip(columns, (row[3 * i:3 * i + 3] for i in range(len(columns)))) if n}
    todo = list(state)
    while todo:
        asked = []
        for c in todo:
            (k1, k2), below, inside, lo, hi = state[c]
            at = [max((k1 - below) / inside - 2 / accuracy, 0.0), min((k2 - below) / inside + 2 / accuracy, 1.0)]
            asked.append(F.percentile_approx(F.when(value[c].between(lo, hi), value[c]), at, accuracy))
        brackets = dict(zip(todo, df.agg(*asked).first()))
        counts = df.agg(*[F.count(F.when(cond, 1)) for c in todo for cond in (
            value[c] < brackets[c][0], value[c].between(*brackets[c]))]).first()
        again = []
        for i, c in enumerate(todo):
            below, inside = counts[2 * i:2 * i + 2]
            if below < state[c][0][0] and below + inside >= state[c][0][1]:
                narrower = inside < state[c][2]
                state[c][1:] = [below, inside, *brackets[c]]
                if narrower and inside > max_band and brackets[c][0] < brackets[c][1]:
                    again.append(c)
        todo = again

    inside = [F.struct(F.lit(c).alias("column"), F.when(value[c].between(st[3], st[4]), value[c]).alias("value"))
              for c, st in state.items()]
    medians = dict.fromkeys(columns)
    if inside:
        per_value = (df.select(F.inline(F.array(*inside))).filter(F.col("value").isNotNull())
                     .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
        upto = F.sum("n").over(Window.partitionBy("column").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
        first = F.create_map(*[F.lit(x) for c, st in state.items() for x in (c, st[0][0] - st[1])])[F.col("column")]
        second = F.create_map(*[F.lit(x) for c, st in state.items() for x in (c, st[0][1] - st[1])])[F.col("column")]
        ranked = per_value.withColumn("upto", upto)
        hit = lambda k: (F.col("upto") >= k) & (F.col("upto") - F.col("n") < k)
        for r in ranked.groupBy("column").agg(F.max(F.when(hit(first), F.col("value"))).alias("a"),
                                              F.max(F.when(hit(second), F.col("value"))).alias("b")).collect():
            medians[r["column"]] = (r["a"] + r["b"]) / 2
    return spark.createDataFrame([tuple(medians[c] for c in columns)], ", ".join(f"`{c}` double" for c in columns))


SKETCH_K = 400


def daily_sketches(df: DataFrame, day: str, columns: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """``(day, column, n, sketch)``: a mergeable KLL sketch of every column and day.
    Stored by day, a new day costs its own rows only (NaN and NULL are skipped)."""
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    aggs = [F.struct(F.lit(c).alias("column"), F.count(value[c]).alias("n"), F.kll_sketch_agg_double(value[c], k).alias("sketch"))
            for c in columns]
    return df.groupBy(F.col(day).alias("day")).agg(F.array(*aggs).alias("all")).select("day", F.inline("all"))


def merged_quantile(sketches: DataFrame, probability: float = 0.5) -> DataFrame:
    """``(column, n, quantile)`` of all days together: the days' sketches merged.  The
    rank error is that of one sketch of all rows (below 1 % for ``SKETCH_K``)."""
    merged = sketches.filter("n > 0").groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select("column", "n", F.kll_sketch_get_quantile_double("sketch", F.lit(probability)).alias("quantile"))
