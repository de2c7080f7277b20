"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A tree is a list of leaves ``(region, rack, shard, weight)``.  A key descends
region -> rack -> shard; at each level it draws one exponential variate per
child (``-ln(u) / weight``, ``u`` from a 64-bit hash of key, level and child)
and follows the smallest.  A child's weight is the sum of the leaf weights
below it.  The draw of a child depends on that child alone, so when weights
change a key moves only within subtrees whose weight changed; a shard added in
a region of its own (``grow``) receives keys and no key moves anywhere else.

Defined cases: a null key hashes like any other value (all null keys share a
shard); a null text has size 1 and CRC 0; equal rows take successive slots;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged, whole_text

Leaf = tuple[int, int, int, float]
BUCKET_ROWS = 100_000  # rows of a shard that are numbered together, about
COPIES = 100_000  # copies of one row that are unfolded together


def balanced_tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 2) -> list[Leaf]:
    """Equal-weight leaves filled rack by rack; rack numbers are global."""
    return [(s // (racks_per_region * shards_per_rack), s // shards_per_rack, s, 1.0) for s in range(shards)]


def grow(tree: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a new region and rack: keys move only into it."""
    return [*tree, (max(l[0] for l in tree) + 1, max(l[1] for l in tree) + 1, max(l[2] for l in tree) + 1, weight)]


def _draw(key: Column, level: str, child: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(child)), 11)
    uniform = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.struct((-F.log(uniform) / F.lit(weight)).alias("cost"), F.lit(child).alias("child"))


def _descend(key: Column, leaves: Sequence[Leaf], depth: int) -> Column:
    weights: dict[int, float] = {}
    for leaf in leaves:
        weights[leaf[depth]] = weights.get(leaf[depth], 0.0) + leaf[3]
    live = sorted((c, w) for c, w in weights.items() if w > 0)
    level = ("region", "rack", "shard")[depth]
    if len(live) == 1:
        chosen = F.lit(live[0][0])
    else:
        chosen = F.array_min(F.array(*[_draw(key, level, c, w) for c, w in live]))["child"]
    if depth == 2:
        return chosen
    below = [(c, _descend(key, [l for l in leaves if l[depth] == c], depth + 1)) for c, _ in live]
    result = below[-1][1]
    for child, expr in reversed(below[:-1]):
        result = F.when(chosen == child, expr).otherwise(result)
    return result


def shard_of(key: Column, tree: Sequence[Leaf]) -> Column:
    """The shard that ``key`` reaches in ``tree`` (int).  Leaves of weight 0
    or less receive nothing."""
    if not any(l[3] > 0 for l in tree):
        raise ValueError("a tree needs a leaf of positive weight")
    return _descend(key, [l for l in tree if l[3] > 0], 0).cast("int")


def shard_documents(docs: DataFrame, tree: Sequence[Leaf], bucket_rows: int = BUCKET_ROWS, copies: int = COPIES) -> DataFrame:
    """One row per document with its shard, its gapless slot there and the
    shard it would have in the grown tree.

    Slots come from two levels: rows fall into hash buckets within a shard (as
    many as the rows ask for), bucket counts give each bucket its first slot, and a
    window numbers the rows of one bucket only.  Equal rows are counted before the
    shuffle and unfolded after it, in runs of ``copies`` that are dealt anew, so a
    repeated row fills neither a window nor a task.
    """
    key = F.col("doc_id")
    text = whole_text()
    rows = docs.select(
        key,
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(key, tree).alias("shard"),
        shard_of(key, grow(tree)).alias("grown_shard"),
    )
    distinct = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    distinct = staged(distinct, "shards")
    slot_buckets = max(-(-distinct.count() // (bucket_rows * max(len(tree), 1))), 1)
    distinct = distinct.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slot_buckets)).cast("int"))

    # a row for each shard and bucket
    buckets = distinct.groupBy("shard", "bucket").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    inside = (Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (distinct.join(buckets, ["shard", "bucket"])
              .withColumn("start", F.col("first") + F.coalesce(F.sum("copies").over(inside), F.lit(0))))
    runs = placed.withColumn("stop", F.col("start") + F.col("copies")).withColumn(
        "run", F.explode(F.sequence(F.col("start"), F.col("stop") - 1, F.lit(copies).cast("long"))))
    runs = runs.repartition("doc_id", "text_crc32", "run")
    return runs.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence(F.col("run"), F.least(F.col("run") + copies, F.col("stop")) - 1)).alias("slot"), "grown_shard")
