import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerflow.llm import hash_tree as H


def test_rows_slots_and_growth(spark, documents):
    rows = [(i, f"text {i % 50}") for i in range(4000)] + [(7, "same")] * 900 + [(None, None), (1, ""), (2, "äöü€")]
    out = H.shard_documents(documents(rows), H.balanced_tree(8), bucket_rows=40, copies=70).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, of_key = defaultdict(list), defaultdict(set)
    for r in out:
        assert r.law == "key" and 0 <= r.shard <= 7 and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
        of_key[r.doc_id].add((r.shard, r.grown_shard))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(v) == 1 for v in of_key.values())
    share = Counter(next(iter(v))[0] for k, v in of_key.items())
    assert len(share) == 8 and max(share.values()) < 1.3 * 4001 / 8
    moved = sum(next(iter(v))[1] == 8 for v in of_key.values())
    assert 0.07 < moved / len(of_key) < 0.16


def test_movement_stays_in_changed_subtrees(spark):
    old = H.balanced_tree(8)
    new = [(*l[:3], 3.0 if l[2] == 2 else l[3]) for l in old]
    got = spark.range(20000).select(H.shard_of(F.col("id"), old).alias("a"), H.shard_of(F.col("id"), new).alias("b")).collect()
    moves = Counter((r.a, r.b) for r in got if r.a != r.b)
    # shard 2 grew: keys enter its region, its rack and itself; no key leaves them
    assert moves and all(not (a in (0, 1, 2, 3) and b > 3) and not (a in (2, 3) and b in (0, 1)) and a != 2 for a, b in moves)
    assert not any(a > 3 and b > 3 for a, b in moves) and (0, 1) not in moves and (1, 0) not in moves


def test_weights_and_empty(spark, documents):
    tree = [(0, 0, 0, 3.0), (0, 0, 1, 1.0), (1, 1, 2, 0.0)]
    n = Counter(r.s for r in spark.range(8000).select(H.shard_of(F.col("id"), tree).alias("s")).collect())
    assert set(n) == {0, 1} and 0.72 < n[0] / 8000 < 0.78
    assert H.shard_documents(documents([]), H.balanced_tree(8)).count() == 0
    clash = documents([(1, "a"), (2, "b")]).withColumn("shard", F.lit("x")).withColumn("size", F.lit(None).cast("int"))
    assert H.shard_documents(clash, H.balanced_tree(3)).count() == 2


def test_shards_equal_a_walk_down_the_tree(spark):
    """The drawn shard, walked down in plain Python from the hashes of one key at a time."""
    tree = [(0, 0, 0, 1.0), (0, 0, 1, 2.0), (0, 1, 2, 1.0), (1, 2, 3, 0.5), (1, 2, 4, 1.0), (2, 3, 5, 1.5)]
    keys = [*range(300), -5, 1 << 60, None]
    levels = ("region", "rack", "shard")
    asked = spark.createDataFrame([(k,) for k in keys], "k long").select("k", H.shard_of(F.col("k"), tree).alias("got"), *[
        F.xxhash64(F.col("k"), F.lit(level), F.lit(c)).alias(f"{level}{c}") for d, level in enumerate(levels) for c in {l[d] for l in tree}])
    for r in asked.collect():
        left = tree
        for d, level in enumerate(levels):
            cost = {}
            for c in {l[d] for l in left}:
                uniform = (((r[f"{level}{c}"] & (1 << 64) - 1) >> 11) + 0.5) / (1 << 53)
                cost[c] = -math.log(uniform) / sum(l[3] for l in left if l[d] == c)
            left = [l for l in left if l[d] == min(cost, key=cost.get)]
        assert r.got == left[0][2]
