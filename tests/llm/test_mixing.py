import math
import random
from collections import Counter, defaultdict

import pytest

from ledgerflow.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), limit=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, free, target = float(sum(sizes.values())), set(order), {}
    while free:
        unit = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * unit >= limit * sizes[s]}
        if not over:
            target |= {s: w[s] * unit for s in free}
            break
        for s in over:
            target[s] = float(limit * sizes[s])
            left -= target[s]
        free -= over
    return target


def test_targets_match_stepwise_resharing(spark):
    rng = random.Random(5)
    for _ in range(6):
        sizes = {f"s{i}": rng.choice([1, 3, 10, 100, 5000]) for i in range(rng.randint(1, 9))}
        if rng.random() < 0.5:
            sizes[None] = 7
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        want = brute_targets(sizes)
        assert all(math.isclose(got[s], want[s], rel_tol=1e-12, abs_tol=1e-9) for s in sizes), (got, want)


def test_apportion_matches_highest_quotients(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for g in range(20):
        votes = [rng.randint(0, 10 ** rng.randint(1, 5)) for _ in range(rng.randint(1, 12))]
        n = rng.randint(0, 60)
        seats = Counter()
        if sum(votes):
            for _ in range(n):
                seats[max(range(len(votes)), key=lambda i: (votes[i] / (seats[i] + 0.5), -i))] += 1
        for i, v in enumerate(votes):
            rows.append((g, i, float(v), n))
            want[g, i] = seats[i]
    df = spark.createDataFrame(rows, "g int, i int, v double, n long")
    got = {(r.g, r.i): r.s for r in mixing.apportion(df, ["g"], "i", "v", "n", "s").collect()}
    assert got == want


def test_mix_reaches_targets_and_repeats(spark, documents):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(0, 400)), "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(900)]
    rows += [(900, None, None, "b"), (901, "", None, "c"), (5, "twice the same", "en", "b"), (5, "twice the same", "en", "b"),
             (None, "no id here", "en", "a")]
    docs = documents(rows)
    out = [tuple(r) for r in mixing.mix_documents(docs).select("row.doc_id", "size", "source_size", "target", "taken").collect()]
    again = [tuple(r) for r in mixing.mix_documents(docs.repartition(7)).select("row.doc_id", "size", "source_size", "target", "taken").collect()]
    assert len(out) == len(rows) and Counter(out) == Counter(again)
    taken, size = defaultdict(int), defaultdict(int)
    for _, n, ssize, target, t in out:
        assert 0 <= t <= 3 * n
        taken[ssize, target] += t
        size[ssize, target] += n
    for (ssize, target), t in taken.items():
        assert size[ssize, target] == ssize and abs(t - target) <= max(0.01 * target, 64 * 8)
    assert abs(sum(taken.values()) - sum(size.values())) < 600


def test_mixed_texts_hold_the_words_taken(spark, documents):
    docs = documents([(i, " ".join(f"w{i}_{j}" for j in range(50 + i)), "en", "abc"[i % 3]) for i in range(60)])
    plan = {r.doc_id: r.taken for r in mixing.mix_documents(docs).select("row.doc_id", "taken").collect()}
    got = defaultdict(int)
    for r in mixing.mixed_texts(docs).collect():
        assert r.n_chars == len(r.text)
        got[r.doc_id] += len(r.text.split())
    assert {k: v for k, v in plan.items() if v} == dict(got)


def test_empty_and_clashing_columns(spark, documents):
    assert mixing.mix_documents(documents([])).count() == 0
    from pyspark.sql import functions as F
    clash = documents([(1, "a b c d e f g h i j", "en", "x"), (2, None, None, None)])
    for name in ("size", "taken", "shard", "row", "line", "target"):
        clash = clash.withColumn(name, F.lit("own"))
    assert mixing.mix_documents(clash).count() == 2
    kept = mixing.mixed_texts(clash)
    assert kept.columns == clash.columns and {r.taken for r in kept.collect()} == {"own"}


@pytest.mark.parametrize("text,n", [("a b c", 2), (" \t\n\r\x0b\x0c", 0), ("x\x1cy", 1), ("", 0)])
def test_word_rule(spark, text, n):
    from pyspark.sql import functions as F
    assert spark.range(1).select(mixing.word_count(F.lit(text)).alias("n")).first().n == n
