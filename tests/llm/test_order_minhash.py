import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerflow.llm import order_minhash as O


def labelled(text):
    w = (text or "").lower().split()
    if not w:
        return []
    seen, out = Counter(), []
    for i in range(max(len(w) - 4, 1)):
        s = tuple(w[i:i + 5])
        out.append((s, seen[s]))
        seen[s] += 1
    return out


def chain(a, b):
    """Longest common subsequence, written out."""
    best = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            here = best[j]
            best[j] = last + 1 if x == y else max(best[j], best[j - 1])
            last = here
    return best[-1]


def brute_classes(rows):
    a = [labelled(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if top(i) == top(j):
                continue
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if not same and a[i] and a[j] and min(len(a[i]), len(a[j])) >= 0.8 * max(len(a[i]), len(a[j])):
                n = chain(a[i], a[j])
                same = n >= 0.8 * (len(a[i]) + len(a[j]) - n)
            if same:
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(top(i), []).append(d)
    return {d: min(least[top(i)]) for i, (d, _) in enumerate(rows)}


def corpus(rng, n=60):
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([5, 6, 30, 120]))] for _ in range(n)]
    texts = [" ".join(b) for b in base]
    for b in base * 2:
        c = list(b)
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            k = rng.randrange(len(c))
            c[k:k + 1] = rng.choice([[], ["new"], [c[k], "extra"]])
        texts.append(" ".join(c))
    texts += [None, "", "  \n", "one", "One", "two words", "the " * 50, "the " * 52, "the " * 70]
    texts += [f"{' '.join(base[3])} " * 6, f"{' '.join(base[3])} " * 7]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_classes_match_brute_force(spark, documents, monkeypatch):
    rng = random.Random(11)
    rows = corpus(rng)
    want = brute_classes(rows)
    for block in (256, 2):
        monkeypatch.setattr(O, "BLOCK", block)
        out = O.near_duplicate_classes(documents(rows).repartition(4)).select("doc.doc_id", "class_id", "kept").collect()
        got = {r.doc_id: r.class_id for r in out}
        # a band may miss a pair near the threshold; nothing else may be linked
        assert all(want[got[d]] == want[d] for d in want)
        assert sum(got[d] != want[d] for d in want) <= 1
        assert all(r.kept == (r.doc_id == r.class_id) for r in out)


def test_words_and_labels_are_exact():
    s = O.Sketcher()
    rng = random.Random(2)
    seen = {}
    with np.errstate(over="ignore"):
        for _ in range(300):
            text = "".join(rng.choices("ab cÄé\n\t ", k=rng.randint(0, 80)))
            want = labelled(" ".join(text.lower().split()))
            got = s.shingles(text)
            assert len(got) == len(want)
            for h, w in zip(got.tolist(), want):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_alignment_is_exact_for_similar_pairs():
    rng = random.Random(3)
    for _ in range(200):
        a = rng.sample(range(500), rng.randint(1, 60))
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            k = rng.randrange(len(b))
            b[k:k + 1] = rng.choice([[], [rng.randrange(500, 900)], [b[k], rng.randrange(900, 2000)]]) if len(b) > 1 else b[k:k + 1]
        if rng.random() < 0.3:
            rng.shuffle(b)
        b = list(dict.fromkeys(b))
        n = chain(a, b)
        want, got = n / (len(a) + len(b) - n), O.aligned(np.array(a), np.array(b))
        assert got <= want + 1e-12 and (want < 0.8 or abs(got - want) < 1e-12)


def test_large_group_of_near_copies(spark, documents):
    rng = random.Random(8)
    base = [f"w{rng.randrange(900)}" for _ in range(150)]
    rows = []
    for i in range(900):
        c = list(base)
        for _ in range(3):
            c[rng.randrange(len(c))] = f"x{i}"
        rows.append((i, " ".join(c)))
    rows += [(5000 + i, " ".join(base)) for i in range(300)] + [(9000, " ".join(f"v{i}" for i in range(90)))]
    out = O.near_duplicate_classes(documents(rows)).select("doc.doc_id", "class_id", "kept").collect()
    assert {r.class_id for r in out} == {0, 9000} and sum(r.kept for r in out) == 2


def test_repeats_empty_and_extra_columns(spark, documents):
    assert O.near_duplicate_classes(documents([])).count() == 0
    docs = documents([(4, "a b c d e f g")] * 3 + [(None, "a b c d e f g"), (2, None), (1, "")]).withColumn("row", F.lit("own")).withColumn("key", F.lit(1))
    out = O.near_duplicate_classes(docs).select("doc.*", "class_id", "kept").collect()
    assert sorted((r.class_id, r.kept) for r in out) == [(1, False), (1, True), (4, False), (4, False), (4, False), (4, True)]
    assert {r.row for r in out} == {"own"} and next(r for r in out if r.kept and r.class_id == 4).doc_id == 4


def test_members_that_their_hub_does_not_connect(spark, documents):
    """One frequent passage puts unlike texts in one cluster; two near copies among
    them are found whatever their hub is like."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join(passage + [f"u{i}_{k}" for k in range(25)])) for i in range(700)]
    pair = passage + [f"z{k}" for k in range(60)]
    rows += [(900, " ".join(pair)), (901, " ".join([*pair[:-1], "other"]))]
    rng.shuffle(rows)
    got = {r.doc_id: r.class_id for r in O.near_duplicate_classes(documents(rows)).select("doc.doc_id", "class_id").collect()}
    assert got[900] == got[901] == 900 and all(got[i] == i for i in range(700))


def test_lower_threshold_takes_more_bands(spark, documents):
    assert O.sketch_plan(0.8) == (O.ROWS, O.BANDS)
    rows, bands = O.sketch_plan(0.6)
    assert rows < O.ROWS and 1 - (1 - 0.6 ** (O.ELL * rows)) ** bands >= 0.99
    rng = random.Random(6)
    texts = []
    for i in range(60):
        a = [f"a{i}_{k}" for k in range(100)]
        b = list(a)
        for k in rng.sample(range(10), 4):
            b[10 * k] = f"b{i}_{k}"  # 5 of 96 shingles each: about 0.65 alike
        texts += [" ".join(a), " ".join(b)]
    got = {r.doc_id: r.class_id for r in O.near_duplicate_classes(documents(list(enumerate(texts))), similar=0.6)
           .select("doc.doc_id", "class_id").collect()}
    assert sum(got[2 * i + 1] == 2 * i for i in range(60)) >= 57
