import re
from collections import defaultdict
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from ledgerflow.llm import filter_audit

LONG = " ".join(f"word{i}" for i in range(60))
ROWS = [(1, LONG, None, "a"), (2, LONG, None, "b"), (2, LONG, None, "a"), (3, LONG + " $", None, "a"), (4, "word " * 60, None, "a"),
        (5, LONG.upper(), None, None), (6, None, None, ""), (7, "", None, "b"), (None, LONG, None, "b"), (8, "A|B " * 70, None, "b"),
        (9, LONG, None, "a"), (10, "few words", None, "c"), (11, "few words", None, "c"), (11, "few words", None, "c")]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, 0, 1), (8, 1, 1), (9, 1, 0), (99, 1, 1), (None, 1, 1), (10, None, 1)]


def brute(rows, labels):
    good, toxic = ({d for d, *flags in labels if flags[i] == 1 and d is not None} for i in (0, 1))
    texts = defaultdict(list)
    for d, t, *_ in rows:
        if d is not None:
            texts[t or ""].append(d)
    parts = defaultdict(list)
    for d, t, _, source in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, no in (("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
                                 ("C", 100 * len(re.findall("[A-Z]", t)) > 5 * len(t)), ("D", bool(re.search("[#$%&*|]", t))),
                                 ("E", d is not None and min(texts[t]) < d)) if no}
        parts[source or ""].append((fails, d in good, d in toxic))
    out = {}
    for part, docs in parts.items():
        shapley = defaultdict(int)
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                kept = [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                out[part, order, step] = [len(kept), len(gone), sum(f in x[0] for x in docs) - len(gone), sum(x[0] == {f} for x in docs),
                                          sum(x[1] for x in gone), sum(x[2] for x in gone)]
                left = kept
        for order, step in [(o, s) for p, o, s in out if p == part]:
            out[part, order, step].append(shapley[order[step - 1]])
    return out


def test_counts_equal_brute_force(spark, documents):
    docs = documents(ROWS).withColumn("mask", F.lit("clash")).withColumn("good", F.lit(3))
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs.repartition(5), labels).collect()
    want = brute(ROWS, LABELS)
    assert len(got) == len(want) == 600 * 4
    for r in got:
        assert list(r[3:]) == want[r.part, r.filter_order, r.step], r


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents([]), labels).collect() == []
    rows = filter_audit.audit(documents([(1, "x", None, "s")]), labels).collect()
    assert len(rows) == 600 and all(r.good_lost == r.toxic_lost == 0 for r in rows)


def test_fields_do_not_run_over():
    counters = filter_audit.Counters()
    many = (1 << 62) + 12345
    total = counters.packed[0b00011] * many + counters.packed[0b10000] * (many - 7)
    got = counters.unpack(total)
    one, other = counters.unpack(counters.packed[0b00011]), counters.unpack(counters.packed[0b10000])
    assert got.shape == (600, 3) and np.array_equal(got, one * many + other * (many - 7))
    for mask in range(32):  # a document is kept or removed once, or was removed before
        fields = counters.unpack(counters.packed[mask]).reshape(120, 5, 3)
        assert (fields[:, :, 1].sum(axis=1) == (mask > 0)).all() and (fields[:, -1, 0] == (mask == 0)).all()


def test_hot_text_and_part_are_counted_before_they_meet(spark, documents):
    docs = documents([(i, LONG if i % 3 else f"{LONG} {i}", None, "hot") for i in range(3000)])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["mask"]: r.n for r in filter_audit.mask_counts(docs, labels).collect()}
    assert got == {0: 1001, 16: 1999}
