import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerflow.llm import rules as R
from ledgerflow.llm.queries import QUERIES


def hit(model, stats):
    z = model.bias + sum(w for conds, w in model.rules if all((stats[n] > c) == above for n, above, c in conds))
    return 1 / (1 + math.exp(-z))


def test_rules_find_a_conjunction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.4) & (x[:, 1] <= 0.7)).astype(float)
    model = R.fit_rules(x, y, ["a", "b", "c"])
    new = rng.random((1000, 3))
    p = np.array([hit(model, dict(zip("abc", row))) for row in new])
    assert ((p > 0.5) == ((new[:, 0] > 0.4) & (new[:, 1] <= 0.7))).mean() > 0.97
    assert 0 < len(model.rules) < 120 and all(len(c) <= R.DEPTH for c, _ in model.rules)


def test_columns_equal_the_rules_written_out(spark, documents):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices("abc DE12!\n#é ", k=rng.randint(0, 200)))) for i in range(150)] + [(900, None), (901, ""), (902, "x" * 200_000)]
    stats = R.statistics(F.coalesce(F.col("text"), F.lit("")))
    names = list(stats)
    cut = lambda n: {"words": 12.0, "word_chars": 3.0, "distinct_words": 0.9}.get(n, 0.08)
    model = R.RuleModel(0.2, [(((n, above, cut(n)),), 0.3 * k - 1) for k, n in enumerate(names) for above in (False, True)]
                        + [((("letters", True, 0.3), ("digits", False, 0.2)), 0.7)])
    docs = documents(rows).withColumn("letters", F.lit("own"))
    out = R.score_documents(docs, model).join(documents(rows).select("doc_id", *[c.alias(f"s_{k}") for k, c in stats.items()]), "doc_id").collect()
    assert len(out) == len(rows) and "letters" in out[0].asDict()
    for r in out:
        assert abs(r.score - hit(model, {n: r[f"s_{n}"] for n in names})) < 1e-12 and 0 <= r.score <= 1


def test_statistics(spark, documents):
    text = "Aa bb aa\nAa bb aa\n1!"
    s = documents([(1, text)]).select(*[c.alias(k) for k, c in R.statistics(F.col("text")).items()]).first().asDict()
    assert s["words"] == 7 and s["distinct_words"] == 4 / 7 and s["distinct_lines"] == 2 / 3 and s["letters"] == 12 / 20
    assert s["capitals"] == 2 / 12 and s["digits"] == 1 / 20 and s["marks"] == 1 / 20


def test_held_out_accuracy_and_folds(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op8_quality"](spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for r in got)
    test = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in test) >= 0.97 * len(test)


def test_labels_of_the_held_out_fold_change_nothing(spark, documents):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["good", "words", "here", "and", "there"], k=40)) if i % 3 else "bad " * 30) for i in range(300)]
    label = lambda flip: spark.createDataFrame([(i, int(bool(i % 3)) ^ int(flip and zlib.crc32(str(i).encode()) % 4 == 2), 0) for i, _ in rows],
                                               "doc_id long, quality int, toxic int")
    a, b = (R.learn(documents(rows).repartition(n), label(flip)) for n, flip in ((2, False), (5, True)))
    assert a == b


def test_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents([(1, "a"), (2, None)])
    assert [r.score for r in R.score_documents(docs, R.learn(docs, none)).collect()] == [0.5, 0.5]
    nulls = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert R.learn(docs, nulls).rules == [] and R.score_documents(documents([]), R.RuleModel(0.0)).count() == 0
