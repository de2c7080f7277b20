import hashlib
import os
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerflow.llm import edit_embedding as E
from ledgerflow.llm.common import SHUFFLE_CLEANUP, recording, shuffles_given_back, staged


def plain_walk(text, walker, w):
    """The embedding written out, one step at a time."""
    bits = np.zeros((E.CLASSES, E.PERIOD), bool)
    stay = walker.stay.reshape(E.WALKS, E.CLASSES, E.PERIOD)[w]
    bits[stay == 1] = True
    out, i, j = [], 0, 0
    while i < len(text):
        c = (ord(text[i]) * 2654435761 % (1 << 32)) >> 26
        out.append(i)
        i += bits[c, j % E.PERIOD]
        j += 1
    return out


def test_fingerprint_samples_the_plain_walk():
    rng = random.Random(1)
    walker = E.Walker()
    texts = ["", "a", "ab", "äö🙂", "aaaa"] + ["".join(rng.choices("abcde fg", k=rng.randint(1, 400))) for _ in range(30)]
    for text, got in zip(texts, walker.prints(texts)):
        assert len(got) == E.WIDTH
        kinds = [(ord(c) * 2654435761 % (1 << 32)) >> 26 for c in text] + [E.CLASSES]
        top = None
        for w in range(E.WALKS):
            line = plain_walk(text, walker, w)
            if top is None:
                top = int(np.log2(max(len(line), 1)))
                assert ord(got[0]) - 48 == top
            for o in range(E.OCTAVES):
                for s in range(E.SAMPLES):
                    have = ord(got[1 + (w * E.OCTAVES + o) * E.SAMPLES + s]) - 48
                    p = walker.places[w, max(top - o, 0), s]
                    if top - o < 0 or p >= len(line):
                        assert have == E.PAD
                    else:
                        assert have == walker.symbol[kinds[line[p]] * (E.CLASSES + 1) + kinds[line[p] + 1]]


def test_likeness_follows_edits():
    rng = random.Random(7)
    walker = E.Walker()
    base = ["".join(rng.choices("etaoin shrdlu", k=1500)) for _ in range(60)]
    few = [t[:700] + "x" + t[702:] for t in base]
    half = [t[:750] + u[:750] for t, u in zip(base, base[1:] + base[:1])]
    p = walker.prints(base)
    near = [np.median(E.likeness(p, q)) for q in (p, walker.prints(few), walker.prints(half), p[1:] + p[:1])]
    assert near[0] == 1 and near[1] > 0.9 and 0.4 < near[2] < 0.6 and near[3] < 0.05


def test_every_document_meets_its_next(spark, documents):
    rng = random.Random(3)
    rows = [(i * 3, "".join(rng.choices("abc dé🙂\n", k=rng.choice([0, 1, 2, 30, 500])))) for i in range(200)]
    rows += [(10_000, None), (10_001, ""), (10_002, rows[5][1]), (10_003, "z" * 60_000), (-4, "first"), (None, "no id")]
    docs = documents(rows).repartition(5).withColumn("piece", F.lit("own")).withColumn("tie", F.lit(1))
    got = {r.doc_id: r for r in E.fingerprint_documents(docs, pieces=7).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    walker = E.Walker()
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = walker.prints([text, changed, following])
        assert (r.fingerprint, r.edited_fingerprint) == (a, b)
        assert abs(r.near_edited - E.likeness([a], [b])[0]) < 1e-12 and abs(r.near_next - E.likeness([a], [c])[0]) < 1e-12
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_one_row_repeats_and_empty(spark, documents):
    assert E.fingerprint_documents(documents([])).count() == 0
    r = E.fingerprint_documents(documents([(1, "abcdef")])).collect()
    assert len(r) == 1 and r[0].near_next == 1.0 and r[0].edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    same = E.fingerprint_documents(documents([(4, "same row")] * 30), pieces=3).collect()
    assert len(same) == 30 and len({x.fingerprint for x in same}) == 1


def test_near_classes(spark, documents):
    rng = random.Random(5)
    base = ["".join(rng.choices("etaoin shrdlu", k=2000)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t[:990] + "q" + t[991:]) for i, t in enumerate(base)]
    rows += [(200 + i, base[0]) for i in range(50)]
    prints = E.fingerprint_documents(documents(rows)).select("doc_id", "fingerprint")
    got = {r.doc_id: r.class_id for r in E.near_classes(prints).collect()}
    assert len(got) == len(rows) and all(got[200 + i] == 0 for i in range(50))
    assert sum(got[100 + i] == i for i in range(20)) >= 18 and all(got[i] == i for i in range(20))


def test_near_copies_whose_hub_is_unlike_them(spark, documents, monkeypatch):
    """Two near copies share a passage (as long as the banded octaves) with a text that comes first."""
    monkeypatch.setattr(E, "BAND_BLOCK", 8, raising=False)
    rng = random.Random(9)
    draw = lambda n: "".join(rng.choices("etaoin shrdlu", k=n))
    passage = draw(1040)
    rows = [(i, passage + draw(860)) for i in range(40)]
    rows += [(95 + i, t[:1700] + "qq" + t[1702:]) for i, t in rows[5:25]]
    prints = E.fingerprint_documents(documents(rows)).select("doc_id", "fingerprint")
    near = {r.doc_id: r.fingerprint for r in prints.collect()}
    got = {r.doc_id: r.class_id for r in E.near_classes(prints).collect()}
    for i in range(20):
        assert (got[100 + i] == got[5 + i]) or E.likeness([near[100 + i]], [near[5 + i]])[0] < E.LIKE
    assert sum(got[100 + i] == 5 + i for i in range(20)) >= 16 and len({got[i] for i in range(40)}) == 40


def test_near_copies_across_powers_of_two(spark, documents):
    rng = random.Random(13)
    walker = E.Walker()
    rows, crossing = [], set()
    for n in range(200, 1400, 10):
        text = "".join(rng.choices("etaoin shrdlu", k=n))
        copy = text + "".join(rng.choices("etaoin shrdlu", k=6))
        a, b = walker.prints([text, copy])
        i = len(rows)
        if E.likeness([a], [b])[0] >= E.LIKE:
            rows += [(i, text), (i + 1, copy)]
            crossing |= {i} if a[0] != b[0] else set()
    for power in (9, 10, 11):  # the longest start of a text whose walk ends below the power, and a few more characters
        for _ in range(12):
            text = "".join(rng.choices("etaoin shrdlu", k=1 << power))
            n = next(n for n in range(len(text) // 3, len(text)) if ord(walker.prints([text[:n]])[0][0]) - 48 >= power)
            a, b = walker.prints([text[:n - 1], text[:n + 6]])
            if a[0] != b[0] and E.likeness([a], [b])[0] >= E.LIKE:
                crossing.add(len(rows))
                rows += [(len(rows), text[:n - 1]), (len(rows) + 1, text[:n + 6])]
    assert len(crossing) >= 20
    prints = E.fingerprint_documents(documents(rows)).select("doc_id", "fingerprint")
    got = {r.doc_id: r.class_id for r in E.near_classes(prints).collect()}
    assert all(got[i + 1] == i for i in crossing)
    assert sum(got[i + 1] == i for i in range(0, len(rows), 2)) >= 0.98 * len(rows) / 2


def test_packed_comparison_equals_the_likeness():
    rng = random.Random(4)
    walker = E.Walker()
    texts = ["", "a", "ab"]
    for n in (5, 60, 500, 1000, 1020, 1030, 2050):  # walks on either side of a power of two
        base = "".join(rng.choices("etaoin shrdlu", k=n))
        for _ in range(25):
            t = list(base)
            for _ in range(rng.choice([0, 1, 3, 12])):
                t[rng.randrange(len(t))] = rng.choice("xyz")
            texts.append("".join(t)[:rng.choice([n, n, n // 2, n - n // 8])])
    prints = sorted(set(walker.prints(texts)))
    codes, packed, links = E._codes(prints), E.Packed(prints), 0
    for i in range(len(prints)):
        others = np.delete(np.arange(len(prints)), i)
        near = E._likeness(np.broadcast_to(codes[i], (len(others), E.WIDTH)), codes[others])
        want = {int(j): v for j, v in zip(others, near) if v >= E.LIKE}
        found, value = packed.near(np.full(len(others), i), others, E.LIKE)
        got = dict(zip(others[found].tolist(), value.tolist()))
        assert got == want
        links += len(want)
    assert links > 100


def test_classes_leave_one_scratch_table_and_no_shuffle_files(spark, documents):
    def shuffle_files():
        return sum(f.startswith("shuffle_") for _, _, files in os.walk(blocks) for f in files)

    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    blocks = [d.getPath() for d in manager.diskBlockManager().localDirs()][0]
    words = [f"w{i}" for i in range(300)]
    docs = documents([(1, " ".join(words)), (2, " ".join([*words[:299], "x"])), (3, "another text"), (4, None)])
    paths = []
    before = shuffle_files(), spark.conf.get(SHUFFLE_CLEANUP)
    with recording(paths):
        with shuffles_given_back(spark):
            prints = staged(E.fingerprint_documents(docs), "prints", codec="zstd")
            found = E.fingerprint_classes(prints.select("doc_id", "fingerprint"))
    assert shuffle_files() <= before[0] and spark.conf.get(SHUFFLE_CLEANUP) == before[1]
    assert [os.path.exists(p.removeprefix("file:")) for p in paths] == [True] + [False] * (len(paths) - 2) + [True]
    assert sorted(r.class_id for r in prints.join(found, "fingerprint").collect()) == [1, 1, 3, 4]
