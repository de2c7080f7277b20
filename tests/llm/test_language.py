import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerflow.llm import language as L
from ledgerflow.llm.queries import QUERIES


def plain_grams(text):
    """n-grams of padded words, written out."""
    out = Counter()
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    for w in words:
        p = f"_{w}_"
        out.update(w)
        out.update(p[i:i + 2] for i in range(len(p) - 1))
        out.update(p[i:i + 3] for i in range(len(p) - 2))
    return out


def test_counts_are_those_of_padded_words():
    letters = L.letter_table()
    rng = random.Random(1)
    bins = {}
    for _ in range(200):
        text = "".join(rng.choices("aB cé\n1日𝒳-", k=rng.randint(1, 40)))
        want, got = plain_grams(text), L.gram_counts(text, letters)
        if not want:
            assert got is None
            continue
        assert got.sum() == sum(want.values())
        for g, n in want.items():
            alone = bins.setdefault(g, len(bins))
            assert n >= 1 and alone >= 0
        assert sorted(got[got > 0].tolist()) == sorted(want.values()) or len(want) > len(np.flatnonzero(got))


def test_out_of_place_distance(spark, documents):
    letters = L.letter_table()
    texts = {"x": "abab cdcd abab ef", "y": "zzyy zzyy wwvv"}
    profiles = {k: L.ranked(L.gram_counts(t, letters)).tolist() for k, t in texts.items()}
    out = {r.doc_id: r._l for r in L.identify(documents([(1, texts["x"]), (2, texts["y"]), (3, "ab zz")]), profiles, into="_l").collect()}
    assert (out[1].lang_pred, out[1].score) == ("x", 1.0) and (out[2].lang_pred, out[2].score) == ("y", 1.0)
    mine = L.ranked(L.gram_counts("ab zz", letters)).tolist()
    far = {k: sum(min(abs(p.index(g) - i), L.PROFILE_SIZE) if g in p else L.PROFILE_SIZE for i, g in enumerate(mine)) for k, p in profiles.items()}
    assert abs(out[3].score - (1 - min(far.values()) / (L.PROFILE_SIZE * len(mine)))) < 1e-12


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op10_language"](spark, sf).collect()
    assert len(got) == len(lang) and all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    test = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in test) >= 0.98 * len(test)


def test_defined_cases(spark, documents):
    train = [(i, "der die das und ein " * 5, "de") for i in range(30)] + [(100 + i, "the and of to in " * 5, "en") for i in range(30)]
    docs = documents(train + [(200, None, "en"), (201, "", "en"), (202, "123 .. !", None), (203, "the of " * 40_000, None), (204, "das", None), (204, "das", None)])
    docs = docs.withColumn("score", F.lit("own")).withColumn("language", F.lit(1))
    found = L.identify(docs, L.fit_profiles(docs), into="_found").collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == 66 and [by[i]._found.lang_pred for i in (200, 201, 202)] == ["und"] * 3 and by[202]._found.score == 0.0
    assert by[203]._found.lang_pred == "en" and by[204]._found.lang_pred == "de" and by[203].score == "own"
    empty = documents([])
    assert L.fit_profiles(empty) == {} and L.identify(empty, {}).count() == 0
    assert L.identify(documents([(1, "words")]), {}).first().language.lang_pred == "und"


def test_held_out_rows_and_nulls_teach_nothing(spark, documents):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2][:20]
    docs = documents([(i, "nur diese sprache", "de") for i in held] + [(1000, "no language", None)])
    assert L.fit_profiles(docs) == {}
