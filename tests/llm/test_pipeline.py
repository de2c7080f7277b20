"""The pipeline's stages on a hand-made corpus, each against its own input."""

import random
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from ledgerflow.llm import mixing, packing
from ledgerflow.llm.common import staged
from tests_llm_helpers import brute_classes, brute_targets, check_pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A corpus with planted copies, junk and letterless texts, and its labels."""
    rng = random.Random(9)
    sound = {"en": "the ing tion and ea th er on".split(), "fr": "é eau ment ou la è tion le".split()}
    text = lambda lang, n: " ".join("".join(rng.choices(sound[lang], k=rng.randint(1, 4))) for _ in range(n))
    rows, labels = [], []
    for i in range(400):
        lang = rng.choice(["en", "en", "fr"])
        good = rng.random() < 0.8
        body = text(lang, rng.randint(30, 200)) if good else " ".join([text(lang, 1)] * rng.randint(40, 200))
        rows.append([i, body, lang, rng.choice(["a", "a", "b", None])])
        labels.append((i, int(good), 0))
    for i in range(40):
        body = rows[i][1].split()
        if i % 2:
            body[len(body) // 2] = "changed"
        rows.append([1000 + i, " ".join(body), rows[i][2], "c"])
    rows += [[2000, None, None, "a"], [2001, "", "en", "b"], [2002, "12345 !!! 678", None, None], [2003, "....", "fr", "a"]]
    path = tmp_path_factory.mktemp("corpus")
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    quality = {i: q for i, q, _ in labels}
    return str(path), quality | {1000 + i: quality[i] for i in range(40)}


def test_stages(spark, tables):
    path, quality = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = {}
    for name, stage in C.STAGES:
        before = [tuple(r) for r in docs.select(*COLUMNS).collect()]
        docs = staged(stage(spark, docs, path), name)
        seen[name] = before, [tuple(r) for r in docs.collect()]
        if name != "packing":
            assert docs.columns == COLUMNS

    before, after = seen["language_id"]
    assert {r[0] for r in before} - {r[0] for r in after} == {2000, 2001, 2002, 2003} and set(after) <= set(before)

    before, after = seen["quality"]
    gone = {r[0] for r in before} - {r[0] for r in after}
    assert set(after) <= set(before)
    assert sum(quality[i] == 0 for i in gone) >= 0.95 * sum(q == 0 for q in quality.values())
    assert sum(quality[i] == 1 for i in gone) <= 3

    before, after = seen["near_dedup"]
    classes = brute_classes([(r[0], r[1]) for r in sorted(before)])
    assert set(after) <= set(before) and {r[0] for r in after} == set(classes.values())

    before, after = seen["mixing"]
    size = lambda t: len(t.split())
    by_source, taken, texts = defaultdict(int), defaultdict(int), {r[0]: r[1] for r in before}
    for r in before:
        by_source[r[3]] += size(r[1])
    for r in after:
        taken[r[3]] += size(r[1])
        assert r[4] == len(r[1]) and " ".join(texts[r[0]].split()).startswith(" ".join(r[1].split()))
    assert max(Counter(r[0] for r in after).values()) <= 3
    for s, t in brute_targets(by_source).items():
        assert abs(taken[s] - t) <= max(0.02 * t, mixing.BLOCK_WORDS * 16)

    before, _ = seen["packing"]
    tokenizer = Tokenizer.from_file(packing.default_tokenizer_path())
    check_pieces(docs.collect(), [(r[0], r[1]) for r in before], tokenizer, packing.LENGTH)


def test_run_gives_the_last_stage(spark, tables):
    out = C.run(spark, tables[0])
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
