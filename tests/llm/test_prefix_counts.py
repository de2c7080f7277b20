import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ledgerflow.llm import chunks, prefix_counts

LETTERS = list("abcdeé  \n\t▁　 thinger.,0123456789日本 ﬁ<>s/")
CASES = ["", " ", "  ", "a ", "▁", "x▁ y", "  a  b   c    ", "\n \n y", "<s> </s><unk><0x41>", "a\u0000b", "日本語" * 40, "\U0001f600" * 5,
         *["▁" * n for n in range(2, 40, 3)], *[" " * n + "ab" for n in range(0, 40, 3)], *["a" * n for n in range(1, 50, 4)]]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=prefix_counts.default_model_path())


def sample(n, longest, seed=5):
    rnd = random.Random(seed)
    return CASES + ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(1, longest))) for _ in range(n)]


def test_every_prefix_has_the_count_of_the_library(library, monkeypatch):
    monkeypatch.setattr(prefix_counts, "WINDOW", 300)
    texts = sample(400, 60)
    tokens, fits, stored = prefix_counts.TextCounts(prefix_counts.default_model_path(), 12, True).slice(pa.array(texts))
    for text, n, fit, store in zip(texts, tokens, fits, stored):
        want = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert n == want[-1], text
        assert fit == max(i for i, w in enumerate(want) if w <= 12), text
        got = np.cumsum(np.frombuffer(store, np.int8)).tolist()
        assert got[1:] == want[1:], text


def test_chunks_put_together_give_the_text():
    texts = sample(300, 80)
    distinct, code, bounds = chunks.chunked(pa.array(texts))
    for k, text in enumerate(texts):
        assert "".join(" " + distinct[c] for c in code[bounds[k]:bounds[k + 1]]) == " " + text


def test_slices_hold_a_bounded_number_of_bytes():
    texts = pa.array(["x" * n for n in (5, 1, 30, 0, 4, 4, 4)])
    assert list(chunks.by_bytes(texts, 8)) == [(0, 2), (2, 3), (3, 6), (6, 7)]
    assert list(chunks.by_bytes(pa.array([], pa.string()))) == []


def test_memory_forgets_within_its_bound():
    asked = []
    memory = chunks.Memory(lambda new: asked.append(new) or [c.encode() for c in new], limit=400)
    assert memory(["a", "b"]) == [b"a", b"b"] and memory(["b", "c"]) == [b"b", b"c"] and asked == [["a", "b"], ["c"]]
    assert memory(["a"]) == [b"a"] and asked[-1] == ["a"]


def test_documents(spark, documents, library):
    rows = [(3, None), (None, "a b"), (4, "word " * 3000), (4, "word " * 3000), (5, "")]
    docs = documents(rows).withColumn("n_tokens", F.lit("clash")).withColumn("prefix", F.lit(1))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)
                 for r in prefix_counts.count_tokens(docs, limit=2000).collect())
    n = len(library.encode("word " * 3000))
    assert got == [(-1, 3, len(library.encode("a b")), False), (3, 0, 0, False), (4, 15000, n, True), (4, 15000, n, True), (5, 0, 0, False)]
    assert prefix_counts.count_tokens(documents([])).collect() == []


def test_stored_counts_answer_without_the_model(spark, documents, library):
    texts = [t for t in sample(60, 90, seed=8)]
    table = prefix_counts.count_tokens(documents(list(enumerate(texts))), prefixes=True)
    asked = table.select("doc_id", prefix_counts.tokens_at(F.col("prefix"), F.lit(17)).alias("at"),
                         prefix_counts.longest_within(F.col("prefix"), F.lit(9)).alias("fit"))
    for r in asked.collect():
        text = texts[r.doc_id]
        assert r["at"] == len(library.encode(text[:17]))
        assert r["fit"] == max(i for i in range(len(text) + 1) if len(library.encode(text[:i])) <= 9)
