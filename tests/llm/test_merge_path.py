import copy
import hashlib
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import merge_path

LETTERS = list("abcdeé  \n\t　 thinger.,0123456789日本 ﬁ<>s/'")


@pytest.fixture(scope="module")
def both():
    return merge_path.Vocabularies(*merge_path.default_paths())


def brute(both, rows):
    """doc_id -> the contract's row, text by text with the libraries alone."""
    found, counts = [], Counter()
    for doc, text in rows:
        text = text or ""
        a = both.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = both.b.encode(text) if text else []
        groups, links = [], []
        sides = [[t[i] for i in ids] for t, ids in ((both.a_bytes, a), (both.b_bytes, b))]
        if not text or any(b"".join(s) != (" " + text).encode() for s in sides):
            a, b = [], []
        else:
            ends = [np.cumsum([len(t) for t in s]).tolist() for s in sides]
            i = j = 0
            for end in sorted(set(ends[0]) & set(ends[1])):
                k, m = ends[0].index(end) + 1, ends[1].index(end) + 1
                groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
                links.append((a[k - 1], b[m - 1]))
                i, j = k, m
        counts.update(links)
        found.append((doc, len(a), len(b), groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted((doc, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                   hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "") for doc, n_a, n_b, groups, links in found)


def some_rows():
    rnd = random.Random(3)
    rows = [(k, "".join(rnd.choice(LETTERS) for _ in range(rnd.randint(1, 200)))) for k in range(120)]
    rows += [(200 + k, t) for k, t in enumerate(["", None, " ", "  ", "x▁y", "<|endoftext|> a <s>", "a\u0000b", " " * 30, "a ", "\n", "the same", "the same"])]
    return rows + [(300, "a long text of many words, " * 60)]


@pytest.mark.parametrize("piece, batch", [(merge_path.PIECE, merge_path.BATCH_TOKENS), (50, 900), (7, 300)])
def test_rows_equal_brute_force_whatever_the_pieces(spark, documents, both, piece, batch):
    rows = some_rows()
    got = merge_path.align(documents(rows).repartition(3), piece, batch).collect()
    assert sorted(map(tuple, got)) == brute(both, rows)


class Asked:
    """A's tokenizer, noting how many texts it is given at a time; ``crossing`` makes one
    token too few of the first text of several."""

    def __init__(self, tokenizer, crossing=False):
        self.tokenizer, self.crossing, self.texts = tokenizer, crossing, []

    def encode_batch_fast(self, texts, **kw):
        self.texts.append(len(texts))
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, **kw)]
        if self.crossing and len(self.texts) == 1:
            found[0] = found[0][:-1]
        return [SimpleNamespace(ids=ids) for ids in found]


@pytest.mark.parametrize("crossing", [False, True])
def test_chunks_are_encoded_as_one_text_and_come_out_as_one_by_one(both, crossing):
    rnd = random.Random(11)
    closed = sorted({"".join(rnd.choice([c for c in LETTERS if not c.isspace()]) for _ in range(rnd.randint(1, 12))) for _ in range(500)})
    closed += ["<|endoftext|>", "<s>", "\nabc", "\n \nx", "don't", "ﬁn", "a\u0000b", "e\u0301", "\u0301e", "²."]
    open_end = ["", "a\n", "x\u3000", "x▁", "▁"]
    chunks = closed + open_end
    rnd.shuffle(chunks)
    want = []
    for c in chunks:
        a, b = both.a.encode(" " + c, add_special_tokens=False).ids, both.b.encode(c) if c else [both.space]
        good = all(b"".join(t[i] for i in ids) == (" " + c).encode() for t, ids in ((both.a_bytes, a), (both.b_bytes, b)))
        want.append([int(good), len(a), *a, *b])
    assert {w[0] for w in want} == {0, 1}
    vocabularies = copy.copy(both)
    vocabularies.a = Asked(both.a, crossing)
    flat, size = vocabularies.encode(chunks)
    assert [x.tolist() for x in np.split(flat, np.cumsum(size)[:-1])] == want
    assert vocabularies.a.texts == [1 + len(open_end)] + [len(chunks)] * crossing
    for c, w in zip(chunks[:40], want):  # alone, open or closed, given back or not
        flat, size = both.encode([c])
        assert flat.tolist() == w and size.tolist() == [len(w)]


def test_given_back_compares_chunk_by_chunk():
    token, length = [b"a", b"bc", b"d"], np.array([1, 2, 1])
    for raw, size, want in ((b"abcd", [3, 1], [True, True]), (b"abcx", [3, 1], [True, False]), (b"axcd", [3, 1], [False, True]),
                            (b"abcd", [2, 2], [False, False]), (b"abcdd", [3, 2], [True, False]), (b"xxxx", [3, 1], [False, False])):
        assert merge_path.given_back(np.array([0, 1, 2]), np.array([2, 1]), token, length, raw, np.array(size)).tolist() == want


def test_tasks_without_rows_load_no_vocabulary(spark, documents):
    docs = documents([(1, "a b"), (2, "c")])
    missing = ("/nowhere/a.json", "/nowhere/b.model")
    assert merge_path.align(docs.filter("doc_id > 2"), paths=missing).collect() == []


def test_diagonals_divide_the_merge():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        a, b = (np.cumsum(rnd.integers(1, 4, n)) for n in rnd.integers(0, 30, 2))
        merged = sorted([(e, 0) for e in a.tolist()] + [(e, 1) for e in b.tolist()])
        places = np.arange(len(merged) + 1)
        want = [sum(side == 0 for _, side in merged[:p]) for p in places]
        assert merge_path.diagonals(a, b, places).tolist() == want


def test_pieces_are_equal_work():
    rnd = np.random.default_rng(4)
    a, b = rnd.integers(0, 9, 1000), rnd.integers(0, 9, 700)
    parts = merge_path.partition(a, b, np.arange(1, 1001) * 7, np.arange(1, 701) * 10, 100)
    assert [len(p[2]) + len(p[3]) for p in parts] == [100] * 17
    assert np.array_equal(np.concatenate([p[2] for p in parts]), a) and np.array_equal(np.concatenate([p[3] for p in parts]), b)


def test_defined_cases(spark, documents):
    docs = documents([(None, "one two"), (7, None), (7, "one two")]).withColumn("a", F.lit(0)).withColumn("row", F.lit("x"))
    got = {r.doc_id: r for r in merge_path.align(docs.filter("text is not null")).collect()}
    assert got[None].groups_sha256 == got[7].groups_sha256 and got[7].count_sum == 2 * got[7].n_links
    empty = merge_path.align(docs.filter("text is null")).first()
    assert tuple(empty) == (7, 0, 0, 0, 0, 0, 0, "")
    assert merge_path.align(documents([])).collect() == []


def test_groups_themselves(spark, documents, both):
    text = "Überall waren 3,14 Wörter\nzu finden."
    r = merge_path.aligned_groups(documents([(1, text)])).first()
    raw = (" " + text).encode()
    assert b"".join(both.a_bytes[i] for i in r.a_ids) == raw == b"".join(both.b_bytes[i] for i in r.b_ids)
    assert r.links[-1].end == len(raw) and all(x.end < y.end for x, y in zip(r.links, r.links[1:]))
