import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerflow.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.default_tokenizer_path())


HARD = ["", " ", "plain words here", "don't WE'LL I'M x's 'S 't", "tab\tand\nline\r\nend", "ÄÖÜß straße ñandú ÇÊ œuvre",
        "a b c　d", "x\x1cy\x1dz\x85w", "<|endoftext|> and a<|startoftext|>b", "Ünïcödé é İ ΣΑΣ ß",
        "日本語 текст عربى 🙂👍🏽 ﬁ", "123 4.5e6 ²³¹ ½ ª º µ", "##$$%%--__ ~!@ ''' \"", "­ soft ​ zero", "A" * 300, "ǅ ǆ ŉ ſ K Å"]


def test_encoder_is_exact(tokenizer):
    rng = random.Random(4)
    alphabet = "abc'stXYZ ÄéßñΣİ\n\t\x1c <|>12²½.,!#$日🙂́"
    texts = HARD + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(1500)]
    encoder = P.WordEncoder(P.default_tokenizer_path())
    for _ in range(2):
        got = list(encoder.batch(pa.array(texts), rows=37))
        ids, n = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
        at = 0
        for t, k in zip(texts, n):
            assert ids[at:at + k].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
            at += k
        assert at == len(ids)


def test_known_chunks_are_worked_on_once_within_a_bound():
    asked = []

    def work(chunks):
        asked.extend(chunks)
        return P._joined([[len(c), *map(ord, c)] for c in chunks])

    def ids(chunks):
        flat, start, size = known(pa.array(chunks, pa.string()))
        return [flat[a:a + n].tolist() for a, n in zip(start.tolist(), size.tolist())]

    known = P.Known(work, 4000)
    for chunks in (["a", "bc", ""], ["bc", "é", "a"], [], ["日本", "", "d"]):
        assert ids(chunks) == [[len(c), *map(ord, c)] for c in chunks]
    assert asked == ["a", "bc", "", "é", "日本", "d"]  # each once
    rng = random.Random(8)
    for _ in range(200):
        chunks = list({f"w{rng.randrange(300)}" for _ in range(40)})
        assert ids(chunks) == [[len(c), *map(ord, c)] for c in chunks]
        assert known.held() <= 8000
    assert len(asked) < 200 * 36  # some were known, though all together exceed the bound
    many = [f"long{i}" for i in range(5000)]  # over 4096 at a time
    assert ids(many) == [[len(c), *map(ord, c)] for c in many]
    assert known.held() == 0 and ids(["bc"]) == [[2, 98, 99]]


def test_a_worker_keeps_one_encoder_that_holds_a_bounded_number_of_words():
    encoder = P.worker_encoder(P.default_tokenizer_path())
    assert P.worker_encoder(P.default_tokenizer_path()) is encoder
    rng = random.Random(3)
    for _ in range(6):
        texts = [" ".join("".join(rng.choices("aeioustrn", k=9)) for _ in range(400)) for _ in range(50)]
        encoder.words.limit = 300_000
        (ids, n), = encoder.batch(pa.array(texts))
        assert ids.tolist() == [i for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False) for i in e.ids]
        assert encoder.words.held() <= 2 * encoder.words.limit
    P.worker_encoder.cache_clear()


def test_hilbert_neighbours_are_adjacent_cells():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = P.hilbert_key(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        walk = cells[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check_pieces(out, rows, tokenizer, length):
    want = Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, P.END_ID]
        want[i, len(ids)] += 1
    starts = Counter((r.doc_id, r.doc_tokens) for r in out if r.start == 0)
    assert starts == want
    by_seq, ids_of = defaultdict(list), defaultdict(list)
    for i, t in rows:
        ids_of[i].append([*tokenizer.encode(t or "", add_special_tokens=False).ids, P.END_ID])
    for r in out:
        by_seq[r.sequence_id].append((r.offset, r.length))
        assert any(zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for x in ids_of[r.doc_id])
    total = sum(k * n for (_, k), n in want.items())
    assert sum(r.length for r in out) == total and len(by_seq) == -(-total // length)
    for pieces in by_seq.values():
        at = 0
        for off, n in sorted(pieces):
            assert off == at
            at += n
        assert at <= length
    return by_seq


def test_pieces_cover_every_id_once(spark, documents, tokenizer):
    rng = random.Random(2)
    words = ["the", "and", "Straße", "ñandú", "blehea", "tionre", "x1"]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 40, 300])))) for i in range(150)]
    rows += [(1000 + i, t) for i, t in enumerate(HARD)] + [(2000, None), (3, "same id"), (3, "same id"), (9000, "long " * 30000)]
    docs = documents(rows).withColumn("n", F.lit("own")).withColumn("row", F.lit(0)).withColumn("ids", F.lit(None).cast("int"))
    out = P.pack_documents(docs, length=256).collect()
    check_pieces(out, rows, tokenizer, 256)


def test_similar_documents_lie_together(spark, documents):
    rows = [(i, " ".join([f"{'abcdefgh'[i % 8]}{j}" for j in range(60)])) for i in range(400)]
    out = P.pack_documents(documents(rows), length=4096).collect()
    kinds = defaultdict(set)
    for r in out:
        kinds[r.sequence_id].add(r.doc_id % 8)
    assert sum(map(len, kinds.values())) / len(kinds) < 3


def test_empty_table(spark, documents):
    assert P.pack_documents(documents([])).count() == 0
