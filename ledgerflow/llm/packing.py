"""Packing along a space-filling curve.

1. Every document is tokenised once (ids plus the end id); its hashed token
   vector is projected to ``DIMS`` dimensions by a fixed random matrix.
2. Each dimension is cut into ``2 ** BITS`` cells of equal weight (approximate
   quantiles over all documents); the cell indices give a Hilbert key.
3. Rows (without their ids) are range-sorted by key; a prefix sum of lengths
   lays all documents end to end along the curve, so neighbours on the curve
   share sequences.  Copies share a key; a hash of the row divides them among
   ranges.
4. Every ``length`` ids begin a new sequence, so only the last one is padded;
   documents are cut where a sequence ends.

Defined cases: null text is the empty text (one piece, the end id alone);
repeated rows are documents of their own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.chunks import by_bytes, gather
from ledgerflow.llm.common import staged, whole_text

LENGTH = 2048
END_ID = 1
DIMS, BITS = 4, 8
HASHED = 1024
SEED = 11
SLICE_BYTES = 8_000_000
CACHE_BYTES, OTHERS_BYTES = 24_000_000, 8_000_000
TOKENIZER = "word_bpe_49k.json"

#: one word of Latin letters, with or without a closing mark
PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?$"


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1
    characters stand for themselves, the other bytes for 256 and up, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {b: chr(b) for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + i)
    return table


def _joined(found: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids end to end, and their lengths."""
    flat, size = array("I"), []
    for ids in found:
        flat.extend(ids)
        size.append(len(ids))
    return np.array(flat, np.uint32), np.array(size, np.int64)


class Known:
    """Ids of chunks seen before: the chunks in one Arrow array, their ids end to end in
    another.  Beyond a bound of bytes only those that are asked for just now stay, and
    not even those where they are more than twice the bound."""

    def __init__(self, work: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int):
        self.work, self.limit = work, limit
        self.known: pa.Array | None = None
        self.flat, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def held(self) -> int:
        return 0 if self.known is None else self.known.nbytes + self.flat.nbytes + self.size.nbytes

    def __call__(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and where those of each of some different chunks start and how many they are."""
        if self.known is None:
            self.known = chunks.slice(0, 0)
        at = pc.fill_null(pc.index_in(chunks, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        old = at >= 0
        if self.held() > self.limit:
            kept = at[old]
            start = np.cumsum(self.size) - self.size
            self.flat, self.size = gather(self.flat, start[kept], self.size[kept]), self.size[kept]
            self.known = chunks.filter(pa.array(old))
            at[old] = np.arange(len(kept))
        new = chunks.filter(pa.array(~old))
        if len(new):
            at[~old] = len(self.size) + np.arange(len(new))
            flat, size = zip(*[self.work(new.slice(lo, 4096).to_pylist()) for lo in range(0, len(new), 4096)])
            self.flat = np.concatenate([self.flat, *flat])
            self.size = np.concatenate([self.size, *size])
            self.known = pa.concat_arrays([self.known, new])
        found = self.flat, (np.cumsum(self.size) - self.size)[at], self.size[at]
        if self.held() > 2 * self.limit:
            self.known, self.flat, self.size = None, self.flat[:0].copy(), self.size[:0].copy()
        return found


class WordEncoder:
    """Exact ids of many texts at a time, each distinct word encoded once (and kept
    within a bound of bytes).

    No rule of this vocabulary joins characters across white space, so a text's
    ids are those of its chunks in turn.  A chunk of Latin letters, with or
    without one closing full stop or comma, is lower-cased and goes to the
    vocabulary's model as one word; any other chunk goes through the whole
    tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = {k: v for k, v in _byte_alphabet().items() if chr(k) != v}
        self.words = Known(lambda words: _joined(map(self.word, words)), CACHE_BYTES)
        self.others = Known(self._whole, OTHERS_BYTES)

    def word(self, word: str) -> list[int]:
        text = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
        return [t.id for t in self.model.tokenize(text)]

    def _whole(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks through the whole tokenizer."""
        return _joined(e.ids for e in self.tokenizer.encode_batch(chunks, add_special_tokens=False))

    def chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each chunk end to end, and their numbers."""
        plain = pc.match_substring_regex(chunks, PLAIN)
        simple = plain.to_numpy(zero_copy_only=False)
        coded = pc.utf8_rtrim(pc.utf8_lower(chunks.filter(plain)), ".,").dictionary_encode()
        flat, start_of, size_of = self.words(coded.dictionary)
        rest, rest_start, rest_size = self.others(chunks.filter(pc.invert(plain)))
        closing = [pc.ends_with(chunks, mark).to_numpy(zero_copy_only=False) & simple for mark in ".,"]

        code = coded.indices.to_numpy(zero_copy_only=False)
        size = np.empty(len(simple), np.int64)
        size[simple] = size_of[code]
        size[~simple] = rest_size
        closed = closing[0] | closing[1]
        size += closed
        ids = np.empty(int(size.sum()), np.uint32)
        end = np.cumsum(size)
        inner = np.ones(len(ids), bool)
        inner[end[closed] - 1] = False
        owner = np.repeat(simple, size)
        ids[owner & inner] = gather(flat, start_of[code], size_of[code])
        ids[~owner] = gather(rest, rest_start, rest_size)
        for mark, at in zip(".,", closing):
            ids[end[at] - 1] = self.word(mark)[0]
        return ids, size

    def batch(self, texts: pa.Array, rows: int = 500) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For every ``rows`` texts: all ids end to end, and the number of ids of each."""
        for mark in ("\n", "\t", "\r"):
            texts = pc.replace_substring(texts, mark, " ")
        parts = pc.split_pattern(texts, " ")
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))]).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        del parts
        flat, size = self.chunks(coded.dictionary)
        start = np.cumsum(size) - size
        code = coded.indices.to_numpy(zero_copy_only=False)
        for lo in range(0, len(texts), rows):
            hi = min(lo + rows, len(texts))
            c = code[bounds[lo]:bounds[hi]]
            upto = np.concatenate([[0], np.cumsum(size[c])])
            yield gather(flat, start[c], size[c]), np.diff(upto[bounds[lo:hi + 1] - bounds[lo]])


@lru_cache(1)
def worker_encoder(path: str) -> WordEncoder:
    """One encoder a Python worker, for all its tasks: a vocabulary loaded anew for each
    task costs time, and memory that a reused worker does not give back."""
    return WordEncoder(path)


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of ``cells`` (ints below ``2 ** bits``)."""
    x = cells.astype(np.int64).T.copy()
    dims, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:  # undo excess work, axis by axis
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def tokenised(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Staged rows ``doc_id, row, n, ids (little-endian uint16, or uint32 for a
    large vocabulary), at``: ``row`` numbers the staged rows, ``at`` is the
    projected vector."""
    path = tokenizer_path or default_tokenizer_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        wide = "<u2" if encoder.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        rng = np.random.default_rng(SEED)
        matrix = rng.standard_normal((HASHED, DIMS))
        # the hashing trick: a bin and a sign for each id of the vocabulary
        bins = rng.integers(0, HASHED, encoder.tokenizer.get_vocab_size())
        sign = rng.choice([-1.0, 1.0], len(bins))
        last = np.array([END_ID], wide).tobytes()
        for batch in batches:
            for begin, end in by_bytes(batch.column(1), SLICE_BYTES):
                lo = begin
                for ids, n in encoder.batch(batch.column(1).slice(begin, end - begin)):
                    ends = np.cumsum(n)
                    blobs, places = [], np.zeros((len(n), DIMS))
                    narrow = ids.astype(wide)
                    for i, (b, m) in enumerate(zip(ends.tolist(), n.tolist())):
                        blobs.append(narrow[b - m:b].tobytes() + last)
                        if m:
                            v = np.bincount(bins[ids[b - m:b]], sign[ids[b - m:b]], HASHED)
                            places[i] = (v @ matrix) / max(np.sqrt(v @ v), 1e-9)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(lo, len(n)), pa.array(n + 1, pa.int64()), pa.array(blobs, pa.binary()),
                        pa.array(list(places), pa.list_(pa.float64()))], ["doc_id", "n", "ids", "at"])
                    lo += len(n)
                pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        encode, "doc_id long, n long, ids binary, at array<double>")
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "tokens")


def curve_keys(tokens: DataFrame) -> DataFrame:
    """``row, n, key``: the Hilbert key of every document."""
    cuts = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    edges = tokens.agg(*[F.percentile_approx(F.col("at")[d], cuts, 20000) for d in range(DIMS)]).first()
    edges = [np.array(e if e is not None else []) for e in edges]

    @F.pandas_udf("long")
    def key(at: pd.Series) -> pd.Series:
        points = np.stack(at.to_numpy()) if len(at) else np.zeros((0, DIMS))
        cells = np.stack([np.searchsorted(e, points[:, d], side="left") for d, e in enumerate(edges)], axis=1)
        return pd.Series(hilbert_key(cells, BITS))

    return tokens.select("row", "n", key("at").alias("key"))


def positions(keys: DataFrame) -> DataFrame:
    """``row, place``: ids before each row when all lie along the curve.

    Rows are range-partitioned by (key, hash of the row); the partition number
    and running sums within partitions are staged, then each partition's start
    is added (one row a partition)."""
    order = ["key", "mixed", "row"]
    ranged = (keys.withColumn("mixed", F.xxhash64("row")).repartitionByRange(*order).sortWithinPartitions(*order)
              .select("row", "n", F.spark_partition_id().alias("part")))

    def running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = 0
        for pdf in batches:
            upto = pdf["n"].cumsum() + before
            yield pd.DataFrame({"row": pdf["row"], "part": pdf["part"], "n": pdf["n"], "inside": upto - pdf["n"]})
            if len(upto):
                before = int(upto.iloc[-1])

    laid = staged(ranged.mapInPandas(running, "row long, part int, n long, inside long"), "curve")
    parts = laid.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    return laid.join(F.broadcast(parts), "part").select("row", (F.col("base") + F.col("inside")).alias("place"))


def cut_pieces(length: int) -> Callable:
    """Rows with their place -> pieces, cut where sequences end."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, n, blob, place in zip(pdf["doc_id"].tolist(), pdf["n"].tolist(), pdf["ids"], pdf["place"].tolist()):
                if len(blob) < 4 * n:
                    blob = np.frombuffer(blob, "<u2").astype("<u4").tobytes()
                at = 0
                while at < n:
                    seq, off = divmod(place + at, length)
                    take = min(length - off, n - at)
                    out.append((doc, at, take, zlib.crc32(blob[4 * at:4 * (at + take)]), n, seq, off))
                    at += take
            got = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            got["doc_id"] = got["doc_id"].astype("Int64")
            yield got

    return cut


def pack_documents(docs: DataFrame, length: int = LENGTH, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``."""
    tokens = tokenised(docs, tokenizer_path)
    placed = tokens.select("row", "doc_id", "n", "ids").join(positions(curve_keys(tokens)), "row").select(
        "doc_id", "n", "ids", "place")
    return placed.mapInPandas(cut_pieces(length), "doc_id long, start long, length long, ids_crc32 long, "
                              "doc_tokens long, sequence_id long, offset long")
