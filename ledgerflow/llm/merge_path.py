"""Alignment of two tokenizers by merge-path partitioning.

1. Every text is encoded by both vocabularies (each distinct chunk once, see
   ``chunks``).  The ends of A's and of B's tokens are two sorted lists; the path
   that merges them (A first where both end) is cut at every ``PIECE``-th diagonal,
   each cut found by binary search.  The pieces are equal work, need nothing of one
   another but the token before, and are staged as rows of their own.
2. A piece emits its overlaps: the B tokens that end where an A token ends, with
   that A token (links), the groups between such offsets, and what lies before its
   first and behind its last such offset.
3. Pieces of one text are stitched: what a piece leaves behind its last common end
   and what the next ones have up to their first make one group.  They stream in
   order, so a text of any length is digested in bounded memory.
4. Links are counted per pair of ids: first within batches of pieces, then over
   all batches.  Each batch takes the counts of its own pairs back (a row a pair
   and batch, so a pair that every text holds is no hot key) and sums them per text.

Defined cases: null and empty texts, and texts that the joined tokens of A or B do
not give back, have no tokens: zeros and an empty digest; repeated rows are rows of
their own; an empty table gives no rows; null ids stay null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.chunks import OPEN_END, by_bytes, chunked_array, gather
from ledgerflow.llm.common import staged, whole_text
from ledgerflow.llm.packing import Known, _byte_alphabet

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
PIECE = 1 << 16
BATCH_TOKENS = 1_500_000
CACHE_BYTES = 48_000_000
SPACE = "▁"
PIECES = ("row long, doc_id long, piece int, pieces int, a binary, b binary, a_before long, a_at long, b_at long")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE)


class Vocabularies:
    """Ids and byte lengths of both sides."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        back = {c: b for b, c in _byte_alphabet().items()}
        added = {i: t.content for i, t in self.a.get_added_tokens_decoder().items()}
        names = {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [b""] * (max(names, default=-1) + 1)
        for i, name in names.items():
            self.a_bytes[i] = name.encode() if i in added else bytes(back[c] for c in name)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.space = self.b.piece_to_id(SPACE)
        self.a_length, self.b_length = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        # every id followed by each mark that may come behind it in a digest
        self.a_text = np.array([f"{i}{m}" for m in ",|" for i in range(len(self.a_bytes))], object)
        self.b_text = np.array([f"{i}{m}" for m in ",;" for i in range(len(self.b_bytes))], object)

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Records of the chunks, each with the space before it, end to end, and their
        lengths: whether both sides give the chunk back, the number of A's ids, A's and
        B's ids."""
        open_end = pc.match_substring_regex(pa.array(chunks), OPEN_END).to_numpy(zero_copy_only=False)
        order = np.argsort(open_end, kind="stable")
        closed = len(chunks) - int(open_end.sum())
        chunks = [chunks[i] for i in order.tolist()]
        raw = [(" " + c).encode() for c in chunks]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        raw = b"".join(raw)
        # closed chunks are encoded as one text, which costs A much less than one by one
        a = _flat(self._a_ids([" " + " ".join(chunks[:closed])] * (closed > 0) + [" " + c for c in chunks[closed:]]))
        upto = np.cumsum(self.a_length[a])
        cut = np.searchsorted(upto, np.cumsum(size)) + 1
        n_a = np.diff(cut, prepend=0)
        if cut[-1] != len(a) or not given_back(a, n_a, self.a_bytes, self.a_length, raw, size).all():
            found = self._a_ids([" " + c for c in chunks])
            a, n_a = _flat(found), np.fromiter(map(len, found), np.int64, len(found))
        found = [y if c else [self.space] for c, y in zip(chunks, self.b.encode(chunks, num_threads=1))]
        b, n_b = _flat(found), np.fromiter(map(len, found), np.int64, len(found))
        good = given_back(a, n_a, self.a_bytes, self.a_length, raw, size) & given_back(b, n_b, self.b_bytes, self.b_length, raw, size)
        length = 2 + n_a + n_b
        first = np.cumsum(length) - length
        flat = np.empty(int(length.sum()), np.uint32)
        flat[first], flat[first + 1] = good, n_a
        side = np.repeat(np.tile(np.array([0, 1, 2], np.int8), len(chunks)), np.column_stack([np.full(len(chunks), 2), n_a, n_b]).ravel())
        flat[side == 1], flat[side == 2] = a, b
        back = np.argsort(order)
        return gather(flat, first[back], length[back]), length[back]

    def _a_ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]


def _flat(found: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))


def given_back(ids: np.ndarray, count: np.ndarray, token: list[bytes], length: np.ndarray, raw: bytes, size: np.ndarray) -> np.ndarray:
    """Which chunks (``size`` bytes each of ``raw``) the bytes of their ``count`` ids give back."""
    made = b"".join(map(token.__getitem__, ids.tolist()))
    upto = np.concatenate([[0], np.cumsum(length[ids])])[np.concatenate([[0], np.cumsum(count)])]
    good = np.diff(upto) == size
    if good.all() and made == raw or not good.any():
        return good
    first, want = upto[:-1][good], size[good]
    differ = gather(np.frombuffer(made, np.uint8), first, want) != gather(np.frombuffer(raw, np.uint8), (np.cumsum(size) - size)[good], want)
    good[good] = np.add.reduceat(differ.astype(np.int64), np.cumsum(want) - want) == 0
    return good


def diagonals(a_end: np.ndarray, b_end: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many of A's ends come first among the first ``places`` of both lists merged
    (A first where equal): one binary search for each place, all at once."""
    low, high = np.maximum(places - len(b_end), 0), np.minimum(places, len(a_end))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        other = np.clip(places - middle - 1, 0, max(len(b_end) - 1, 0))
        takes = a_end[np.minimum(middle, len(a_end) - 1)] <= b_end[other]  # this A comes before that B
        low, high = np.where(open_ & takes, middle + 1, low), np.where(open_ & ~takes, middle, high)
    return low


def partition(a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray, piece: int) -> list[tuple]:
    """Pieces of one text: ``piece, pieces, a, b, a_before (-1 at the start), a_at, b_at``
    (byte offsets where the first tokens begin)."""
    total = len(a) + len(b)
    places = np.append(np.arange(0, max(total, 1), piece), total)
    i = diagonals(a_end, b_end, places)
    j = places - i
    begins = [np.concatenate([[0], ends]) for ends in (a_end, b_end)]
    return [(k, len(places) - 1, a[i[k]:i[k + 1]], b[j[k]:j[k + 1]], int(a[i[k] - 1]) if i[k] else -1, int(begins[0][i[k]]), int(begins[1][j[k]]))
            for k in range(len(places) - 1)]


def split_tokens(docs: DataFrame, piece: int = PIECE, paths: tuple[str, str] | None = None) -> DataFrame:
    """Staged pieces of all texts: ``row`` numbers the documents."""
    a_path, b_path = paths or default_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        both = None  # loaded only where there are rows: many tasks of a scan have none
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            if both is None:
                both = Vocabularies(a_path, b_path)
                known = Known(both.encode, CACHE_BYTES)
            for lo, hi in by_bytes(batch.column(1)):
                distinct, code, bounds = chunked_array(batch.column(1).slice(lo, hi - lo))
                flat, first, size = known(distinct)
                good, n_a = flat[first].astype(bool), flat[first + 1].astype(np.int64)
                sides = []
                for start, n in ((first + 2, n_a), (first + 2 + n_a, size - 2 - n_a)):
                    sides.append((gather(flat, start[code], n[code]), np.concatenate([[0], np.cumsum(n[code])])[bounds]))
                (a, a_of), (b, b_of) = sides
                whole = np.logical_and.reduceat(good[code], bounds[:-1]) if len(code) else np.zeros(0, bool)
                blank = (np.diff(bounds) == 1) & (pc.binary_length(distinct).to_numpy(zero_copy_only=False)[code[bounds[:-1]]] == 0)
                out = []
                for k, doc in enumerate(batch.column(0).slice(lo, hi - lo).to_pylist()):
                    if blank[k] or not whole[k]:
                        parts = [(0, 1, a[:0], b[:0], -1, 0, 0)]
                    else:
                        x, y = a[a_of[k]:a_of[k + 1]], b[b_of[k]:b_of[k + 1]]
                        if len(x) + len(y) <= piece:
                            parts = [(0, 1, x, y, -1, 0, 0)]
                        else:
                            parts = partition(x, y, np.cumsum(both.a_length[x]), np.cumsum(both.b_length[y]), piece)
                    out += [(row, doc, p[0], p[1], p[2].astype("<u2").tobytes(), p[3].astype("<u2").tobytes(), *p[4:]) for p in parts]
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
                    ["row", "doc_id", "piece", "pieces", "a", "b", "a_before", "a_at", "b_at"])

    return staged(docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(run, PIECES), "pieces")


class Pieces:
    """Overlaps of many pieces at a time."""

    def __init__(self, both: Vocabularies, rows: list[tuple]):
        _, _, _, _, a, b, before, a_at, b_at = zip(*rows)
        self.a, self.b = (np.frombuffer(b"".join(side), "<u2").astype(np.int64) for side in (a, b))
        self.n_a, self.n_b = (np.array([len(x) // 2 for x in side], np.int64) for side in (a, b))
        count, self.before = len(rows), np.array(before, np.int64)
        own = np.arange(count)
        self.a_first, self.b_first = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b
        self.a_of, self.b_of = np.repeat(own, self.n_a), np.repeat(own, self.n_b)
        origin = np.minimum(a_at, b_at)

        def ends(length: np.ndarray, at: tuple, first: np.ndarray, of: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(length)])
            return upto[1:] - upto[first][of] + (np.array(at) - origin)[of]

        a_end = ends(both.a_length[self.a], a_at, self.a_first, self.a_of)
        b_end = ends(both.b_length[self.b], b_at, self.b_first, self.b_of)
        # pieces lie end to end, a byte apart; the token before a piece ends where its first one begins
        span = np.full(count, 1, np.int64)
        np.maximum.at(span, self.a_of, a_end + 1)
        np.maximum.at(span, self.b_of, b_end + 1)
        base = np.cumsum(span) - span
        halo = np.flatnonzero(self.before >= 0)
        line = np.concatenate([a_end + base[self.a_of], (np.array(a_at) - origin + base)[halo]])
        token = np.concatenate([self.a, self.before[halo]])
        number = np.concatenate([np.arange(len(self.a)), self.a_first[halo] - 1])
        order = np.argsort(line, kind="stable")
        line, target = line[order], b_end + base[self.b_of]
        at = np.minimum(np.searchsorted(line, target, side="right") - 1, max(len(line) - 1, 0))
        hit = (line[np.maximum(at, 0)] == target) & (at >= 0) if len(line) else np.zeros(len(target), bool)
        self.cut_b = np.flatnonzero(hit)
        self.cut_a = number[order[at[self.cut_b]]]
        self.link_a, self.link_b = token[order[at[self.cut_b]]], self.b[self.cut_b]
        self.cut_of = self.b_of[self.cut_b]
        self.cuts = np.bincount(self.cut_of, minlength=count)

    def words(self, both: Vocabularies) -> list[str]:
        """Every id with the mark behind it, group after group, A's before B's."""
        text = np.empty(len(self.a) + len(self.b), object)
        a, b = np.arange(len(self.a)), np.arange(len(self.b))
        group_a, group_b = (np.cumsum(np.bincount(cut + 1, minlength=len(ids) + 1)[:len(ids)]) for cut, ids in ((self.cut_a, a), (self.cut_b, b)))
        b_upto = np.concatenate([[0], self.cut_b + 1])
        a_upto = np.concatenate([self.cut_a + 1, [len(a)]])
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[self.cut_a[self.cut_a >= 0]], last_b[self.cut_b] = 1, 1
        text[a + b_upto[group_a]] = both.a_text[self.a + last_a * len(both.a_bytes)]
        text[b + a_upto[group_b]] = both.b_text[self.b + last_b * len(both.b_bytes)]
        return text.tolist()

    def digests(self, both: Vocabularies) -> list[str]:
        """Of pieces that are whole texts: the digest of their groups."""
        upto = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        words = self.words(both)
        return [hashlib.sha256("".join(words[i:j])[:-1].encode()).hexdigest() if j > i else "" for i, j in zip(upto, upto[1:])]

    def parts(self, both: Vocabularies) -> tuple[str, str, str, str, str]:
        """Of one piece: A's and B's ids up to the first common end, the groups between
        common ends, A's and B's ids behind the last."""
        cut_a, cut_b = self.cut_a + 1, self.cut_b + 1
        join = lambda ids: ",".join(map(str, ids.tolist()))
        if not len(cut_a):
            return join(self.a), join(self.b), "", "", ""
        body = "".join(self.words(both)[cut_a[0] + cut_b[0]:cut_a[-1] + cut_b[-1]])[:-1]
        return join(self.a[:cut_a[0]]), join(self.b[:cut_b[0]]), body, join(self.a[cut_a[-1]:]), join(self.b[cut_b[-1]:])


OVERLAPS = ("batch long, row long, doc_id long, piece int, pieces int, n_a long, n_b long, n_links long, groups_sha256 string, "
            "links binary, times binary, parts array<string>, pairs array<long>, counts array<long>")


def overlaps(pieces: DataFrame, batch_tokens: int = BATCH_TOKENS, paths: tuple[str, str] | None = None) -> DataFrame:
    """Staged rows, one a piece (``links`` are its distinct pairs, A's id * 2 ** 16 + B's,
    32 bits each, ``times`` how often), and one a batch of pieces (``row`` null): its
    distinct pairs and their counts."""
    a_path, b_path = paths or default_paths()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = None  # as above
        number = TaskContext.get().partitionId() << 40

        def emit(rows: list[tuple]) -> pd.DataFrame:
            out, codes = [], []
            for group in ([r for r in rows if r[3] == 1], *([r] for r in rows if r[3] > 1)):
                if not group:
                    continue
                found = Pieces(both, group)
                code = (found.cut_of << 32) | (found.link_a << 16) | found.link_b
                code, often = np.unique(code, return_counts=True)
                bound = np.searchsorted(code >> 32, np.arange(len(group) + 1))
                code = (code & 0xFFFFFFFF).astype("<u4")
                codes.append((code, often))
                whole = group[0][3] == 1
                digest = found.digests(both) if whole else [None]
                rest = None if whole else list(found.parts(both))
                for k, r in enumerate(group):
                    i, j = bound[k], bound[k + 1]
                    out.append((number, r[0], r[1], r[2], r[3], int(found.n_a[k]), int(found.n_b[k]), int(found.cuts[k]), digest[k],
                                code[i:j].tobytes(), often[i:j].astype("<u4").tobytes(), rest, None, None))
            pairs, place = np.unique(np.concatenate([c for c, _ in codes]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([n for _, n in codes]), len(pairs)).astype(np.int64)
            out.append((number, None, None, None, None, None, None, None, None, None, None, None, pairs.astype(np.int64), counts))
            got = pd.DataFrame(out, columns=[c.split()[0] for c in OVERLAPS.split(", ")])
            return got.astype({c: "Int64" for c in ("row", "doc_id", "piece", "pieces", "n_a", "n_b", "n_links")})

        held: list[tuple] = []
        tokens = 0
        for pdf in batches:
            if both is None:
                both = Vocabularies(a_path, b_path)
            ids = [None if pd.isna(i) else int(i) for i in pdf["doc_id"]]
            for r in zip(pdf["row"].tolist(), ids, *(pdf[c].tolist() for c in ("piece", "pieces", "a", "b", "a_before", "a_at", "b_at"))):
                held.append(r)
                tokens += (len(r[4]) + len(r[5])) // 2
                if tokens >= batch_tokens:
                    yield emit(held)
                    held, tokens, number = [], 0, number + 1
        if held:
            yield emit(held)

    return staged(pieces.mapInPandas(run, OVERLAPS), "overlaps")


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, count, best``: links of each pair of ids over all texts, and whether no A id
    is linked more often with that B id.  A B id has at most as many rows as A has ids."""
    seen = found.filter("row is null").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    counted = seen.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("count"))
    top = F.max("count").over(Window.partitionBy(F.col("pair") % (1 << 16)))
    return counted.select("pair", "count", (F.col("count") == top).alias("best"))


def _score(key: tuple, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    known = known.sort_values("pair")
    pair, count, best = known["pair"].to_numpy(), known["count"].to_numpy(), known["best"].to_numpy()
    link = np.frombuffer(b"".join(rows["links"]), "<u4")
    times = np.frombuffer(b"".join(rows["times"]), "<u4").astype(np.int64)
    at = np.searchsorted(pair, link)
    bound = np.concatenate([[0], np.cumsum([len(x) // 4 for x in rows["links"]])]).astype(np.int64)
    for name, value in (("n_best", times * best[at] if len(pair) else times), ("count_sum", times * count[at] if len(pair) else times)):
        rows[name] = np.diff(np.concatenate([[0], np.cumsum(value)])[bound])
    return rows[["row", "doc_id", "pieces", "n_a", "n_b", "n_links", "groups_sha256", "n_best", "count_sum"]]


def stitched(found: DataFrame) -> DataFrame:
    """``row, groups_sha256`` of texts of several pieces, which stream in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest, begun, a, b = None, hashlib.sha256(), False, [], []
        for pdf in batches:
            out = []
            for row, cuts, parts in zip(pdf["row"].tolist(), pdf["n_links"].tolist(), pdf["parts"]):
                if row != now:
                    if now is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest, begun, a, b = row, hashlib.sha256(), False, [], []
                a, b = a + [parts[0]], b + [parts[1]]
                if cuts:
                    group = ",".join(filter(None, a)) + "|" + ",".join(filter(None, b))
                    for text in (group, parts[2]):
                        if text:
                            digest.update(((";" if begun else "") + text).encode())
                            begun = True
                    a, b = [parts[3]], [parts[4]]
            yield pd.DataFrame(out, columns=["row", "groups_sha256"])
        if now is not None:
            yield pd.DataFrame([(now, digest.hexdigest())], columns=["row", "groups_sha256"])

    long = found.filter("pieces > 1").select("row", "piece", "n_links", "parts")
    return long.repartition("row").sortWithinPartitions("row", "piece").mapInPandas(run, "row long, groups_sha256 string")


def align(docs: DataFrame, piece: int = PIECE, batch_tokens: int = BATCH_TOKENS, paths: tuple[str, str] | None = None) -> DataFrame:
    """One row a document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``."""
    found = overlaps(split_tokens(docs, piece, paths), batch_tokens, paths)
    counts = staged(pair_counts(found), "pair_counts")
    wanted = found.filter("row is null").select(F.col("batch").alias("of"), F.explode("pairs").alias("pair")).join(counts, "pair")
    rows = found.filter("row is not null").select("batch", "row", "doc_id", "pieces", "n_a", "n_b", "n_links", "groups_sha256", "links", "times")
    scored = rows.groupBy("batch").cogroup(wanted.groupBy("of")).applyInPandas(
        _score, "row long, doc_id long, pieces int, n_a long, n_b long, n_links long, groups_sha256 string, n_best long, count_sum long")
    scored = staged(scored, "scored")
    sums = ["n_a", "n_b", "n_links", "n_best", "count_sum"]
    long = scored.filter("pieces > 1").groupBy("row").agg(F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in sums])
    every = scored.filter("pieces = 1").select("doc_id", *sums, "groups_sha256").unionByName(
        long.join(stitched(found), "row").select("doc_id", *sums, "groups_sha256"))
    return every.select("doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256")


def aligned_groups(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """The groups themselves, in pieces: ``doc_id, row, piece, a_ids, b_ids, links``
    (``links``: structs of A's id, B's id and the byte offset in the space and the text
    where both end)."""
    a_path, b_path = paths or default_paths()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = Vocabularies(a_path, b_path)
        for pdf in batches:
            out = []
            for r in zip(*(pdf[c].tolist() for c in ("row", "doc_id", "piece", "pieces", "a", "b", "a_before", "a_at", "b_at"))):
                found = Pieces(both, [r])
                end = r[8] + np.cumsum(both.b_length[found.b])
                links = [dict(a=int(x), b=int(y), end=int(e)) for x, y, e in zip(found.link_a, found.link_b, end[found.cut_b])]
                out.append((r[1], r[0], r[2], found.a, found.b, links))
            got = pd.DataFrame(out, columns=["doc_id", "row", "piece", "a_ids", "b_ids", "links"])
            got["doc_id"] = got["doc_id"].astype("Int64")
            yield got

    return split_tokens(docs, paths=paths).mapInPandas(
        run, "doc_id long, row long, piece int, a_ids array<long>, b_ids array<long>, links array<struct<a:long,b:long,end:long>>")
