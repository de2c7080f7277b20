"""Document fingerprints by a randomised edit embedding.

A text is walked character by character with shared random bits: at step ``j``
the walk writes the character it stands on and moves on if the bit of
``(j, character)`` is set, so texts a few edits apart fall back into step and
write nearly the same string.  The walk jumps from character to character with
a table of run lengths, many texts at a time.

The fingerprint samples that output: ``SAMPLES`` fixed positions from each of
the top ``OCTAVES`` doublings of the walk's length, for ``WALKS`` independent
walks, one of 63 symbols (a hash of the character and the one after it) each.
Positions do not depend on the text, so equal symbols mean walks in step; the
likeness of two fingerprints is the share of equal symbols, weighted by the
length of output each stands for, less what chance gives.

``near_pairs`` finds like fingerprints by bit-sampled bands and verifies all
pairs of a band that are not connected already.

Defined cases: null text is empty; the empty text has a fingerprint of its own,
like only to itself; null ids come first in order; repeated rows follow one
another (their order among equal ids is that of a hash of the text); a table of
one row is its own next; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import discard, recording, staged, whole_text
from ledgerflow.llm.components import components

WALKS, OCTAVES, SAMPLES = 2, 5, 32
CLASSES, PERIOD, TOP = 64, 1024, 40
CHANCE = 0.025
SEED = 2021
CHUNK_CHARS = 2_000_000
ALPHABET = "".join(map(chr, range(48, 48 + 64)))
PAD = 63
WIDTH = 1 + WALKS * OCTAVES * SAMPLES

BANDS, BAND_SYMBOLS = 12, 5
BAND_BLOCK = 512
PAIRS = 1 << 15  # compared at a time
LIKE = 0.8


class Walker:
    """The shared random choices, and fingerprints of many texts at a time."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        bits = rng.random((WALKS, CLASSES, PERIOD)) < 0.5
        bits[:, :, -1] |= ~bits.any(axis=2)
        stay = np.empty(bits.shape, np.int32)
        run = np.zeros(bits.shape[:2], np.int32)
        for j in range(2 * PERIOD - 1, -1, -1):  # twice round: runs go on past the end
            run = np.where(bits[:, :, j % PERIOD], 1, run + 1)
            stay[:, :, j % PERIOD] = run
        self.stay = stay.reshape(-1)
        self.walk_base = (np.arange(WALKS, dtype=np.int32) * CLASSES * PERIOD)[:, None]
        spread = rng.random((WALKS, TOP, SAMPLES))
        octave = np.exp2(np.arange(TOP))[None, :, None]
        self.places = np.sort((octave - 1 + np.floor(spread * octave)).astype(np.int64), axis=2)
        self.symbol = rng.integers(0, 63, CLASSES * (CLASSES + 1)).astype(np.uint8)

    def prints(self, texts: list[str]) -> list[str]:
        """The fingerprint of each text, which depends on that text alone."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        out = [""] * len(texts)
        for i, found in zip(order, self._longest_first([texts[i] for i in order])):
            out[i] = found
        return out

    def _longest_first(self, texts: list[str]) -> list[str]:
        count = len(texts)
        size = np.array([len(t) for t in texts], np.int64)
        total, rows = int(size.sum()), np.arange(count)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        kind = ((points * np.uint32(2654435761)) >> np.uint32(26)).astype(np.int32)

        # texts lie end to end; ``turn`` sends them to the order in which all are
        # walked: the first character of each, the second of each that has one, ...
        first = np.cumsum(size) - size
        text_of = np.repeat(rows.astype(np.int32), size)
        longest = int(size[0]) if count else 0
        walking = count - np.searchsorted(size[::-1], np.arange(longest), side="right")
        step_at = np.concatenate([[0], np.cumsum(walking)])
        turn = step_at[np.arange(total) - np.repeat(first, size)].astype(np.int32)
        turn += text_of
        by_step = np.empty(total, np.int32)
        by_step[turn] = kind * PERIOD

        begun = np.empty((WALKS, total), np.int32)
        j = np.zeros((WALKS, count), np.int32)
        at = 0
        for n in walking.tolist():
            here, to = j[:, :n], at + n
            begun[:, at:to] = here
            index = here & (PERIOD - 1)
            index += by_step[at:to]
            index += self.walk_base
            here += self.stay.take(index)
            at = to

        out = np.full((count, WIDTH), PAD, np.uint8)
        after = np.append(kind[1:], CLASSES)
        after[(first + size - 1)[size > 0]] = CLASSES
        top = np.floor(np.log2(np.maximum(j[0], 1))).astype(np.int64)
        octaves = top[:, None] - np.arange(OCTAVES)[None, :]  # blocks of all walks line up with the first
        span = int(j.max(initial=0)) + 2
        for w in range(WALKS if total else 0):
            length = j[w].astype(np.int64)
            line = begun[w][turn] + text_of.astype(np.int64) * span
            places = self.places[w][np.maximum(octaves, 0)]
            inside = (octaves[:, :, None] >= 0) & (places < length[:, None, None])
            query = np.where(inside, places, 0) + (rows * span)[:, None, None]
            where = np.maximum(np.searchsorted(line, query.reshape(-1), side="right") - 1, 0).reshape(query.shape)
            got = np.where(inside, self.symbol[kind[where] * (CLASSES + 1) + after[where]], PAD)
            out[:, 1 + w * OCTAVES * SAMPLES:1 + (w + 1) * OCTAVES * SAMPLES] = got.reshape(count, -1)
        out[:, 0] = top
        return [(row + 48).tobytes().decode("ascii") for row in out]


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """Of each pair of fingerprints, 0 to 1 (1 if they are equal)."""
    if not len(a):
        return np.zeros(0)
    return _likeness(_codes(a), _codes(b))


def _codes(prints: list[str]) -> np.ndarray:
    return np.frombuffer("".join(prints).encode("ascii"), np.uint8).reshape(len(prints), WIDTH).astype(np.int16) - 48


def _likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    top = np.maximum(x[:, 0], y[:, 0])
    blocks = []
    for p in (x, y):
        body = p[:, 1:].reshape(len(p), WALKS, OCTAVES, SAMPLES)
        ahead = np.full((len(p), WALKS, OCTAVES, SAMPLES), PAD, np.int16)  # octaves beyond the end
        body = np.concatenate([ahead, body], axis=2)
        shift = np.minimum(top - p[:, 0], OCTAVES)
        take = OCTAVES - shift[:, None] + np.arange(OCTAVES)[None, :]
        blocks.append(body[np.arange(len(p))[:, None], :, take, :])  # (n, octave, walk, sample)
    weight = np.exp2(-np.arange(OCTAVES, dtype=float))[None, :, None, None]
    some = (blocks[0] != PAD) | (blocks[1] != PAD)
    equal = some & (blocks[0] == blocks[1])
    total = (some * weight).sum(axis=(1, 3))
    share = ((equal * weight).sum(axis=(1, 3)) / np.maximum(total, 1e-12)).max(axis=1)
    near = np.clip((share - CHANCE) / (1 - CHANCE), 0, 1)
    return np.where((x == y).all(axis=1), 1.0, near)


def in_order(docs: DataFrame, pieces: int | None = None) -> DataFrame:
    """Rows ``piece, ghost, doc_id, tie, text`` dealt by ranges of (doc_id, hash of
    the text) and sorted; each range ends with a ghost of the row that follows it.

    Range bounds are the least keys of the ranges of one narrow pass (one row a
    range reaches the driver); texts are shuffled once.
    """
    spark = docs.sparkSession
    pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).withColumn("tie", F.xxhash64("text"))
    lows = (rows.select("doc_id", "tie").repartitionByRange(pieces, "doc_id", "tie")
            .groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("doc_id", "tie")).alias("low"))
            .select("low.*").collect())
    least = -(1 << 63)
    cuts = sorted({(r.doc_id is not None, least if r.doc_id is None else r.doc_id, r.tie) for r in lows})
    n = max(len(cuts), 1)

    @F.pandas_udf("piece int, first boolean")
    def place(known: pd.Series, doc_id: pd.Series, tie: pd.Series) -> pd.DataFrame:
        keys = list(zip(known.tolist(), doc_id.tolist(), tie.tolist()))
        at = [bisect.bisect_right(cuts, k) - 1 for k in keys]
        return pd.DataFrame({"piece": at, "first": [cuts[i] == k for i, k in zip(at, keys)]})

    placed = rows.withColumn("at", place(F.col("doc_id").isNotNull(), F.coalesce("doc_id", F.lit(least)), "tie"))
    own = F.struct(F.col("at.piece").alias("piece"), F.lit(False).alias("ghost"))
    ghost = F.struct(((F.col("at.piece") + F.lit(n - 1)) % F.lit(n)).cast("int").alias("piece"), F.lit(True).alias("ghost"))
    dealt = placed.select(F.explode(F.when(F.col("at.first"), F.array(own, ghost)).otherwise(F.array(own))).alias("to"),
                          "doc_id", "tie", "text").select("to.*", "doc_id", "tie", "text")
    return dealt.repartitionById(pieces, F.col("piece")).sortWithinPartitions("piece", "ghost", "doc_id", "tie")


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by the start of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame, pieces: int | None = None) -> DataFrame:
    """One row a document: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walker = Walker()

        def finish(rows: list[tuple]) -> pd.DataFrame:
            """All rows but the last, whose next one is not here yet."""
            changed, pairs = [], []
            for k, (piece, ghost, _, text) in enumerate(rows[:-1]):
                if not ghost:
                    pairs.append(k)
                    changed.append(edited(text, rows[k + 1][3]))
            prints = walker.prints([r[3] for r in rows] + changed)
            own = [prints[k] for k in pairs]
            new = prints[len(rows):]
            out = pd.DataFrame({
                "doc_id": pd.array([rows[k][2] for k in pairs], "Int64"), "n_chars": [len(rows[k][3]) for k in pairs],
                "edited_sha256": [hashlib.sha256(c.encode()).hexdigest() for c in changed],
                "fingerprint": own, "edited_fingerprint": new, "near_edited": likeness(own, new),
                "near_next": likeness(own, [prints[k + 1] for k in pairs])})
            return out

        held: list[tuple] = []
        chars = 0
        for pdf in batches:
            ids = [None if pd.isna(i) else int(i) for i in pdf["doc_id"]]
            for row in zip(pdf["piece"].tolist(), pdf["ghost"].tolist(), ids, pdf["text"]):
                held.append(row)
                chars += len(row[3])
                if len(held) > 1 and chars > CHUNK_CHARS:
                    yield finish(held)
                    held, chars = held[-1:], len(row[3])
        if len(held) > 1:
            yield finish(held)

    return in_order(docs, pieces).select("piece", "ghost", "doc_id", "text").mapInPandas(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


def bands(seed: int = SEED + 1) -> list:
    """Keys of sampled symbols of one octave, for each of the octaves below the top that
    texts fill.  An octave is sampled at the same places whichever it is from the top, so
    texts whose walks lie on either side of a power of two meet as well."""
    rng = np.random.default_rng(seed)
    top, keys = F.ascii(F.substring("fingerprint", 1, 1)) - 48, []
    for band in range(BANDS // 2):
        picks = sorted(rng.choice(SAMPLES, BAND_SYMBOLS, replace=False))
        for block in (1, 2, 3):
            base = 2 + (band % WALKS) * OCTAVES * SAMPLES + block * SAMPLES
            key = F.xxhash64(F.lit(band), top - block, *[F.substring("fingerprint", int(base + p), 1) for p in picks])
            keys.append(F.when(top >= block, key) if block == 3 else key)
    return keys


class Packed:
    """Fingerprints in one matrix: the likeness of one of them to many, part by part.

    Filled samples of an octave are its first ones (positions ascend), so the filled
    samples of a pair are counted without looking at them.  What the counts, and then
    the top octaves alone, leave too unlike is not compared further.
    """

    def __init__(self, prints: list[str]):
        codes = _codes(prints).astype(np.uint8)
        self.top = codes[:, 0].astype(np.int64)
        body = codes[:, 1:].reshape(-1, WALKS, OCTAVES, SAMPLES)
        self.filled = (body != PAD).sum(axis=3)
        self.body = np.ascontiguousarray(body.transpose(2, 0, 1, 3))  # an octave of all rows lies together
        self.other = np.where(self.body == PAD, np.uint8(255), self.body)  # equal to no empty sample
        self.weight = np.exp2(-np.arange(OCTAVES, dtype=float))

    def near(self, i: np.ndarray, j: np.ndarray, like: float) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs ``i, j`` have a likeness of at least ``like``, and the likeness."""
        out, values = [np.zeros(0, np.int64)], [np.zeros(0)]
        for lo in range(0, len(i), PAIRS):
            x, y = i[lo:lo + PAIRS], j[lo:lo + PAIRS]
            shift = self.top[y] - self.top[x]
            for s in np.unique(shift).tolist():
                if abs(s) < OCTAVES:
                    at = np.flatnonzero(shift == s)
                    some, value = self._aligned(x[at], y[at], s, like)
                    out.append(lo + at[some])
                    values.append(value)
        return np.concatenate(out), np.concatenate(values)

    def _aligned(self, i: np.ndarray, j: np.ndarray, shift: int, like: float) -> tuple[np.ndarray, np.ndarray]:
        """``j`` reach ``shift`` octaves beyond ``i``; octaves count from the higher top."""
        mine, theirs = max(shift, 0), max(-shift, 0)
        filled = np.zeros((2, len(i), WALKS, OCTAVES), np.int64)
        filled[0, :, :, mine:] = self.filled[i][:, :, :OCTAVES - mine]
        filled[1, :, :, theirs:] = self.filled[j][:, :, :OCTAVES - theirs]
        total = np.maximum(filled.max(axis=0) @ self.weight, 1e-12)
        equal = filled.min(axis=0).astype(float)
        least = like * (1 - CHANCE) + CHANCE - 1e-9
        left = np.arange(len(i))
        for o in range(max(mine, theirs) - 1, OCTAVES):
            if o >= max(mine, theirs):
                same = self.other[o - mine][i[left]] == self.body[o - theirs][j[left]]
                equal[:, :, o] = np.bitwise_count(same.view(np.uint64)).sum(axis=2)  # a byte of 1 for each equal sample
            keep = ((equal @ self.weight) / total).max(axis=1) >= least
            left, total, equal = left[keep], total[keep], equal[keep]
        near = np.clip((((equal @ self.weight) / total).max(axis=1) - CHANCE) / (1 - CHANCE), 0, 1)
        keep = near >= like
        return left[keep], near[keep]


def _verify(like: float):
    """Sorted rows -> links among one block of a band's lesser components and one block of
    all its members, group after group.  Small groups are compared together."""

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        packed = Packed(pdf["fingerprint"].tolist())
        rep, part, main, kind = (pdf[c].to_numpy() for c in ("rep", "component", "main", "kind"))
        number = np.unique(part, return_inverse=True)[1]
        group = pdf[["band", "i", "j"]].to_numpy()
        first = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]).any(axis=1)]))
        out, small = [], []

        def pairs(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            # a pair of two lesser ones is seen from both ends: once is enough
            some = (part[i] != part[j]) & ~((part[j] != main[j]) & (rep[j] > rep[i]))
            return i[some], j[some]

        def connect(i: np.ndarray, j: np.ndarray, value: np.ndarray, root: dict) -> None:
            for x, y, v in zip(i.tolist(), j.tolist(), value.tolist()):
                p, q = number[x], number[y]
                while p in root:
                    p = root[p]
                while q in root:
                    q = root[q]
                if p != q:
                    root[max(p, q)] = min(p, q)
                    out.append((min(rep[x], rep[y]), max(rep[x], rep[y]), v))

        for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(pdf)]):
            lesser, member = lo + np.flatnonzero(kind[lo:hi] == 1), lo + np.flatnonzero(kind[lo:hi] == 0)
            if len(lesser) * len(member) <= PAIRS:
                small.append(pairs(np.repeat(lesser, len(member)), np.tile(member, len(lesser))))
                continue
            root: dict = {}
            names = number.copy()
            for x in lesser.tolist():
                i, j = pairs(np.full(len(member), x), member)
                apart = names[i] != names[j]
                i, j = i[apart], j[apart]
                found, value = packed.near(i, j, like)
                if len(found):
                    connect(i[found], j[found], value, root)
                    names[np.isin(names, np.unique(names[j[found]]))] = names[x]
        if small:
            i, j = (np.concatenate(side) for side in zip(*small))
            found, value = packed.near(i, j, like)
            connect(i[found], j[found], value, {})
        return pd.DataFrame(out, columns=["a", "b", "near"]).astype({"a": "int64", "b": "int64", "near": "float64"})

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            if not len(pdf):
                continue
            last = tuple(pdf[["band", "i", "j"]].iloc[-1])
            ends = np.flatnonzero(~((pdf["band"] == last[0]) & (pdf["i"] == last[1]) & (pdf["j"] == last[2])).to_numpy())
            cut = int(ends[-1]) + 1 if len(ends) else 0
            if cut:  # the last group may go on in the next batch
                yield links(pd.concat([*held, pdf.iloc[:cut]], ignore_index=True))
                held = []
            elif held and tuple(held[-1][["band", "i", "j"]].iloc[-1]) != last:
                yield links(pd.concat(held, ignore_index=True))
                held = []
            held.append(pdf.iloc[cut:])
        if held:
            yield links(pd.concat(held, ignore_index=True))

    return verify


def _links(prints: DataFrame, like: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(doc_id, fingerprint)`` -> the pairs ``a, b, near`` of members with the least of
    their band, the components they make (``rep, component``), and the pairs found among
    the rest (some more than once).

    Members of a band meet its least representative first, so a band of like texts
    gives as many candidates as members.  Where that leaves a band in several
    components, its members outside the largest of them meet all others, in blocks.
    """
    classes = staged(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")).filter("rep is not null"), "classes")
    banded = staged(classes.select("rep", F.explode(F.array_distinct(F.array_compact(F.array(*bands())))).alias("band")), "bands")
    hubs = banded.groupBy("band").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = banded.join(hubs, "band").filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    one = classes.select(F.col("rep").alias("a"), F.col("fingerprint").alias("fa"))
    two = classes.select(F.col("rep").alias("b"), F.col("fingerprint").alias("fb"))

    @F.pandas_udf("double")
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(likeness(a.tolist(), b.tolist()))

    first = staged(pairs.join(one, "a").join(two, "b").withColumn("near", near("fa", "fb")).filter(F.col("near") >= like)
                   .select("a", "b", "near"), "hub_pairs")

    joined = components(first).withColumnRenamed("node", "rep")
    told = (banded.join(hubs.select("band"), "band").join(joined, "rep", "left")
            .select("rep", "band", F.coalesce("component", "rep").alias("component")))
    told = staged(told, "told")
    sizes = told.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("band").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("most"))
    blocks = lambda n: F.ceil(n / F.lit(float(BAND_BLOCK))).cast("int")
    open_ = staged(sizes.filter(F.col("n") > F.col("most.n")).select(
        "band", F.col("most.component").alias("main"), blocks(F.col("n")).alias("all_blocks"),
        blocks(F.col("n") - F.col("most.n")).alias("lesser_blocks")), "open")
    left = told.join(open_, "band").join(classes, "rep")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    turn = F.xxhash64("rep")
    row = "band", "rep", "component", "main", "fingerprint"
    members = left.select(*row, F.lit(0).alias("kind"), F.pmod(turn, F.col("all_blocks")).cast("int").alias("i"), every("lesser_blocks").alias("j"))
    lesser = left.filter("component <> main").select(
        *row, F.lit(1).alias("kind"), F.pmod(turn, F.col("lesser_blocks")).cast("int").alias("j"), every("all_blocks").alias("i"))
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.unionByName(lesser).repartition(tasks, "band", "i", "j").sortWithinPartitions("band", "i", "j", "kind", "rep")
    return first, joined, staged(dealt.mapInPandas(_verify(like), "a long, b long, near double"), "rest")


def near_pairs(prints: DataFrame, like: float = LIKE) -> DataFrame:
    """``(doc_id, fingerprint)`` -> ``a, b, near``: pairs of class representatives
    (the least id with that fingerprint) whose likeness is at least ``like``, enough of
    them to connect any two that share a band."""
    first, _, rest = _links(prints, like)
    return first.unionByName(rest.dropDuplicates(["a", "b"]))


def fingerprint_classes(prints: DataFrame, like: float = LIKE) -> DataFrame:
    """``(doc_id, fingerprint)`` -> ``fingerprint, class_id``, one row a fingerprint.
    Of the scratch tables only the last one, which the result reads, is left."""
    reps = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("rep"))
    scratch: list[str] = []
    with recording(scratch):
        _, stars, rest = _links(prints, like)  # what is connected already goes on as one edge a member
        links = stars.select(F.col("rep").alias("a"), F.col("component").alias("b")).unionByName(rest.select("a", "b"))
        joined = components(links).withColumnRenamed("node", "rep")
    discard(prints.sparkSession, scratch[:-1])
    return reps.join(joined, "rep", "left").select("fingerprint", F.coalesce("component", "rep").alias("class_id"))


def near_classes(prints: DataFrame, like: float = LIKE) -> DataFrame:
    """``(doc_id, fingerprint)`` -> every row with ``class_id``, the least id that
    near pairs lead to (its own where there are none)."""
    found = fingerprint_classes(prints, like)
    return prints.join(found, "fingerprint").select("doc_id", "fingerprint", "class_id")
