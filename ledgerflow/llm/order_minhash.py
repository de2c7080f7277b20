"""Near-duplicate documents by Order MinHash.

1. Shingles of ``K`` lower-cased words are labelled with their occurrence
   number, so no two of a text are equal.  One sketch keeps the ``ELL`` least
   labelled shingles under a random hash, in text order; ``ROWS`` sketches make
   a band.  Texts that share a band are candidates.
2. Equal texts are one class from the start.  In each band every class meets
   the least one, its hub; connected candidates form a cluster, of any size.
3. Classes are verified against their hubs first, dealt in blocks of ``BLOCK``.
   Where that leaves a cluster in several components, its classes outside the
   largest of them meet all others, block by block, unless links already found
   connect them.  A count of shared shingles rules pairs out; the others are
   aligned: the longest chain of equal labelled shingles that rises in both
   texts, within the band of diagonals that a similar pair cannot leave.  Two
   texts are linked when chain / (shingles of either or both) >= ``SIMILAR``.
4. Linked classes are one class; the least document of each is kept.

Another threshold takes other sketches (``sketch_plan``): a pair exactly at the
threshold shares a band with probability 0.99 at least.

Defined cases: null text is empty; texts without a word equal each other only;
shorter texts than ``K`` words are one shingle; of equal ids the first stored
row is kept, null ids come last; an empty table gives no rows; other columns
are kept as they are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged
from ledgerflow.llm.components import components

K, ELL, ROWS, BANDS = 5, 2, 3, 20
SIMILAR = 0.8
BLOCK = 256
SEED = 77
CHUNK = 1 << 14


def sketch_plan(similar: float = SIMILAR) -> tuple[int, int]:
    """``rows, bands``: the most sketches a band, and bands enough that a pair of this
    similarity shares one with probability 0.99 (two shingles a sketch, text order kept)."""
    for rows in range(ROWS, 0, -1):
        one = similar ** (ELL * rows)
        bands = max(BANDS, int(np.ceil(np.log(0.01) / np.log1p(-one)))) if one < 1 else BANDS
        if bands <= 2 * BANDS or rows == 1:
            return rows, bands
    return 1, BANDS


class Sketcher:
    """Labelled shingles and band keys of single texts."""

    def __init__(self, seed: int = SEED, rows: int = ROWS, bands: int = BANDS):
        self.rows, self.n_bands = rows, bands
        rng = np.random.default_rng(seed)
        odd = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = odd(1)[0]
        self.back = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.times, self.plus = odd(bands * rows), odd(bands * rows)
        self.word_times, self.label_times = odd(K), odd(1)[0]
        self.grow(1 << 12)

    def grow(self, n: int) -> None:
        self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self.base, np.uint64)]))
        self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self.back, np.uint64)]))

    def shingles(self, text: str) -> np.ndarray:
        """64-bit hashes of the labelled shingles, in text order."""
        raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
        dark = np.concatenate([[False], (raw != 32) & ((raw < 9) | (raw > 13)), [False]])
        edge = np.flatnonzero(dark[1:] != dark[:-1])
        start, end = edge[::2], edge[1::2]
        if not len(start):
            return np.zeros(0, np.uint64)
        if len(raw) >= len(self.up):
            self.grow(2 * len(raw))
        # a word's hash from prefix sums of a polynomial in its bytes, modulo 2 ** 64
        prefix = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[:len(raw)])])
        word = (prefix[end] - prefix[start]) * self.down[start]
        word ^= word >> np.uint64(29)
        n = max(len(word) - K + 1, 1)
        shingle = np.zeros(n, np.uint64)
        for i in range(min(K, len(word))):
            shingle += word[i:i + n] * self.word_times[i]
        shingle ^= shingle >> np.uint64(31)
        order = np.argsort(shingle, kind="stable")
        run = shingle[order]
        new = np.concatenate([[True], run[1:] != run[:-1]])
        at = np.arange(n)
        label = np.empty(n, np.uint64)
        label[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
        shingle = (shingle + label * self.label_times) * self.times[0]
        return shingle ^ (shingle >> np.uint64(32))

    def bands(self, shingle: np.ndarray) -> np.ndarray:
        """One key a band: the ``ELL`` least shingles of each sketch, in text order."""
        if not len(shingle):
            return np.zeros(0, np.int64)
        keep = None
        for lo in range(0, len(shingle), CHUNK):
            part = shingle[lo:lo + CHUNK, None] * self.times + self.plus
            part ^= part >> np.uint64(33)
            at = np.arange(lo, lo + len(part))[:, None].repeat(part.shape[1], 1)
            if keep is not None:
                part, at = np.concatenate([keep[0], part]), np.concatenate([keep[1], at])
            ell = min(ELL, len(part))
            pick = np.argpartition(part, ell - 1, axis=0)[:ell] if len(part) > ell else np.arange(len(part))[:, None].repeat(part.shape[1], 1)
            keep = np.take_along_axis(part, pick, 0), np.take_along_axis(at, pick, 0)
        inorder = np.sort(keep[1], axis=0)
        key = np.zeros(self.n_bands * self.rows, np.uint64)
        for row in inorder:
            key = (key ^ shingle[row]) * self.label_times
            key ^= key >> np.uint64(30)
        key = key.reshape(self.n_bands, self.rows)
        out = np.arange(self.n_bands, dtype=np.uint64)
        for r in range(self.rows):
            out = (out ^ key[:, r]) * self.base
            out ^= out >> np.uint64(28)
        return out.view(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, similar: float = SIMILAR) -> float:
    """Similarity by the longest rising chain of equal labelled shingles within
    the band: exact for pairs of at least ``similar``, never too high."""
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = int(min(len(a), len(b)) * (1 / similar - 1)) + 1
    near = np.abs(ia - ib) <= band
    ia, ib = ia[near], ib[near]
    line = ib[np.argsort(ia)]
    if len(line) < 2 or (line[1:] > line[:-1]).all():
        chain = len(line)
    else:
        tails: list[int] = []
        for x in line.tolist():
            i = bisect_left(tails, x)
            tails[i:i + 1] = [x]
        chain = len(tails)
    return chain / max(len(a) + len(b) - chain, 1)


def shared(texts: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """How many shingles each of ``rows`` has in common with each of ``cols``."""
    used = np.unique(np.concatenate([rows, cols]))
    flat = np.concatenate([texts[i] for i in used])
    owner = np.repeat(np.arange(len(used)), [len(texts[i]) for i in used])
    _, code, often = np.unique(flat, return_inverse=True, return_counts=True)
    several = often > 1  # a shingle of one text is shared with none
    new = np.cumsum(several) - 1
    owner, code = owner[several[code]], new[code[several[code]]]
    r, c = np.searchsorted(used, rows), np.searchsorted(used, cols)
    total = np.zeros((len(rows), len(cols)), np.float32)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    columns = int(several.sum())
    width = max(1, min(columns, (1 << 23) // max(len(used), 1)))
    for lo in range(0, columns, width):
        i, j = np.searchsorted(code, [lo, lo + width])
        has = np.zeros((len(used), width), np.float32)
        has[owner[i:j], code[i:j] - lo] = 1
        total += has[r] @ has[c].T
    return total


def linked(nodes: np.ndarray, parts: np.ndarray, texts: list[np.ndarray], low: np.ndarray, high: np.ndarray,
           similar: float = SIMILAR) -> list[tuple[int, int]]:
    """Links (a spanning set of them) among pairs of ``low`` x ``high`` members; members
    of one of the ``parts`` are connected already."""
    size = np.array([len(t) for t in texts], np.float32)
    common = shared(texts, low, high)
    either = size[low][:, None] + size[high][None, :] - common
    a, b = np.nonzero((common >= similar * either) & (parts[low][:, None] != parts[high][None, :]))
    best = np.argsort(-(common / np.maximum(either, 1))[a, b], kind="stable")
    root = list(range(len(nodes)))
    part = np.unique(parts, return_inverse=True)[1].tolist()

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in zip(low[a[best]].tolist(), high[b[best]].tolist()):
        x, y = top(part[i]), top(part[j])
        if x != y and aligned(texts[i], texts[j], similar) >= similar:
            root[max(x, y)] = min(x, y)
            out.append((int(nodes[i]), int(nodes[j])))
    return out


GROUP = "cluster", "low", "high"


def verifier(similar: float) -> Callable:
    """Sorted rows -> links, one group (cluster, low, high) after another; a row's ``side``
    says whether it is one of the low or of the high members."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def links(group: list[tuple]) -> list[tuple[int, int]]:
            nodes, parts, side = (np.array([g[k] for g in group]) for k in (3, 4, 5))
            texts = [np.frombuffer(g[6], np.uint32) for g in group]
            return linked(nodes, parts, texts, np.flatnonzero(side == 0), np.flatnonzero(side == 1), similar)

        group: list[tuple] = []
        for pdf in batches:
            out = []
            columns = [pdf[c].tolist() for c in (*GROUP, "node", "part", "side")] + [pdf["shingles"]]
            for row in zip(*columns):
                if group and group[0][:3] != row[:3]:
                    out += links(group)
                    group = []
                group.append(row)
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")
        if group:
            yield pd.DataFrame(links(group), columns=["a", "b"]).astype("int64")

    return verify


def _verified(groups: DataFrame, texts: DataFrame, similar: float, tasks: int) -> DataFrame:
    """Links among the dealt members (``cluster, low, high, node, part, side``)."""
    full = groups.join(texts.hint("merge"), "node").select(*GROUP, "node", "part", "side", "shingles")
    # few bytes but much work: as many tasks as partitions
    return full.repartition(tasks, *GROUP).sortWithinPartitions(*GROUP, "side", "node").mapInPandas(verifier(similar), "a long, b long")


def _blocks(n: Column) -> Column:
    return F.ceil(n / F.lit(float(BLOCK))).cast("int")


def _every(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def verified_links(meet: DataFrame, texts: DataFrame, similar: float, tasks: int) -> DataFrame:
    """Candidate pairs ``a`` (hub), ``b`` and ``node, shingles`` -> links that connect
    whatever similar pairs within a cluster of candidates connect."""
    meet = staged(meet, "meet")
    turn = F.xxhash64("node")
    hubs = meet.groupBy("a").agg(_blocks(F.count(F.lit(1))).alias("n"))
    guests = meet.withColumnRenamed("b", "node").join(hubs, "a").select(
        F.col("a").alias("cluster"), F.lit(0).alias("low"), F.pmod(turn, F.col("n")).cast("int").alias("high"), "node",
        F.col("node").alias("part"), F.lit(1).alias("side"))
    hosts = hubs.select(F.col("a").alias("cluster"), F.lit(0).alias("low"), _every("n").alias("high"), F.col("a").alias("node"),
                        F.col("a").alias("part"), F.lit(0).alias("side"))
    first = staged(_verified(hosts.unionByName(guests), texts, similar, tasks), "hub_links")

    clusters = components(meet).withColumnRenamed("component", "cluster")
    told = staged(clusters.join(components(first).withColumnRenamed("component", "part"), "node", "left")
                  .select("node", "cluster", F.coalesce("part", "node").alias("part")), "told")
    sizes = told.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("cluster").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "part")).alias("most"))
    open_ = staged(sizes.filter(F.col("n") > F.col("most.n")).select(
        "cluster", F.col("most.part").alias("main"), _blocks(F.col("n")).alias("all_blocks"),
        _blocks(F.col("n") - F.col("most.n")).alias("lesser_blocks")), "open")
    left = told.join(open_, "cluster")
    members = left.select("cluster", F.pmod(turn, F.col("all_blocks")).cast("int").alias("high"), _every("lesser_blocks").alias("low"),
                          "node", "part", F.lit(1).alias("side"))
    lesser = left.filter("part <> main").select("cluster", F.pmod(turn, F.col("lesser_blocks")).cast("int").alias("low"),
                                                _every("all_blocks").alias("high"), "node", "part", F.lit(0).alias("side"))
    rest = _verified(members.unionByName(lesser), texts, similar, tasks)
    return first.unionByName(staged(rest, "rest_links"))


def sketched(docs: DataFrame, keep: Sequence[str] | None = None, similar: float = SIMILAR) -> DataFrame:
    """Staged rows: ``doc`` (struct of the columns to keep, all by default), ``row``,
    ``key`` (equal texts have equal keys), band keys and labelled shingles (32 bits each)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    per_band, bands = sketch_plan(similar)
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("doc"), F.sha1(text.cast("binary")).alias("key"), text.alias("whole"))

    @F.pandas_udf("bands array<long>, shingles binary")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sketcher = Sketcher(rows=per_band, bands=bands)
        with np.errstate(over="ignore"):
            for texts in batches:
                out = []
                for t in texts:
                    s = sketcher.shingles(t)
                    out.append((sketcher.bands(s), (s >> np.uint64(32)).astype(np.uint32).tobytes()))
                yield pd.DataFrame(out, columns=["bands", "shingles"])

    rows = rows.withColumn("sketch", sketch("whole"))
    return staged(rows.select("doc", "key", F.col("sketch.bands").alias("bands"), F.col("sketch.shingles").alias("shingles"),
                              F.monotonically_increasing_id().alias("row")), "sketches")


def near_duplicate_classes(docs: DataFrame, keep: Sequence[str] | None = None, similar: float = SIMILAR) -> DataFrame:
    """Rows ``doc`` (struct of the columns to keep, ``doc_id`` among them), ``class_id``
    (doc_id of the document that is kept) and ``kept`` (once a class)."""
    rows = sketched(docs, keep, similar)
    order = F.struct(F.col("doc.doc_id").isNull(), F.col("doc.doc_id"), F.col("row"))
    classes = staged(rows.groupBy("key").agg(F.min(order).alias("least"), F.first("bands").alias("bands"))
                     .withColumn("node", F.col("least.row")), "classes")

    banded = classes.select("node", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    meet = banded.join(hubs, "band").filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    texts = rows.select(F.col("row").alias("node"), "shingles")
    links = verified_links(meet, texts, similar, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    joined = components(links)
    told = classes.select("key", "least", "node").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    keepers = told.groupBy("component").agg(F.min("least").alias("keeper"))
    told = told.join(keepers, "component").select("key", "keeper")
    return rows.select("doc", "key", "row").join(told, "key").select(
        "doc", F.col("keeper.doc_id").alias("class_id"), (F.col("row") == F.col("keeper.row")).alias("kept"))
