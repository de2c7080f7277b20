"""Interaction audit of filters with wide packed counters.

1. Every document becomes a mask: one bit a filter that it fails.  Four filters
   look at the text alone; the fifth (``E``) fails where a smaller id of the table
   has the same text.
2. A part's documents are counted per mask (and per mask those of good quality and
   the toxic ones) before anything is shuffled, so a part or a text that holds a
   third of all rows is a few rows.
3. Every mask has one big integer: a field of ``FIELD`` bits for each counter
   (kept, removed, redundant) of each step of each order of the filters, 1 where a
   document with that mask counts.  A part's outcome is the sum of its masks'
   integers, times their documents.  A count has less than ``FIELD`` bits, so no
   field runs over into the next, and the fields of the sum are the counts.

Equal texts are found by 256-bit digests.  The rows that repeat a text are counted
per (text, part, flags) with the least id among them; only these counted rows meet
by text.

Defined cases: null text is empty (no word: fails ``A`` only, and ``E`` as an equal
text); a null id is no smaller id, has no smaller one, and no label; repeated rows
count one by one and fail ``E`` only for smaller ids; several labels of one id
count as good or toxic where any of them is; null sources make the part ``''``; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import whole_text

FILTERS = "ABCDE"
FIELD = 64
COUNTERS = ("kept", "removed", "redundant")
OUT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
       "good_lost long, toxic_lost long, shapley long")


def text_mask(text: Column) -> Column:
    """Bits of the filters ``A`` to ``D``."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * F.length(text), text.rlike("[#$%&*|]")]
    bits = [F.when(fail, F.lit(1 << i)).otherwise(F.lit(0)) for i, fail in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, n``: documents of each part and mask."""
    text = whole_text()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("same"), text_mask(text).alias("mask"))
    rows = rows.groupBy("doc_id", "part", "same", "mask").agg(F.count(F.lit(1)).alias("n"))
    flags = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = rows.join(flags, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})

    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    unknown = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0))
    texts = rows.groupBy("same", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), least.alias("least"), unknown.alias("unknown"))
    first = F.min("least.doc_id").over(Window.partitionBy("same"))
    # a row is no later copy if its id is the least of its text, or null
    texts = texts.withColumn("fresh", F.col("unknown") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0))
    last = F.lit(1 << (len(FILTERS) - 1))
    both = F.array(F.struct(F.col("mask").alias("mask"), F.col("fresh").alias("n")),
                   F.struct((F.col("mask") + last).alias("mask"), (F.col("n") - F.col("fresh")).alias("n")))
    split = texts.select("part", "good", "toxic", F.explode(both).alias("to")).select("part", "good", "toxic", "to.*").filter("n > 0")
    return split.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


class Counters:
    """The packed integers of all masks, and what their sums hold."""

    def __init__(self, filters: str = FILTERS):
        self.filters = filters
        self.orders = ["".join(p) for p in permutations(filters)]
        self.slots = [(order, step) for order in self.orders for step in range(1, len(filters) + 1)]
        self.packed = [self.pack(mask) for mask in range(1 << len(filters))]

    def pack(self, mask: int) -> int:
        fields = np.zeros((len(self.slots), len(COUNTERS)), "<u8")
        fails = {f for i, f in enumerate(self.filters) if mask >> i & 1}
        for at, (order, step) in enumerate(self.slots):
            removed_before, fails_here = bool(fails & set(order[:step - 1])), order[step - 1] in fails
            fields[at] = (not removed_before and not fails_here, not removed_before and fails_here, removed_before and fails_here)
        return int.from_bytes(fields.tobytes(), "little")

    def unpack(self, total: int) -> np.ndarray:
        """A row a slot, a column a counter."""
        size = len(self.slots) * len(COUNTERS)
        return np.frombuffer(total.to_bytes(size * FIELD // 8, "little"), "<u8").reshape(-1, len(COUNTERS)).astype(np.int64)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a part, order and step: ``part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = Counters()
        slots = pd.DataFrame(counters.slots, columns=["filter_order", "step"])
        letter = np.array([FILTERS.index(order[step - 1]) for order, step in counters.slots])

        def report(part: str, rows: list[tuple]) -> pd.DataFrame:
            every = sum(counters.packed[m] * n for m, _, _, n in rows)
            good = sum(counters.packed[m] * n for m, g, _, n in rows if g)
            toxic = sum(counters.packed[m] * n for m, _, t, n in rows if t)
            kept, removed, redundant = counters.unpack(every).T
            alone = np.array([sum(n for m, _, _, n in rows if m == 1 << i) for i in range(len(FILTERS))], np.int64)
            shapley = np.array([removed[letter == i].sum() for i in range(len(FILTERS))], np.int64)
            return slots.assign(part=part, kept=kept, removed=removed, redundant=redundant, unique_fails=alone[letter],
                                good_lost=counters.unpack(good)[:, 1], toxic_lost=counters.unpack(toxic)[:, 1],
                                shapley=shapley[letter])[[c.split()[0] for c in OUT.split(", ")]]

        part, held = None, []
        for pdf in batches:
            for p, *row in zip(*(pdf[c].tolist() for c in ("part", "mask", "good", "toxic", "n"))):
                if held and p != part:
                    yield report(part, held)
                    held = []
                part = p
                held.append(tuple(row))
        if held:
            yield report(part, held)

    counted = mask_counts(docs, labels)
    return counted.repartition("part").sortWithinPartitions("part").mapInPandas(run, OUT)
