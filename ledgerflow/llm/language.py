"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent letter n-grams (1 to 3,
words padded with a separator), in order.  A document is ranked the same way
over its whole text and gets the language whose profile its own list is least
out of place with.  n-grams are counted in hashed bins, so any script works.

Learning: profiles come from the fold that may be learned from, rows with a
language only, about ``SAMPLE_PER_LANG`` documents of each language (chosen by
a hash of the id); the counts themselves are a Spark aggregation.

Defined cases: null text, or no letter in it, gives ``und`` with score 0, as
does an empty learning fold; ties go to the first language in order; repeated
rows get equal answers; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import held_out

PROFILE_SIZE = 300
SAMPLE_PER_LANG = 2000
BINS = 1 << 16
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """Which code points below 65536 are letters (built once a task)."""
    return np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)


def gram_counts(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Counts of the hashed n-grams of a text; None without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = letters[np.minimum(points, 0xFFFF)]
    for i in np.flatnonzero(points > 0xFFFF):
        letter[i] = chr(points[i]).isalpha()
    if not letter.any():
        return None
    chars = np.where(letter, points, 0).astype(np.uint64)
    chars = np.concatenate([[np.uint64(0)], chars, [np.uint64(0)]])
    chars = chars[np.concatenate([[True], (chars[1:] != 0) | (chars[:-1] != 0)])]
    a, b = chars[:-1], chars[1:]
    mix = np.uint64(0x9E3779B97F4A7C15)
    step = lambda h, c: (h * np.uint64(0x100000001B3)) ^ (c + np.uint64(1))
    one = step(np.uint64(7), a)
    two = step(one, b)
    three = step(two[:-1], chars[2:])
    grams = np.concatenate([one[a != 0], two, three[chars[1:-1] != 0]])
    return np.bincount(((grams * mix) >> np.uint64(48)).astype(np.int64), minlength=BINS)


def ranked(counts: np.ndarray, size: int = PROFILE_SIZE) -> np.ndarray:
    """The most frequent bins, ties by bin."""
    some = np.flatnonzero(counts)
    key = counts[some] * BINS + (BINS - 1 - some)
    if len(key) > size:
        key = np.partition(key, len(key) - size)[-size:]
    return (BINS - 1) - (np.sort(key)[::-1] % BINS)


def fit_profiles(docs: DataFrame, size: int = PROFILE_SIZE, sample: int = SAMPLE_PER_LANG) -> dict[str, list[int]]:
    """Language -> bins of its profile, learned from the learning fold only."""
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = known.groupBy("lang").count().select("lang", (F.lit(float(sample)) / F.col("count")).alias("share"))
    chance = (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / F.lit(1e6))
    chosen = known.select("lang", "text", chance.alias("chance")).join(F.broadcast(share), "lang").filter("chance < share")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                total = np.zeros(BINS, np.int64)
                for text in texts:
                    counts = gram_counts(text, letters)
                    if counts is not None:
                        total += counts
                some = np.flatnonzero(total)
                yield pd.DataFrame({"lang": lang, "bin": some.astype(np.int32), "n": total[some]})

    grams = (chosen.select("lang", "text").mapInPandas(count, "lang string, bin int, n long")
             .groupBy("lang", "bin").agg(F.sum("n").alias("n")))
    best = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "bin"))
    rows = grams.withColumn("place", best).filter(F.col("place") <= size).orderBy("lang", "place").collect()
    profiles: dict[str, list[int]] = {}
    for r in rows:  # at most ``size`` rows a language
        profiles.setdefault(r.lang, []).append(r.bin)
    return profiles


def language_of(text: Column, profiles: dict[str, list[int]], size: int = PROFILE_SIZE) -> Column:
    """Struct ``(lang_pred, score)``; the score is 1 minus the distance, as a
    share of the largest possible one."""
    names = sorted(profiles)

    @F.pandas_udf("lang_pred string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        place = np.full((len(names), BINS), 2 * size, np.int32)  # absent: far from any rank
        for i, name in enumerate(names):
            place[i, profiles[name]] = np.arange(len(profiles[name]))
        for texts in batches:
            found = []
            for text in texts:
                counts = gram_counts(text, letters) if text and names else None
                if counts is None:
                    found.append((UNKNOWN, 0.0))
                    continue
                top = ranked(counts, size)
                out = np.minimum(np.abs(place[:, top] - np.arange(len(top), dtype=np.int32)), size).sum(axis=1)
                best = int(out.argmin())
                found.append((names[best], 1.0 - float(out[best]) / (size * len(top))))
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    return guess(text)


def identify(docs: DataFrame, profiles: dict[str, list[int]], into: str = "language") -> DataFrame:
    """``docs`` plus the struct ``into``."""
    return docs.withColumn(into, language_of(F.col("text"), profiles))
