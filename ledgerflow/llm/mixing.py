"""Mixing sources to target weights by Sainte-Lague apportionment (DataFrame
functions only).

1. Each source's target is its weighted share of all words, stopped at
   ``limit`` times its own words; what is cut off is shared out again by weight.
2. The corpus is worth ``floor(total / block_words)`` blocks of equal words.
   Sources win blocks by the highest quotients ``target / (2k + 1)``; the
   blocks of a source go to its hash shards by the same rule on shard words.
3. Within a shard the documents lie in a seeded hash order, cut into blocks;
   the shard's quota is taken from the start of that line, round again when
   the quota exceeds the shard, never more than ``limit`` rounds.

Nothing is sampled: quotas are whole numbers, every row gets its count, and
reruns agree.  Defined cases: null text has size 0 and takes nothing; a null
source is a source of its own, last in order; repeated rows are separate rows;
an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged, whole_text

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
LIMIT = 3
BLOCK_WORDS = 4
SHARDS = 64
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``(source, source_size)`` -> plus ``place`` (code-point order, null last),
    ``weight`` and ``target``.

    The shares that stop at ``limit * source_size`` are exactly a prefix in the
    order of limit per weight, so one sorted pass finds them all.  One row per
    source; no document row passes through these windows.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(ordered)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    s = sources.select("source", "source_size", place.alias("place"), weight.cast("long").alias("weight"))
    s = s.withColumn("stop", F.col("source_size") * limit)
    by_ratio = Window.orderBy(F.col("stop") / F.col("weight"), "place")
    up_to = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("unit", (F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(up_to), F.lit(0)))
                     .cast("double") / F.sum("weight").over(from_here))
    s = s.withColumn("stopped", F.col("stop") / F.col("weight") <= F.col("unit"))
    # the first source that does not stop has the unit share of all that do not
    unit = F.first(F.when(~F.col("stopped"), F.col("unit")), ignorenulls=True).over(everything)
    return s.select("source", "source_size", "place", "weight",
                    F.when(F.col("stopped"), F.col("stop").cast("double"))
                     .otherwise(F.col("weight") * unit).alias("target"))


def apportion(items: DataFrame, group: Sequence[str], item: str, votes: str, seats: str, out: str) -> DataFrame:
    """Sainte-Lague: ``items`` plus the whole number of seats of each.

    ``seats`` (constant in a group) go to the highest quotients
    ``votes / (k + 1/2)``, ties to the smaller ``item``.  Two multipliers
    bracket the result: at the lower one the rounded shares never exceed the
    seats, at the upper one they never fall short, and only the quotients
    between them (two per item on average) are listed and ranked.
    """
    all_ = Window.partitionBy(*group)
    n, total = F.col(seats).cast("double"), F.sum(votes).over(all_).cast("double")
    half = F.count(F.lit(1)).over(all_) / 2
    share = F.coalesce(F.when((n > 0) & (total > 0), F.col(votes) * n / total), F.lit(0.0))
    scaled = lambda bound: F.coalesce(F.floor(F.col("_q") * bound / n + 0.5), F.lit(0)).cast("long")
    rows = (items.withColumn("_q", share).withColumn("_half", half)
            .withColumn("_lo", F.when(n > 0, scaled(F.greatest(n - F.col("_half"), F.lit(0.0)))).otherwise(F.lit(0)).cast("long"))
            .withColumn("_hi", F.when(n > 0, scaled(n + F.col("_half"))).otherwise(F.lit(0)).cast("long"))
            .withColumn("_left", F.col(seats) - F.sum("_lo").over(all_)))
    between = F.when(F.col("_hi") > F.col("_lo"), F.sequence("_lo", F.col("_hi") - 1))
    listed = rows.withColumn("_k", F.explode_outer(between))
    quotient = F.col("_q") / (F.col("_k") + 0.5)
    ranked = listed.withColumn("_rank", F.row_number().over(
        Window.partitionBy(*group).orderBy(quotient.desc_nulls_last(), F.col(item), F.col("_k"))))
    won = F.sum(F.when(F.col("_k").isNotNull() & (F.col("_rank") <= F.col("_left")), 1).otherwise(0))
    keep = items.columns
    return (ranked.groupBy(*keep, "_lo").agg(won.alias("_won"))
            .select(*keep, (F.col("_lo") + F.col("_won")).cast("long").alias(out)))


def mix_documents(docs: DataFrame, keep: Sequence[str] = ("doc_id",), weights: Sequence[int] = WEIGHTS,
                  limit: int = LIMIT, block_words: int = BLOCK_WORDS, shards: int = SHARDS,
                  seed: str = SEED) -> DataFrame:
    """Rows ``row`` (struct of the ``keep`` columns), ``size``, ``source_size``,
    ``target``, ``taken``.  A hot source is spread over ``shards`` windows; the
    rows that are ordered hold only what ``keep`` names."""
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = staged(docs.select(
        F.struct(*keep).alias("row"), "source", word_count(whole_text()).alias("size"), key.alias("line"),
        F.col("doc_id").alias("_id"),
    ).withColumn("shard", (F.conv(F.substring("line", 1, 8), 16, 10).cast("long") % shards).cast("int")), "mix")

    cells = rows.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    targets = source_targets(cells.groupBy("source").agg(F.sum("shard_size").alias("source_size")), weights, limit)
    everything = Window.partitionBy("one").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    targets = targets.withColumn("one", F.lit(1)).withColumn(
        "corpus_blocks", F.floor(F.sum("source_size").over(everything) / F.lit(block_words)).cast("long"))
    quotas = apportion(targets, ["one"], "place", "target", "corpus_blocks", "source_blocks").drop("one")
    quotas = quotas.withColumnRenamed("source", "_source")
    cells = cells.join(quotas, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    cells = apportion(cells, ["place"], "shard", "shard_size", "source_blocks", "blocks").select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "source_size", "target", "shard_size",
        F.least(F.col("blocks") * block_words, F.col("shard_size") * limit).alias("quota"))

    placed = rows.join(cells, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
    before = (Window.partitionBy("source", "shard").orderBy("line", "_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rounds = F.when(F.col("shard_size") > 0, F.expr("quota div shard_size")).otherwise(F.lit(0))
    rest = F.col("quota") - rounds * F.col("shard_size") - F.coalesce(F.sum("size").over(before), F.lit(0))
    taken = F.col("size") * rounds + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.select("row", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself, with the columns of ``docs``: each document as
    often as it is taken, the last time cut after the words that are taken
    (words then joined by one space).  ``n_chars`` follows the text."""
    mixed = mix_documents(docs, keep=docs.columns, **options).filter("taken > 0")
    whole = F.expr("taken div size")
    part = F.col("taken") % F.col("size")
    copies = mixed.withColumn("words", F.explode(F.concat(
        F.array_repeat(F.lit(None).cast("long"), whole.cast("int")),
        F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))))
    words = F.filter(F.split(F.col("row.text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.array_join(F.slice(words, F.lit(1), F.col("words").cast("int")), " ")
    text = F.when(F.col("words").isNull(), F.col("row.text")).otherwise(cut)
    new = {"text": text, "n_chars": F.char_length(text).cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    return copies.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
