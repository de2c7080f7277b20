"""The corpus pipeline: five training-data operators, one after another.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``:

1. language identification: documents without a recognisable language go;
2. quality classifier: documents scored below the threshold go;
3. near-duplicate removal: one document of each class stays;
4. mixing: documents repeat, or are cut, as the source targets ask;
5. packing: the pieces of the packed sequences.

Null or empty texts have no language and go in stage 1.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import language, mixing, order_minhash, packing, rules
from ledgerflow.llm.common import discard, recording, staged, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language.identify(docs, language.fit_profiles(docs), into="_language")
    return found.filter(F.col("_language.lang_pred") != language.UNKNOWN).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = rules.learn(docs, table(spark, sf_dir, "labels"))
    return rules.score_documents(docs, model, into="_score").filter(F.col("_score") >= rules.ACCEPT).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicate_classes(docs).filter("kept").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_texts(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


_scratch: list[list[str]] = [[] for _ in range(5)]


def _tidy(place: int, stage: Callable) -> Callable:
    """The stage, which first removes the scratch tables of the one before: the
    result of that one has been written by then."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if place:
            discard(spark, _scratch[place - 1])
        with recording(_scratch[place]):
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(name, _tidy(i, stage)) for i, (name, stage) in enumerate([
    ("language_id", identify_language),
    ("quality", keep_quality),
    ("near_dedup", remove_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
])]

# tokenising, the classifiers and alignment are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
