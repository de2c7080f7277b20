"""The registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator, with production parameters, to a whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import (edit_embedding, filter_audit, hash_tree, html_lstm, language, merge_path, mixing, multi_index,
                            order_minhash, packing, prefix_counts, rules, warc)
from ledgerflow.llm.common import held_out, shuffles_given_back, staged, table
from ledgerflow.llm.oracle_sql import ORACLE  # noqa: F401


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    with shuffles_given_back(spark):  # the texts were shuffled: as much disk as all that follows
        prints = staged(edit_embedding.fingerprint_documents(table(spark, sf_dir, "documents")), "prints", codec="zstd")
        found = edit_embedding.fingerprint_classes(prints.select("doc_id", "fingerprint"))
    return prints.join(found, "fingerprint").select(*prints.columns, "class_id")


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return order_minhash.near_duplicate_classes(docs, keep=["doc_id"]).select("doc.doc_id", "class_id", "kept")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_lstm.extract_pages(pages, html_lstm.fit(pages))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shard_documents(table(spark, sf_dir, "documents"), hash_tree.balanced_tree(8))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rules.learn(docs, table(spark, sf_dir, "labels"))
    return rules.score_documents(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= rules.ACCEPT).cast("int").alias("predicted"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.fit_profiles(docs))
    return found.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.count_tokens(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_path.align(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_fingerprints": op2_fingerprints,
    "op3_embeddings": op3_embeddings,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_mixing": op5_mixing,
    "op6_html": op6_html,
    "op7_sharding": op7_sharding,
    "op8_quality": op8_quality,
    "op9_warc": op9_warc,
    "op10_language": op10_language,
    "op11_token_counts": op11_token_counts,
    "op12_alignment": op12_alignment,
    "op13_filter_audit": op13_filter_audit,
}

