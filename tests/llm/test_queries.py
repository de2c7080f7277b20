"""The registered training-data queries: SQL twins, and totals on the small tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerflow.llm.queries import ORACLE, QUERIES
from oracle_compare import compare, duck

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    problems = compare(QUERIES[name](spark, SMOKE), con, ORACLE[name])
    assert not problems, problems


def test_fingerprint_query_gives_classes_of_all_documents(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id").collect()
    got = QUERIES["op2_fingerprints"](spark, SMOKE).select("doc_id", "fingerprint", "class_id").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs)
    least = {}
    for r in got:
        assert r.class_id <= r.doc_id and least.setdefault(r.fingerprint, r.class_id) == r.class_id
