"""Plan properties of every registered query: no Python evaluation in the
data path, no cartesian or nested-loop joins.

The exception is the neighbour search of SMOTE (numpy on the executors): it ends
in a checkpoint before the plans of ``smote_balance``, ``fold_resampling`` and the
model queries that are looked at here."""

import pytest

from ledgerflow.plans.registry import QUERIES

SMOKE = "/root/testdata/sf0.001"
MODEL = {"gbt_predict", "top_k_importance", "stumps_predict", "stumps_importance", "model_round_trip", "train_from_csv",
         "grid_search_folds", "fold_resampling"}  # Spark ML fits and transforms
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL))
def test_plan_has_no_python_or_cross_join(spark, name):
    df = QUERIES[name](spark, SMOKE)
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [f for f in FORBIDDEN if f in plan]
    assert not found, found
