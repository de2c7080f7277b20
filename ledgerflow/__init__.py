"""ledgerflow: Spark-native credit-risk data preparation, lakehouse fan-out,
run observability and classification.

Every operator takes DataFrames and returns DataFrames; the heavy work runs
as Spark jobs (scans, shuffles, aggregates, windows).  Sub-packages:

* ``sources``   - readers, writers, derived test fixtures
* ``functions`` - column-expression helpers (JVM-side, codegen friendly)
* ``operators`` - cleaning, features, run metadata, alerts, metrics, ML
* ``plans``     - session, pipeline runner, job wrappers, query registry
* ``streaming`` - incremental ingestion of run documents
"""

__version__ = "0.1.0"
