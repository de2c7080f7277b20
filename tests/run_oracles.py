"""Run every registered query against its DuckDB oracle.

usage: python tests/run_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_compare  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402

oracle_compare.STRICT = os.environ.get("ORACLE_STRICT") == "1"

import __spark_entry__ as entry  # noqa: E402
from ledgerflow.plans.session import build_session  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session(master="local[8]", app_name="oracles", shuffle_partitions=8)
    con = duck(sf)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                problems = compare(df, con, sqls[name])
            else:
                problems = [] if df.count() >= 0 else ["no rows"]
                problems = problems or ["(rows-only)"]
        except Exception as e:  # noqa: BLE001
            problems = [f"ERROR {type(e).__name__}: {str(e)[:400]}"]
        ok = not problems or problems == ["(rows-only)"]
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time() - t0:6.2f}s {'; '.join(problems)}", flush=True)
    print(f"{len(qs)} queries, {len(sqls)} with oracle, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
