"""Randomised documents: ``flatten_runs`` against a plain statement of the
rules (object -> one row; list -> one row per object item, ``verify`` when
the item has no ``step`` key; ``path`` falls back when missing or empty;
records counts only from an object; malformed or scalar texts dropped)."""

import json
import random

from ledgerflow.operators import runs

KEYS = ["step", "start_time", "end_time", "duration_sec", "records", "format", "path", "is_table", "status",
        "error", "row_count"]


def rand_value(rnd, key):
    pick = rnd.random()
    if pick < 0.15:
        return None
    if key in ("start_time", "end_time", "duration_sec"):
        return rnd.choice([rnd.randint(0, 500), round(rnd.uniform(0, 500), 2)])
    if key == "row_count":
        return rnd.randint(0, 10_000)
    if key == "is_table":
        return rnd.choice([True, False])
    if key == "records":
        return rnd.choice([{"customer": rnd.randint(0, 99), "payment": rnd.randint(0, 99)}, {"customer": 5}, "n/a",
                           [1, 2]])
    if key == "path":
        return rnd.choice(["", "out/x", "gs://b/y"])
    return rnd.choice(["ingest", "transform", "verify", "csv", "success", "failed", "boom"])


def rand_obj(rnd):
    return {k: rand_value(rnd, k) for k in KEYS if rnd.random() < 0.6}


def rand_doc(rnd):
    kind = rnd.random()
    if kind < 0.4:
        return json.dumps(rand_obj(rnd))
    if kind < 0.85:
        items = [rand_obj(rnd) if rnd.random() < 0.8 else rnd.choice([7, "x", None, [1]]) for _ in range(rnd.randint(0, 4))]
        return json.dumps(items)
    return rnd.choice(['{"step": "in', "42", '"text"', "null", "[1, 2"])


def expected(path, text):
    try:
        doc = json.loads(text)
    except ValueError:
        return []
    if isinstance(doc, dict):
        items, is_list = [doc], False
    elif isinstance(doc, list):
        items, is_list = [x for x in doc if isinstance(x, dict)], True
    else:
        return []
    out = []
    for it in items:
        rec = it.get("records")
        num = lambda v: None if v is None else float(v)
        out.append((
            "verify" if is_list and "step" not in it else it.get("step"),
            num(it.get("start_time")), num(it.get("end_time")), num(it.get("duration_sec")),
            rec.get("customer") if isinstance(rec, dict) else None,
            rec.get("payment") if isinstance(rec, dict) else None,
            it.get("format"), it.get("path") or path,
            None if it.get("is_table") is None else str(it["is_table"]).lower(),
            it.get("status"), it.get("error"), it.get("row_count"),
        ))
    return out


def test_flatten_matches_rules_on_random_documents(spark):
    rnd = random.Random(2024)
    docs = [(f"src/{i}", i, rand_doc(rnd)) for i in range(600)]
    want = sorted((r for p, _, t in docs for r in expected(p, t)), key=repr)
    df = spark.createDataFrame(docs, "path string, doc_seq bigint, value string")
    cols = ["step", "start_time", "end_time", "duration_sec", "customer_records", "payment_records", "format", "path",
            "is_table", "status", "error", "row_count"]
    got = sorted((tuple(r[c] for c in cols) for r in runs.flatten_runs(df, "2024-01-01").collect()), key=repr)
    assert len(got) == len(want)
    assert got == want
