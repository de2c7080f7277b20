"""Independent DuckDB SQL for every registered query (the correctness oracle).

The dirty fixtures are re-derived here from the raw driver tables with the
same integer rules (FIXTURES.md section C), but decoded straight to typed
values, so the oracle shares no code path with the Spark operators.
Doubles are rounded to 4 decimals at the query boundary, as in the registry.
"""

from __future__ import annotations

# -- dirty inputs, decoded ---------------------------------------------------

RAW_CUSTOMER = """
raw_customer AS (
  SELECT CAST(k % 5 = 0 AS INTEGER) AS label, k AS id, CAST(c_nationkey AS INTEGER) AS fea_1,
         CASE WHEN k % 7 = 0 OR k % 11 = 0 THEN NULL ELSE c_acctbal END AS fea_2,
         CASE WHEN k % 19 = 0 THEN NULL ELSE CAST(k % 3 + 1 AS DOUBLE) END AS fea_3,
         c_acctbal * 150 AS fea_4,
         CAST(k % 7 + copy AS INTEGER) AS fea_5,
         CAST(c_nationkey % 5 AS INTEGER) AS fea_6,
         CAST(CASE WHEN k % 17 = 0 THEN -1 ELSE k % 10 + 1 END AS INTEGER) AS fea_7,
         CAST(CASE WHEN k % 23 = 0 THEN -1 ELSE k % 52 + 64 END AS INTEGER) AS fea_8,
         CAST(length(c_mktsegment) AS INTEGER) AS fea_9,
         CASE WHEN k % 20 = 3 THEN NULL ELSE c_acctbal / 100 END AS fea_10,
         CASE WHEN k % 13 = 0 THEN NULL ELSE c_acctbal END AS fea_11,
         copy
  FROM (SELECT c_custkey AS k, c_nationkey, c_acctbal, c_mktsegment, 0 AS copy FROM customer
        UNION ALL
        SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, 1 FROM customer WHERE c_custkey % 10 = 0)
)"""

RAW_PAYMENT = """
raw_payment AS (
  SELECT o_custkey AS id, o_orderkey AS ord,
         CAST(o_orderkey % 4 AS INTEGER) AS OVD_t1,
         CAST(CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderkey % 3 END AS INTEGER) AS OVD_t2,
         CAST(o_orderkey % 2 AS INTEGER) AS OVD_t3,
         CAST(o_orderkey % 4 + o_orderkey % 3 + o_orderkey % 2 AS INTEGER) AS OVD_sum,
         CAST(o_orderkey % 12 AS INTEGER) AS pay_normal,
         CAST(o_orderkey % 25 + 1 AS INTEGER) AS prod_code,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS prod_limit,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS update_date,
         CASE WHEN o_orderkey % 37 = 0 THEN (o_totalprice - 50000) * 10 ELSE o_totalprice - 50000 END AS new_balance,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END AS highest_balance,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 7 END AS report_date
  FROM orders
)"""

CLEAN_CUSTOMER = """
dedup_customer AS (
  SELECT * FROM raw_customer QUALIFY row_number() OVER (PARTITION BY id ORDER BY copy) = 1
),
clean_customer AS (
  SELECT label, id, fea_1, fea_2, fea_3, fea_4, fea_5, fea_6, fea_7, fea_8, fea_9, fea_10,
         coalesce(fea_11, (SELECT avg(fea_11) FROM raw_customer)) AS fea_11
  FROM dedup_customer
  WHERE fea_2 IS NOT NULL AND fea_3 IS NOT NULL AND fea_4 IS NOT NULL
    AND fea_4 < 1000000 AND fea_7 <> -1 AND fea_8 <> -1
)"""

CLEAN_PAYMENT = """
dedup_payment AS (
  SELECT * FROM raw_payment QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1
),
clean_payment AS (
  SELECT id, OVD_t1, OVD_t2, OVD_t3, OVD_sum, pay_normal, prod_code, prod_limit, update_date, new_balance,
         coalesce(highest_balance, (SELECT avg(highest_balance) FROM raw_payment)) AS highest_balance,
         report_date
  FROM dedup_payment
  WHERE prod_limit IS NOT NULL AND update_date IS NOT NULL AND report_date IS NOT NULL
    AND new_balance >= 0 AND new_balance < 2000000
)"""

CUSTOMER_OUT = ("label, id, fea_1, round(fea_2, 4) AS fea_2, round(fea_3, 4) AS fea_3, round(fea_4, 4) AS fea_4, "
                "fea_5, fea_6, fea_7, fea_8, fea_9, round(fea_10, 4) AS fea_10, round(fea_11, 4) AS fea_11")
PAYMENT_OUT = ("id, OVD_t1, OVD_t2, OVD_t3, OVD_sum, pay_normal, prod_code, round(prod_limit, 4) AS prod_limit, "
               "update_date, round(new_balance, 4) AS new_balance, round(highest_balance, 4) AS highest_balance, "
               "report_date")


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["dedupe_by_key"] = _with(RAW_PAYMENT) + """
SELECT id, ord, OVD_t1, OVD_t2, OVD_t3, OVD_sum, pay_normal, prod_code
FROM raw_payment QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1"""

ORACLE["tolerant_cast"] = _with(RAW_PAYMENT) + """
SELECT id, ord, round(prod_limit, 4) AS prod_limit, round(new_balance, 4) AS new_balance,
       round(highest_balance, 4) AS highest_balance
FROM raw_payment"""

ORACLE["parse_dates"] = _with(RAW_PAYMENT) + """
SELECT id, ord, update_date, report_date FROM raw_payment"""

ORACLE["not_null_filter"] = _with(RAW_CUSTOMER) + """
SELECT id, copy, round(fea_2, 4) AS fea_2, round(fea_3, 4) AS fea_3, round(fea_4, 4) AS fea_4
FROM raw_customer WHERE fea_2 IS NOT NULL AND fea_3 IS NOT NULL AND fea_4 IS NOT NULL"""

ORACLE["upper_bound_filter"] = _with(RAW_CUSTOMER) + """
SELECT id, copy, round(fea_4, 4) AS fea_4 FROM raw_customer WHERE fea_4 < 1000000"""

ORACLE["sentinel_filter"] = _with(RAW_CUSTOMER) + """
SELECT id, copy, fea_7, fea_8 FROM raw_customer WHERE fea_7 <> -1 AND fea_8 <> -1"""

ORACLE["range_filter"] = _with(RAW_PAYMENT) + """
SELECT id, ord, round(new_balance, 4) AS new_balance FROM raw_payment
WHERE new_balance >= 0 AND new_balance < 2000000"""

ORACLE["impute_mean_raw"] = _with(RAW_PAYMENT) + """
SELECT id, ord, round(coalesce(highest_balance, (SELECT avg(highest_balance) FROM raw_payment)), 4)
       AS highest_balance
FROM raw_payment"""

ORACLE["impute_mean_filtered"] = _with(RAW_PAYMENT) + """
, dedup AS (SELECT * FROM raw_payment QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1),
kept AS (SELECT * FROM dedup WHERE prod_limit IS NOT NULL AND update_date IS NOT NULL AND report_date IS NOT NULL)
SELECT id, OVD_t1, OVD_t2, OVD_t3, OVD_sum, pay_normal, prod_code, round(prod_limit, 4) AS prod_limit,
       update_date, round(new_balance, 4) AS new_balance,
       round(coalesce(highest_balance, (SELECT avg(highest_balance) FROM kept)), 4) AS highest_balance,
       report_date
FROM kept WHERE new_balance >= 0 AND new_balance < 2000000"""

ORACLE["clean_customer"] = _with(RAW_CUSTOMER, CLEAN_CUSTOMER) + f"SELECT {CUSTOMER_OUT} FROM clean_customer"

ORACLE["clean_payment"] = _with(RAW_PAYMENT, CLEAN_PAYMENT) + f"SELECT {PAYMENT_OUT} FROM clean_payment"

ORACLE["conform_columns"] = _with(RAW_CUSTOMER, CLEAN_CUSTOMER) + "SELECT " + CUSTOMER_OUT.replace(
    "fea_1,", "fea_1 AS region_code,") + " FROM clean_customer"

# -- run documents, decoded straight from events ------------------------------

RUN_ITEMS = """
ev AS (
  SELECT event_id AS k, user_id, event_type, value,
         'metadata/' || event_type || '/' || strftime(ts, '%Y-%m-%d') || '.json' AS src,
         strftime(ts, '%Y-%m-%d') AS run_date,
         CAST(epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS st
  FROM events WHERE event_id % 50 <> 0
),
run_items AS (
  SELECT k, 0 AS item_pos, src, run_date, CASE WHEN k % 8 = 0 THEN 'ingest' ELSE 'transform' END AS step,
         st AS start_time, st + value AS end_time, value AS duration_sec,
         CASE WHEN k % 12 = 0 THEN NULL ELSE user_id END AS customer_records,
         CASE WHEN k % 12 = 0 THEN NULL ELSE k END AS payment_records,
         CAST(NULL AS VARCHAR) AS format, src AS path, CAST(NULL AS VARCHAR) AS raw_path,
         CAST(NULL AS VARCHAR) AS is_table, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS error,
         CAST(NULL AS BIGINT) AS row_count,
         CASE WHEN k % 12 = 0 THEN '"n/a"'
              ELSE '{"customer":' || user_id || ',"payment":' || k || '}' END AS records,
         FALSE AS is_list
  FROM ev WHERE k % 4 = 0
  UNION ALL
  SELECT k, 0, src, run_date, 'verify', NULL, NULL, value * 10, NULL, NULL, event_type,
         CASE WHEN k % 3 = 0 OR k % 5 = 0 THEN src ELSE 'out/' || event_type || '/' || k END,
         CASE WHEN k % 3 = 0 THEN '' WHEN k % 5 = 0 THEN NULL ELSE 'out/' || event_type || '/' || k END,
         CASE WHEN event_type = 'purchase' THEN 'true' ELSE 'false' END,
         CASE WHEN event_type = 'error' THEN 'failed' WHEN k % 9 = 1 THEN 'warning' ELSE 'success' END,
         CASE WHEN event_type = 'error' THEN 'boom ' || k END,
         CASE WHEN event_type = 'error' THEN NULL ELSE user_id * 5 END,
         NULL, TRUE
  FROM ev WHERE k % 4 <> 0
  UNION ALL
  SELECT k, 1, src, run_date, 'load', NULL, NULL, value, NULL, NULL, NULL, 'warehouse/' || k, 'warehouse/' || k,
         NULL, 'success', NULL, k, NULL, TRUE
  FROM ev WHERE k % 4 = 3
),
alerts AS (
  SELECT *, 'Format ' || coalesce(format, 'null') || ': status=' || coalesce(status, 'null') || ', duration='
            || regexp_replace(CAST(round(coalesce(duration_sec, 0.0), 2) AS VARCHAR), '\\.0$', '')
            || 's, row_count=' || CAST(coalesce(row_count, 1) AS VARCHAR) AS alert
  FROM run_items
  WHERE step = 'verify'
    AND (status IS DISTINCT FROM 'success' OR coalesce(duration_sec, 0) > 300 OR coalesce(row_count, 1) < 100)
)"""

FLOOR4 = "floor({c} * 10000) / 10000 AS {c}"

ORACLE["flatten_runs"] = _with(RUN_ITEMS) + f"""
SELECT run_date, step, {FLOOR4.format(c='start_time')}, {FLOOR4.format(c='end_time')},
       round(duration_sec, 4) AS duration_sec, customer_records, payment_records, format, path, is_table,
       status, error, row_count
FROM run_items"""

ORACLE["flatten_runs_compact"] = _with(RUN_ITEMS) + f"""
SELECT CASE WHEN is_list THEN 'verify' ELSE step END AS step, {FLOOR4.format(c='start_time')},
       {FLOOR4.format(c='end_time')}, round(duration_sec, 4) AS duration_sec, records, format,
       raw_path AS path, status, row_count
FROM run_items"""

ORACLE["evaluate_alerts"] = _with(RUN_ITEMS) + """
SELECT k AS doc_seq, item_pos, format, status, round(duration_sec, 4) AS duration_sec, row_count, alert
FROM alerts"""

ORACLE["alert_status"] = _with(RUN_ITEMS) + """
SELECT count(*) > 0 AS has_alert, count(*) AS n_alerts FROM alerts"""

ORACLE["alert_summary"] = _with(RUN_ITEMS) + """
SELECT src AS source_path, k AS doc_seq, item_pos, alert AS line FROM alerts
UNION ALL
SELECT NULL, NULL, NULL, 'NO_ALERT' WHERE NOT EXISTS (SELECT 1 FROM alerts)"""

ORACLE["notification_text"] = _with(RUN_ITEMS) + """
SELECT 0 AS part, NULL AS source_path, NULL AS doc_seq, NULL AS item_pos,
       CASE WHEN EXISTS (SELECT 1 FROM alerts) THEN 'ledgerflow: results that need attention'
            ELSE 'ledgerflow: every result is in order' END AS line
UNION ALL
SELECT 1, src, k, item_pos, alert FROM alerts"""

ORACLE["step_metrics"] = _with(RUN_ITEMS) + """
, m AS (
  SELECT strftime(make_timestamp(CAST(round(end_time * 1000000) AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%f') AS ts,
         step AS task, CAST(trunc(duration_sec) AS BIGINT) AS duration,
         CASE WHEN coalesce(trunc(duration_sec), 0) > 300 THEN 'warning' ELSE 'success' END AS status
  FROM run_items WHERE step IS NOT NULL AND start_time IS NOT NULL
)
SELECT ts, task, duration, status, concat_ws(',', ts, task, CAST(duration AS VARCHAR), status) AS line FROM m"""

ORACLE["duration_by_step"] = _with(RUN_ITEMS) + """
, g AS (
  SELECT run_date, step, sum(CAST(round(duration_sec * 1000000) AS BIGINT)) AS us, count(duration_sec) AS n,
         max(duration_sec) AS mx, sum(duration_sec) AS tot, count(*) AS n_records
  FROM run_items GROUP BY run_date, step
)
SELECT run_date, step,
       CASE WHEN n > 0 THEN CAST(sign(us) * ((abs(us) * 2 + 100 * n) // (200 * n)) AS DOUBLE) / 10000.0 END
         AS avg_duration_sec,
       round(mx, 4) AS max_duration_sec, round(tot, 4) AS total_duration_sec, n_records
FROM g"""

ORACLE["daily_status"] = _with(RUN_ITEMS) + """
SELECT run_date, status, count(*) AS n_results FROM run_items GROUP BY run_date, status"""

ORACLE["alert_trend"] = _with(RUN_ITEMS) + """
SELECT run_date, count(*) AS n_alerts FROM alerts GROUP BY run_date"""

ORACLE["row_drop_check"] = _with(RUN_ITEMS) + """
, d AS (
  SELECT run_date,
         CAST(sum(CASE WHEN step = 'ingest' THEN customer_records END) AS BIGINT) AS cb,
         CAST(sum(CASE WHEN step = 'transform' THEN customer_records END) AS BIGINT) AS ca,
         CAST(sum(CASE WHEN step = 'ingest' THEN payment_records END) AS BIGINT) AS pb,
         CAST(sum(CASE WHEN step = 'transform' THEN payment_records END) AS BIGINT) AS pa
  FROM run_items GROUP BY run_date
), r AS (
  SELECT run_date, 'customer' AS "table", cb AS records_before, ca AS records_after,
         1.0 - CAST(ca AS DOUBLE) / CAST(nullif(cb, 0) AS DOUBLE) AS drop_ratio
  FROM (SELECT run_date, cb, CASE WHEN ca IS NULL AND cb IS NOT NULL THEN 0 ELSE ca END AS ca FROM d)
  UNION ALL
  SELECT run_date, 'payment', pb, pa, 1.0 - CAST(pa AS DOUBLE) / CAST(nullif(pb, 0) AS DOUBLE)
  FROM (SELECT run_date, pb, CASE WHEN pa IS NULL AND pb IS NOT NULL THEN 0 ELSE pa END AS pa FROM d)
)
SELECT run_date, "table", records_before, records_after, round(drop_ratio, 4) AS drop_ratio,
       coalesce(drop_ratio > 0.1, FALSE) AS flagged
FROM r"""

# -- features, split, scaling, metrics ----------------------------------------

CUSTOMER_NUMERIC = ["region_code"] + [f"fea_{i}" for i in range(2, 12)]
PAYMENT_NUMERIC = ["OVD_t1", "OVD_t2", "OVD_t3", "OVD_sum", "pay_normal", "prod_code", "credit_limit",
                   "new_balance", "highest_balance"]
IMPUTED = CUSTOMER_NUMERIC + PAYMENT_NUMERIC
JOINED_COLUMNS = (["label", "id"] + CUSTOMER_NUMERIC + PAYMENT_NUMERIC[:7] + ["update_date"]
                  + PAYMENT_NUMERIC[7:] + ["report_date"])
DOUBLE_IN_JOIN = {"fea_2", "fea_3", "fea_4", "fea_10", "fea_11", "credit_limit", "new_balance", "highest_balance"}

JOINED = """
cc AS (SELECT label, id, fea_1 AS region_code, fea_2, fea_3, fea_4, fea_5, fea_6, fea_7, fea_8, fea_9, fea_10, fea_11
       FROM clean_customer),
cp AS (SELECT id, OVD_t1, OVD_t2, OVD_t3, OVD_sum, pay_normal, prod_code, prod_limit AS credit_limit, update_date,
              new_balance, highest_balance, report_date FROM clean_payment),
joined AS (SELECT * FROM cc LEFT JOIN cp USING (id))"""

MEDIANS = "med AS (SELECT " + ", ".join(
    f"CAST(median(CAST({c} AS DOUBLE)) AS DOUBLE) AS {c}" for c in IMPUTED) + " FROM joined)"

FILLED = "filled AS (SELECT " + ", ".join(
    (f"coalesce(CAST(j.{c} AS DOUBLE), med.{c}) AS {c}" if c in IMPUTED else f"j.{c} AS {c}")
    for c in JOINED_COLUMNS) + " FROM joined j, med)"

FEATURES = """
features AS (
  SELECT *, new_balance / (credit_limit + 1e-5) AS debt_ratio,
         CAST(coalesce(new_balance > credit_limit, FALSE) AS INTEGER) AS is_over_limit,
         (OVD_t1 + OVD_t2 + OVD_t3) / 3.0 AS mean_ovd
  FROM filled
)"""

HASH_U = "CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || ':42'), 1, 15)) AS BIGINT)"

SPLIT = f"""
split AS (
  SELECT id, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {HASH_U}, id)
                       <= round(0.2 * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS split
  FROM joined
)"""


def _r(c: str, doubles) -> str:
    return f"round({c}, 4) AS {c}" if c in doubles else c


FEATURE_COLS = [c for c in JOINED_COLUMNS if c not in ("label", "id", "update_date", "report_date")] + [
    "debt_ratio", "is_over_limit", "mean_ovd"]
FEATURE_DOUBLES = set(IMPUTED) | {"debt_ratio", "mean_ovd"}

BASE_FEATURES = [RAW_CUSTOMER, CLEAN_CUSTOMER, RAW_PAYMENT, CLEAN_PAYMENT, JOINED]

ORACLE["customer_payment_left_join"] = _with(*BASE_FEATURES) + "SELECT " + ", ".join(
    _r(c, DOUBLE_IN_JOIN) for c in JOINED_COLUMNS) + " FROM joined"

ORACLE["impute_median_all"] = _with(*BASE_FEATURES, MEDIANS, FILLED) + "SELECT " + ", ".join(
    _r(c, set(IMPUTED)) for c in JOINED_COLUMNS) + " FROM filled"

ORACLE["debt_ratio"] = _with(*BASE_FEATURES) + """
SELECT id, round(new_balance, 4) AS new_balance, round(credit_limit, 4) AS credit_limit,
       round(new_balance / (credit_limit + 1e-5), 4) AS debt_ratio FROM joined"""

ORACLE["over_limit_flag"] = _with(*BASE_FEATURES) + """
SELECT id, round(new_balance, 4) AS new_balance, round(credit_limit, 4) AS credit_limit,
       CAST(coalesce(new_balance > credit_limit, FALSE) AS INTEGER) AS is_over_limit FROM joined"""

ORACLE["row_mean_overdue"] = _with(*BASE_FEATURES) + """
SELECT id, OVD_t1, OVD_t2, OVD_t3,
       round((coalesce(OVD_t1, 0) + coalesce(OVD_t2, 0) + coalesce(OVD_t3, 0))
             / nullif(CAST((OVD_t1 IS NOT NULL) AS INTEGER) + CAST((OVD_t2 IS NOT NULL) AS INTEGER)
                      + CAST((OVD_t3 IS NOT NULL) AS INTEGER), 0), 4) AS mean_ovd
FROM joined"""

ORACLE["build_features"] = _with(*BASE_FEATURES, MEDIANS, FILLED, FEATURES) + "SELECT " + ", ".join(
    _r(c, FEATURE_DOUBLES) for c in JOINED_COLUMNS + ["debt_ratio", "is_over_limit", "mean_ovd"]) + " FROM features"

ORACLE["stratified_split"] = _with(*BASE_FEATURES, SPLIT) + """
SELECT j.id, j.label, s.split FROM joined j JOIN split s USING (id)"""

_STATS = "st AS (SELECT " + ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS {c}_m, stddev_pop(CAST({c} AS DOUBLE)) AS {c}_s" for c in FEATURE_COLS
) + " FROM features JOIN split USING (id) WHERE split = 'train')"

ORACLE["standardise"] = _with(*BASE_FEATURES, MEDIANS, FILLED, FEATURES, SPLIT, _STATS) + "SELECT f.id, f.label, s.split, " + \
    ", ".join(f"round((CAST(f.{c} AS DOUBLE) - st.{c}_m) / CASE WHEN st.{c}_s IS NULL OR st.{c}_s = 0 THEN 1.0 "
              f"ELSE st.{c}_s END, 4) AS {c}" for c in FEATURE_COLS) + \
    " FROM features f JOIN split s USING (id), st"

SCORED = """
scored AS (
  SELECT CAST(l.quality AS INTEGER) AS label, d.n_chars / CAST(20000 AS DOUBLE) AS score,
         CASE WHEN d.doc_id % 29 = 0 THEN 2 ELSE CAST(d.n_chars / CAST(20000 AS DOUBLE) >= 0.05 AS INTEGER) END AS prediction
  FROM labels l JOIN documents d USING (doc_id)
)"""

ORACLE["roc_auc"] = _with(SCORED) + """
, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS ar
        FROM scored),
c AS (SELECT sum(ar) FILTER (WHERE label = 1) AS rs, count(*) FILTER (WHERE label = 1) AS p,
             count(*) FILTER (WHERE label <> 1) AS n FROM r)
SELECT round((rs - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n), 4) AS roc_auc, p AS n_pos, n AS n_neg FROM c"""

ORACLE["confusion_matrix"] = _with(SCORED) + """
SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction"""

ORACLE["classification_report"] = _with(SCORED) + """
, cls AS (SELECT label AS c FROM scored UNION SELECT prediction FROM scored),
per AS (
  SELECT c, (SELECT count(*) FROM scored WHERE label = c) AS support,
            (SELECT count(*) FROM scored WHERE prediction = c) AS predicted,
            (SELECT count(*) FROM scored WHERE label = c AND prediction = c) AS tp
  FROM cls
), m AS (
  SELECT c, support, tp, coalesce(tp / nullif(CAST(predicted AS DOUBLE), 0), 0.0) AS precision,
         coalesce(tp / nullif(CAST(support AS DOUBLE), 0), 0.0) AS recall FROM per
), f AS (
  SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1_score FROM m
)
SELECT CAST(c AS VARCHAR) AS class, round(precision, 4) AS precision, round(recall, 4) AS recall,
       round(f1_score, 4) AS f1_score, support FROM f
UNION ALL
SELECT 'accuracy', NULL, NULL, round(sum(tp) / CAST(sum(support) AS DOUBLE), 4), CAST(sum(support) AS BIGINT) FROM f
UNION ALL
SELECT 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1_score), 4),
       CAST(sum(support) AS BIGINT) FROM f
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 4), round(sum(recall * support) / sum(support), 4),
       round(sum(f1_score * support) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM f"""

# -- SMOTE: the true neighbours of every distinct point ------------------------

_DIMS = 64
_X = [f"x{i}" for i in range(_DIMS)]
_D2 = " + ".join(f"(a.v[{i + 1}] - b.v[{i + 1}]) * (a.v[{i + 1}] - b.v[{i + 1}])" for i in range(_DIMS))

ORACLE["smote_balance"] = f"""
WITH e AS (
  SELECT vec_id AS id, CAST(label = 0 AS INTEGER) AS label, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings
),
cnt AS (SELECT label, count(*) AS c FROM e GROUP BY label),
mino AS (SELECT label AS ml, c AS m FROM cnt ORDER BY c, label LIMIT 1),
params AS (SELECT ml, m, (SELECT max(c) FROM cnt) - m AS s_total, ((SELECT max(c) FROM cnt) - m) // m AS per,
                  ((SELECT max(c) FROM cnt) - m) % m AS extra, least(5, m - 1) AS kk FROM mino),
rows_ AS (SELECT e.* FROM e, params WHERE e.label = params.ml),
pts AS (SELECT min(id) AS vid, count(*) AS mult, v FROM rows_ GROUP BY v),
cand AS (
  SELECT a.vid, b.vid AS y_vid, {_D2} AS d2, b.mult AS w FROM pts a JOIN pts b ON a.vid <> b.vid
  UNION ALL
  SELECT vid, vid, 0.0, mult - 1 FROM pts WHERE mult > 1
),
ranked AS (SELECT *, CAST(sum(w) OVER (PARTITION BY vid ORDER BY d2, y_vid ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum
           FROM cand),
slots AS (SELECT vid, unnest(range(CAST(cum - w AS BIGINT), CAST(least(cum, kk) AS BIGINT))) AS slot, y_vid AS nvid
          FROM ranked, params WHERE cum - w < kk),
keyed AS (SELECT id, row_number() OVER (ORDER BY {HASH_U}, id) AS rk FROM rows_),
alloc AS (SELECT id, per + CASE WHEN rk <= extra THEN 1 ELSE 0 END AS s FROM keyed, params),
rv AS (SELECT r.id, p.vid FROM rows_ r JOIN pts p ON r.v = p.v),
samples AS (SELECT a.id, rv.vid, unnest(range(0, CAST(a.s AS BIGINT))) AS sample FROM alloc a JOIN rv USING (id) WHERE a.s > 0),
sm AS (
  SELECT samples.*,
         CAST(('0x' || substr(md5(concat_ws(':', id, sample, 42, 'slot')), 1, 15)) AS BIGINT) % kk AS slot,
         CAST(('0x' || substr(md5(concat_ws(':', id, sample, 42, 'gap')), 1, 8)) AS BIGINT)
           / CAST(4294967296 AS DOUBLE) AS gap
  FROM samples, params
)
SELECT id, label, {", ".join(f"round(v[{i + 1}], 4) AS {c}" for i, c in enumerate(_X))}, id AS src_id, CAST(NULL AS INTEGER) AS sample
FROM e
UNION ALL
SELECT CAST(NULL AS BIGINT), params.ml,
       {", ".join(f"round(x.v[{i + 1}] + sm.gap * (n.v[{i + 1}] - x.v[{i + 1}]), 4)" for i in range(_DIMS))},
       sm.id, CAST(sm.sample AS INTEGER)
FROM sm JOIN slots ON sm.vid = slots.vid AND sm.slot = slots.slot
     JOIN pts x ON x.vid = sm.vid JOIN pts n ON n.vid = slots.nvid, params"""

# -- boosted stumps: every split from grouped gradient sums ----------------------

FEW_VALUED = ["region_code", "fea_3", "fea_5", "fea_6", "fea_7", "fea_9", "OVD_t1", "OVD_t2", "OVD_sum", "pay_normal"]
_FEW = ", ".join(f"CAST(f.{c} AS DOUBLE) AS {c}" for c in FEW_VALUED)


def _impurity(n: str, s: str, q: str) -> str:
    return f"(({q}) - ({s}) * ({s}) / ({n})) / ({n})"


def _stumps(trees: int, step: float) -> str:
    """CTEs over ``fit_rows (fit, id, label, train, features)``: ``margin<t>`` after ``t`` trees
    (logistic loss, first tree of weight 1) and ``best<t>``, the split of each tree."""
    out = ["long AS MATERIALIZED (SELECT fit, id, train, unnest([" + ", ".join(
        f"struct_pack(f := {i}, v := {c})" for i, c in enumerate(FEW_VALUED)) + "], recursive := true) FROM fit_rows)",
        "margin0 AS MATERIALIZED (SELECT fit, id, 2.0 * label - 1 AS y, CAST(0 AS DOUBLE) AS m FROM fit_rows)"]
    for t in range(trees):
        target = "y" if t == 0 else "4 * y / (1 + exp(2 * y * m))"
        gain = (f"{_impurity('nt', 'st', 'qt')} - nl / nt * {_impurity('nl', 'sl', 'ql')}"
                f" - (nt - nl) / nt * {_impurity('nt - nl', 'st - sl', 'qt - ql')}")
        out += [
            f"hist{t} AS (SELECT l.fit, l.f, l.v, CAST(count(*) AS DOUBLE) AS n, sum(r) AS s, sum(r * r) AS q FROM long l "
            f"JOIN (SELECT fit, id, {target} AS r FROM margin{t}) g ON l.fit = g.fit AND l.id = g.id WHERE l.train GROUP BY ALL)",
            f"cum{t} AS (SELECT fit, f, v, lead(v) OVER o AS nv, sum(n) OVER o AS nl, sum(s) OVER o AS sl, sum(q) OVER o AS ql, "
            f"sum(n) OVER p AS nt, sum(s) OVER p AS st, sum(q) OVER p AS qt FROM hist{t} "
            f"WINDOW o AS (PARTITION BY fit, f ORDER BY v), p AS (PARTITION BY fit, f))",
            f"best{t} AS MATERIALIZED (SELECT fit, f, v, (v + nv) / 2 AS cut, sl / nl AS low, (st - sl) / (nt - nl) AS high, {gain} AS gain, nt "
            f"FROM cum{t} WHERE nv IS NOT NULL QUALIFY row_number() OVER (PARTITION BY fit ORDER BY round(gain, 10) DESC, f, v) = 1)",
            f"margin{t + 1} AS MATERIALIZED (SELECT a.fit, a.id, a.y, a.m + {1.0 if t == 0 else step} * CASE WHEN l.v <= b.cut THEN b.low ELSE b.high END AS m "
            f"FROM margin{t} a JOIN best{t} b ON a.fit = b.fit JOIN long l ON l.fit = a.fit AND l.id = a.id AND l.f = b.f)"]
    return ",\n".join(out)


_FIT_ONCE = f"""
fit_rows AS MATERIALIZED (SELECT 0 AS fit, f.id, f.label, s.split = 'train' AS train, {_FEW} FROM features f JOIN split s USING (id))"""
_STUMP_BASE = _with(*BASE_FEATURES, MEDIANS, FILLED, FEATURES, SPLIT, _FIT_ONCE, _stumps(3, 0.1))

ORACLE["stumps_predict"] = _STUMP_BASE + """
SELECT id, r.label, CAST(m > 0 AS INTEGER) AS prediction, round(1 / (1 + exp(-2 * m)), 4) AS score
FROM margin3 JOIN fit_rows r USING (fit, id) WHERE NOT r.train"""
ORACLE["model_round_trip"] = ORACLE["train_from_csv"] = ORACLE["stumps_predict"]

ORACLE["stumps_importance"] = _STUMP_BASE + """
, worth AS (SELECT f, sum(gain * nt) AS g FROM (""" + " UNION ALL ".join(f"SELECT f, gain, nt FROM best{t}" for t in range(3)) + """) GROUP BY f)
SELECT [""" + ", ".join(f"'{c}'" for c in FEW_VALUED) + """][f + 1] AS feature, round(g / sum(g) OVER (), 4) AS importance
FROM worth WHERE g > 0 ORDER BY g DESC LIMIT 10"""

FOLDS = f"""
folds AS MATERIALIZED (
  SELECT id, label, CAST((rk > n * 1 // 3) AS INTEGER) + CAST((rk > n * 2 // 3) AS INTEGER) AS fold FROM (
    SELECT j.id, j.label, row_number() OVER (PARTITION BY j.label ORDER BY {HASH_U.replace(':42', ':43').replace('CAST(id', 'CAST(j.id')}, j.id) AS rk,
           count(*) OVER (PARTITION BY j.label) AS n
    FROM joined j JOIN split s USING (id) WHERE s.split = 'train'))"""
_FIT_FOLDS = f"""
fit_rows AS MATERIALIZED (SELECT k AS fit, f.id, f.label, d.fold <> k AS train, {_FEW} FROM features f JOIN folds d USING (id), range(3) r(k))"""

ORACLE["grid_search_folds"] = _with(*BASE_FEATURES, MEDIANS, FILLED, FEATURES, SPLIT, FOLDS, _FIT_FOLDS, _stumps(3, 0.1)) + """
, told AS (SELECT 0 AS point, 1 AS maxIter, fit, id, m FROM margin1 UNION ALL SELECT 1, 3, fit, id, m FROM margin3),
scores AS (SELECT t.*, r.label FROM told t JOIN fit_rows r USING (fit, id) WHERE NOT r.train),
ranked AS (SELECT *, rank() OVER (PARTITION BY point, fit ORDER BY round(m, 10))
                     + (count(*) OVER (PARTITION BY point, fit, round(m, 10)) - 1) / 2.0 AS ar FROM scores),
c AS (SELECT point, maxIter, fit, sum(ar) FILTER (WHERE label = 1) AS rs, count(*) FILTER (WHERE label = 1) AS p,
             count(*) FILTER (WHERE label <> 1) AS n FROM ranked GROUP BY ALL)
SELECT CAST(point AS INTEGER) AS point, maxIter, 1 AS maxDepth, CAST(0.1 AS DOUBLE) AS stepSize, CAST(1 AS DOUBLE) AS subsamplingRate,
       CAST(fit AS INTEGER) AS fold, p AS n_pos, n AS n_neg, (SELECT count(*) FROM folds WHERE fold <> fit) AS n_fitted,
       round((rs - p * (p + 1) / 2.0) / nullif(CAST(p AS DOUBLE) * n, 0), 4) AS roc_auc FROM c"""

ORACLE["fold_resampling"] = _with(*BASE_FEATURES, SPLIT, FOLDS) + """
, c AS (SELECT k AS fold, label, count(*) FILTER (WHERE fold <> k) AS n, count(*) FILTER (WHERE fold = k) AS n_left_out
        FROM folds, range(3) r(k) GROUP BY ALL)
SELECT CAST(fold AS INTEGER) AS fold, label, max(n) OVER (PARTITION BY fold) AS n_fitted, n_left_out FROM c"""

ORACLE["best_training_runs"] = """
WITH scored AS (SELECT d.lang, CAST(l.quality AS INTEGER) AS label, d.n_chars / CAST(20000 AS DOUBLE) AS score
                FROM labels l JOIN documents d USING (doc_id) WHERE d.lang IS NOT NULL),
two AS (SELECT 'long_texts' AS run_name, * FROM scored UNION ALL SELECT 'short_texts', lang, label, -score FROM scored),
r AS (SELECT run_name, lang, label, rank() OVER (PARTITION BY run_name, lang ORDER BY score)
             + (count(*) OVER (PARTITION BY run_name, lang, score) - 1) / 2.0 AS ar FROM two),
c AS (SELECT run_name, lang, sum(ar) FILTER (WHERE label = 1) AS rs, count(*) FILTER (WHERE label = 1) AS p,
             count(*) FILTER (WHERE label <> 1) AS n FROM r GROUP BY ALL),
a AS (SELECT run_name, lang, (rs - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n) AS auc FROM c WHERE p > 0 AND n > 0)
SELECT run_name, lang AS run_id, round(auc, 4) AS value, count(*) OVER (PARTITION BY run_name) AS n_runs
FROM a QUALIFY row_number() OVER (PARTITION BY run_name ORDER BY auc DESC, lang) = 1"""

ORACLE["median_sketches"] = _with(RAW_PAYMENT, CLEAN_PAYMENT) + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, TRUE AS within_error FROM clean_payment"""
    for c in ("prod_limit", "new_balance", "highest_balance"))

# -- sources and sinks ----------------------------------------------------------

ORACLE["csv_roundtrip"] = _with(RAW_PAYMENT, CLEAN_PAYMENT) + "SELECT " + PAYMENT_OUT.replace(
    "round(prod_limit, 4) AS prod_limit", "round(prod_limit, 4) AS credit_limit") + " FROM clean_payment"

ORACLE["parquet_roundtrip"] = ORACLE["conform_columns"]

_COUNTS = _with(RAW_CUSTOMER, CLEAN_CUSTOMER, RAW_PAYMENT, CLEAN_PAYMENT) + """
, f AS (SELECT * FROM (VALUES ('csv'), ('parquet'), ('orc'), ('json')) t(format)),
n AS (SELECT 'customer' AS "table", count(*) AS row_count FROM clean_customer
      UNION ALL SELECT 'payment', count(*) FROM clean_payment)
"""

ORACLE["fan_out_counts"] = _COUNTS + """SELECT n."table", f.format, 'success' AS status, n.row_count FROM n, f"""

ORACLE["verify_tables"] = ORACLE["fan_out_counts"]

ORACLE["run_pipeline_status"] = _with(RAW_CUSTOMER, CLEAN_CUSTOMER, RAW_PAYMENT, CLEAN_PAYMENT) + """
, n AS (SELECT 'customer' AS "table", count(*) AS c FROM clean_customer UNION ALL SELECT 'payment', count(*) FROM clean_payment),
f AS (SELECT * FROM (VALUES ('csv', TRUE), ('parquet', TRUE), ('delta', FALSE), ('hudi', FALSE), ('iceberg', FALSE)) t(format, here))
SELECT s.step, n."table", f.format, CASE WHEN f.here THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN f.here THEN n.c END AS row_count
FROM (VALUES ('fan_out'), ('verify')) s(step), n, f
UNION ALL
SELECT 'load', "table" || '_clean', NULL, 'success', c FROM n"""

ORACLE["load_table_modes"] = _COUNTS + """
SELECT n."table", m.mode, n.row_count * m.k AS row_count, CAST(i.s * m.k AS BIGINT) AS id_sum, i.d AS distinct_ids
FROM n JOIN (SELECT 'customer' AS "table", sum(id) AS s, count(DISTINCT id) AS d FROM clean_customer
             UNION ALL SELECT 'payment', sum(id), count(DISTINCT id) FROM clean_payment) i ON i."table" = n."table",
     (VALUES ('truncate', 1), ('append', 2)) m(mode, k)"""

ORACLE["ingest_run_docs"] = _with(RUN_ITEMS) + """
SELECT step, format, status, row_count, round(duration_sec, 4) AS duration_sec, error, 1 AS missing_paths FROM run_items"""

ORACLE["unreadable_run_docs"] = _with(RUN_ITEMS) + """
SELECT step, format, status, row_count, round(duration_sec, 4) AS duration_sec, error, 1 AS unreadable_files FROM run_items
WHERE k % 4 <> 3"""

ORACLE["rerun_run_table"] = ORACLE["flatten_runs"]

_WHOLE = "CASE WHEN max(abs({c})) <= 2147483647 THEN 'int' WHEN count({c}) > 0 THEN 'bigint' ELSE 'string' END"
_SMALL = "CASE WHEN count({c}) > 0 THEN 'int' ELSE 'string' END"
_REAL = "CASE WHEN count({c}) > 0 THEN 'double' ELSE 'string' END"


def _types(table: str, source: str, kinds: dict[str, str]) -> str:
    return " UNION ALL ".join(f"""SELECT '{table}' AS "table", '{c}' AS "column", {k.format(c=c)} AS type FROM {source}"""
                              for c, k in kinds.items())


ORACLE["infer_csv_types"] = _with(RAW_CUSTOMER, RAW_PAYMENT) + _types("customer", "raw_customer", {
    "label": _SMALL, "id": _WHOLE, "fea_1": _SMALL,
    "fea_2": "CASE WHEN count(*) FILTER (WHERE id % 11 = 0 AND id % 7 <> 0) = 0 AND count({c}) > 0 THEN 'double' ELSE 'string' END",
    **dict.fromkeys(("fea_3", "fea_4"), _REAL), **dict.fromkeys((f"fea_{i}" for i in range(5, 10)), _SMALL),
    "fea_10": _REAL, "fea_11": _REAL, "copy": _SMALL}) + " UNION ALL " + _types("payment", "raw_payment", {
        "id": _WHOLE, "ord": _WHOLE, **dict.fromkeys(("OVD_t1", "OVD_t2", "OVD_t3", "OVD_sum", "pay_normal", "prod_code"), _SMALL),
        "prod_limit": "CASE WHEN count(*) = count({c}) AND count(*) > 0 THEN 'double' ELSE 'string' END", "update_date": "coalesce(max('string'), 'string')",
        "new_balance": _REAL, "highest_balance": _REAL, "report_date": "coalesce(max('string'), 'string')"})

ORACLE["step_metric_log"] = ORACLE["step_metrics"].replace(
    "SELECT ts, task, duration, status, concat_ws(',', ts, task, CAST(duration AS VARCHAR), status) AS line FROM m",
    "SELECT ts, task, duration, status FROM m")

ORACLE["alert_file"] = ORACLE["alert_summary"].replace(
    "SELECT src AS source_path, k AS doc_seq, item_pos, alert AS line", "SELECT alert AS line").replace(
    "SELECT NULL, NULL, NULL, 'NO_ALERT'", "SELECT 'NO_ALERT'")

ORACLE["stream_flatten_runs"] = ORACLE["flatten_runs"]

_SPARK_TYPE = ("CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' "
               "WHEN 'DATE' THEN 'date' WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END")

ORACLE["schema_check"] = f"""
SELECT 'csv' AS copy, column_name AS "column", {_SPARK_TYPE} AS expected_type, 'string' AS actual_type,
       'type' AS issue
FROM (DESCRIBE {_with(RAW_PAYMENT, CLEAN_PAYMENT)} SELECT id, OVD_t1, OVD_t2, OVD_t3, OVD_sum, pay_normal, prod_code,
      prod_limit AS credit_limit, update_date, new_balance, highest_balance, report_date FROM clean_payment)
WHERE {_SPARK_TYPE} <> 'string'"""
