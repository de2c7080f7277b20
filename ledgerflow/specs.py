"""Table specifications of the credit pipeline.

Fixed values: these must equal the reference pipeline's column names,
thresholds and formats for its results to be reproduced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values (reference pipeline) ------------------------------------
DATE_FORMAT = "dd/MM/yyyy"
CUSTOMER_MAX_FEA_4 = 1_000_000
PAYMENT_BALANCE_LOW = 0
PAYMENT_BALANCE_HIGH = 2_000_000
SENTINEL = -1
SLOW_STEP_SECONDS = 300
MIN_ROW_COUNT = 100
NO_ALERT = "NO_ALERT"
ALERT_LINE_FORMAT = "Format %s: status=%s, duration=%ss, row_count=%s"
DEFAULT_LIST_STEP = "verify"
VERIFY_FORMATS = ("csv", "parquet", "delta", "hudi", "iceberg")
RATIO_EPSILON = 1e-5
OVERDUE_COLUMNS = ("OVD_t1", "OVD_t2", "OVD_t3")
TRAINING_DROP_COLUMNS = ("id", "label", "update_date", "report_date")
TEST_FRACTION = 0.2
SEED = 42
CV_FOLDS = 3
SMOTE_NEIGHBOURS = 5
PARAM_GRID = {
    "maxIter": [100, 200],
    "maxDepth": [3, 5],
    "stepSize": [0.05, 0.1],
    "subsamplingRate": [0.8, 1.0],
}
TOP_FEATURES = 10
# ---------------------------------------------------------------------------

PIPELINE_NAME = "ledgerflow"
ALERT_HEADER = "%s: results that need attention"
ALL_GOOD_TEXT = "%s: every result is in order"


@dataclass(frozen=True)
class CleanSpec:
    """What one cleaning pass does, in the order the reference applies it:
    dedupe -> tolerant casts -> date parses -> not-null filter -> mean
    imputation -> range / sentinel filters."""

    key: tuple[str, ...]
    double_columns: tuple[str, ...] = ()
    date_columns: tuple[str, ...] = ()
    date_format: str = DATE_FORMAT
    not_null: tuple[str, ...] = ()
    impute_mean: tuple[str, ...] = ()
    upper_bounds: tuple[tuple[str, float], ...] = ()  # column < bound
    ranges: tuple[tuple[str, float, float], ...] = ()  # lo <= column < hi
    sentinels: tuple[tuple[str, int], ...] = ()  # column != value
    renames: dict[str, str] = field(default_factory=dict)


CUSTOMER_SPEC = CleanSpec(
    key=("id",),
    double_columns=("fea_2",),
    not_null=("fea_2", "fea_3", "fea_4"),
    impute_mean=("fea_11",),
    upper_bounds=(("fea_4", CUSTOMER_MAX_FEA_4),),
    sentinels=(("fea_7", SENTINEL), ("fea_8", SENTINEL)),
    renames={"fea_1": "region_code"},
)

PAYMENT_SPEC = CleanSpec(
    key=("id",),
    double_columns=("prod_limit", "new_balance", "highest_balance"),
    date_columns=("update_date", "report_date"),
    not_null=("prod_limit", "update_date", "report_date"),
    impute_mean=("highest_balance",),
    ranges=(("new_balance", PAYMENT_BALANCE_LOW, PAYMENT_BALANCE_HIGH),),
    renames={"prod_limit": "credit_limit"},
)


# Column names and text types of the dirty inputs (what a
# header + type-inference read of the raw CSVs yields; text where bad cells
# occur).  Used as explicit read schemas so no inference pass is needed.
CUSTOMER_RAW_SCHEMA = ("label int, id bigint, fea_1 int, fea_2 string, fea_3 double, fea_4 double, fea_5 int, "
                       "fea_6 int, fea_7 int, fea_8 int, fea_9 int, fea_10 double, fea_11 double")
PAYMENT_RAW_SCHEMA = ("id bigint, OVD_t1 int, OVD_t2 int, OVD_t3 int, OVD_sum int, pay_normal int, prod_code int, "
                      "prod_limit string, update_date string, new_balance string, highest_balance string, "
                      "report_date string")
