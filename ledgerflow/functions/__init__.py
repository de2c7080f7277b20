from ledgerflow.functions.columns import (  # noqa: F401
    alert_line,
    epoch_seconds,
    epoch_to_iso,
    nan_to_null,
    number_text,
    over_limit_flag,
    parse_date,
    row_mean,
    safe_ratio,
    step_status,
    tolerant_double,
)
