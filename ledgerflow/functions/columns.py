"""Column-expression helpers.

All helpers build Catalyst expressions from ``pyspark.sql.functions``; none
runs Python per row.  They are ANSI-safe: bad input gives NULL, not an error.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.specs import ALERT_LINE_FORMAT


def _epoch_ntz() -> Column:
    # text -> TIMESTAMP_NTZ involves no time zone
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_double(c: str | Column) -> Column:
    """Numeric cast where unparseable text becomes NULL (``try_cast``)."""
    return _c(c).try_cast("double")


def parse_date(c: str | Column, fmt: str) -> Column:
    """Parse text with a fixed pattern; unparseable text becomes NULL."""
    return F.try_to_date(_c(c), fmt)


def nan_to_null(c: str | Column) -> Column:
    """Map NaN to NULL so aggregates skip it (pandas semantics)."""
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def safe_ratio(num: str | Column, den: str | Column, eps: float) -> Column:
    """``num / (den + eps)``; a zero denominator gives NULL instead of raising."""
    return F.try_divide(_c(num), _c(den) + F.lit(eps))


def over_limit_flag(value: str | Column, limit: str | Column) -> Column:
    """1 when value > limit, else 0; a missing side compares false -> 0."""
    return F.coalesce((_c(value) > _c(limit)).cast("int"), F.lit(0))


def row_mean(cols: list[str] | tuple[str, ...]) -> Column:
    """Mean of the non-missing values of a row; all missing -> NULL."""
    present = F.filter(F.array(*[nan_to_null(F.col(c).cast("double")) for c in cols]),
                       lambda x: x.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.nullif(F.size(present), F.lit(0)).cast("double"))


def epoch_seconds(ts: str | Column) -> Column:
    """Seconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of session zone."""
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), _c(ts)) / F.lit(1_000_000.0)


def epoch_to_iso(seconds: str | Column) -> Column:
    """UTC ISO text ``yyyy-MM-ddTHH:mm:ss.SSSSSS`` of epoch seconds."""
    micros = F.round(_c(seconds) * F.lit(1_000_000.0)).try_cast("long")
    ts = F.timestamp_add("MICROSECOND", micros, _epoch_ntz())
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def number_text(c: str | Column, digits: int = 2) -> Column:
    """Number as text, rounded, without a trailing ``.0`` (``7.0`` -> ``7``)."""
    return F.regexp_replace(F.round(_c(c).cast("double"), digits).cast("string"), r"\.0$", "")


def step_status(duration: str | Column, threshold: float) -> Column:
    """``warning`` when the whole-second duration exceeds the threshold;
    a missing or zero duration counts as ``success``.  ``int(d) > t`` is
    ``d >= floor(t) + 1`` for every double, so no integer cast is needed."""
    d = _c(duration).try_cast("double")
    slow = F.coalesce(d >= F.lit(float(math.floor(threshold) + 1)), F.lit(False))
    return F.when(slow, F.lit("warning")).otherwise(F.lit("success"))


def alert_line(fmt: str | Column, status: str | Column, duration: str | Column, rows: str | Column) -> Column:
    """``Format X: status=S, duration=Ds, row_count=N`` with JSON-null rendering."""
    return F.format_string(
        ALERT_LINE_FORMAT,
        F.coalesce(_c(fmt), F.lit("null")),
        F.coalesce(_c(status), F.lit("null")),
        number_text(_c(duration)),
        _c(rows).cast("string"),
    )
