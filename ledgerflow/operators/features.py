"""Training-frame construction: customer-payment join, median imputation,
derived credit features.

Plan notes: both join sides are unique per ``id`` after cleaning, so the
left join has no fan-out and no key skew; AQE picks broadcast or
sort-merge from runtime sizes.  Medians are exact but computed with
``select_ranks`` (bounded bands, no single-task sort) and substituted as a
one-row scalar subquery.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.columns import over_limit_flag, row_mean, safe_ratio
from ledgerflow.operators.quantiles import exact_medians
from ledgerflow.sources.scratch import reliable_checkpoint
from ledgerflow.specs import OVERDUE_COLUMNS, RATIO_EPSILON, TRAINING_DROP_COLUMNS


def customer_payment_join(customer: DataFrame, payment: DataFrame, key: str = "id") -> DataFrame:
    """Left outer equi-join: every customer kept, the key appears once."""
    return customer.join(payment, key, "left")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the numeric columns (the reference's ``numeric_only``)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in ex]


def impute_median(df: DataFrame, columns: Iterable[str] | None = None, exclude: Iterable[str] = ("id", "label"),
                  approximate: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Fill NULL/NaN cells of numeric columns with the column median.

    Imputed columns become double (a median of integers can be x.5, as
    pandas turns such columns to float).  ``approximate=True`` uses
    ``percentile_approx`` (one sketch pass) instead of the exact median.
    """
    cols = list(columns) if columns is not None else numeric_columns(df, exclude)
    if not cols:
        return df
    if approximate:
        med = df.select(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
                                              0.5, accuracy).cast("double").alias(c) for c in cols])
    else:
        med = exact_medians(df, cols)
    # one row (one value per column) comes back as literals: later jobs do
    # not recompute the median selection
    values = med.first().asDict()
    fills = {}
    for c in cols:
        x = F.col(c).cast("double")
        fills[c] = F.when(x.isNull() | F.isnan(x), F.lit(values[c]).cast("double")).otherwise(x)
    return df.withColumns(fills)


def add_credit_features(df: DataFrame, balance: str = "new_balance", limit: str = "credit_limit",
                        overdue: Iterable[str] = OVERDUE_COLUMNS) -> DataFrame:
    """``debt_ratio``, ``is_over_limit``, ``mean_ovd``."""
    return df.withColumns({
        "debt_ratio": safe_ratio(balance, limit, RATIO_EPSILON),
        "is_over_limit": over_limit_flag(balance, limit),
        "mean_ovd": row_mean(list(overdue)),
    })


def build_features(customer: DataFrame, payment: DataFrame, approximate_median: bool = False) -> DataFrame:
    """join -> median fill -> debt_ratio, is_over_limit, mean_ovd.

    The joined frame is read twice (medians, then the fill), so it is
    materialised once in the shared checkpoint folder instead of repeating
    both cleanings and the join.
    """
    joined = reliable_checkpoint(customer_payment_join(customer, payment))
    return add_credit_features(impute_median(joined, approximate=approximate_median))


def feature_columns(df: DataFrame, drop: Iterable[str] = TRAINING_DROP_COLUMNS) -> list[str]:
    """The model inputs: every column except key, label and dates."""
    dropped = set(drop)
    return [c for c in df.columns if c not in dropped]
