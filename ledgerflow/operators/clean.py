"""Cleaning operators: dedupe, tolerant casts, filters, mean imputation,
and the composite customer / payment cleaning passes.

Plan notes (scale):
* ``dedupe_by_key`` is one hash shuffle on the key with a map-side partial
  aggregate (``partial_min_by``), so a key holding a third of all rows is
  reduced to one row per map task before it crosses the network.  Its state
  is a struct, so Spark sorts by key on both sides of the shuffle.
* ``impute_mean`` computes the mean as a scalar subquery: a one-row partial
  + final aggregate whose result is substituted as a literal - no join, and
  the main plan keeps its filter pushdown.
* filters are plain predicates; Catalyst merges them and pushes the ones
  that sit directly on a scan into Parquet.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.columns import nan_to_null, parse_date, tolerant_double
from ledgerflow.specs import CUSTOMER_SPEC, PAYMENT_SPEC, CleanSpec


def dedupe_by_key(df: DataFrame, keys: Iterable[str], order_by: Iterable[str] | None = None) -> DataFrame:
    """Keep one row per key.

    ``order_by=None`` keeps an arbitrary survivor (``dropDuplicates``).  With
    ``order_by`` the survivor is the row with the smallest order value
    (lexicographic over the listed columns, NULL last), which makes every sink
    and every recomputation agree.  NULL keys form one group.
    """
    keys = list(keys)
    if order_by is None:
        return df.dropDuplicates(keys)
    order_by = list(order_by)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    # a struct is never NULL, so rows whose order values are NULL keep their content
    order = F.struct(*[part for c in order_by for part in (F.col(c).isNull(), F.col(c))])
    survivor = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in others]), order).alias("_survivor"))
    return survivor.select(*[F.col(k) for k in keys], *[F.col(f"_survivor.{c}").alias(c) for c in others]).select(
        *df.columns
    )


def tolerant_cast(df: DataFrame, columns: Iterable[str], to: str = "double") -> DataFrame:
    """Cast columns; unparseable values become NULL (ANSI-safe)."""
    return df.withColumns({c: (tolerant_double(c) if to == "double" else F.col(c).try_cast(to)) for c in columns})


def parse_dates(df: DataFrame, columns: Iterable[str], fmt: str) -> DataFrame:
    """Parse text dates with ``fmt``; bad text -> NULL; DATE columns pass through."""
    types = dict(df.dtypes)
    out = {}
    for c in columns:
        if types.get(c) == "date":
            continue
        if types.get(c, "").startswith("timestamp"):
            out[c] = F.to_date(F.col(c))
        else:
            out[c] = parse_date(c, fmt)
    return df.withColumns(out) if out else df


def not_null_filter(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows where every listed column is non-NULL."""
    cond = _all([F.col(c).isNotNull() for c in columns])
    return df if cond is None else df.filter(cond)


def upper_bound_filter(df: DataFrame, column: str, bound: float) -> DataFrame:
    """Keep ``column < bound`` (NULL is dropped)."""
    return df.filter(F.col(column) < F.lit(bound))


def sentinel_filter(df: DataFrame, columns: Iterable[str] | dict[str, int], sentinel: int = -1) -> DataFrame:
    """Drop rows where a column equals its sentinel; NULL is dropped too
    (three-valued logic, as ``c != -1`` in the reference)."""
    pairs = columns.items() if isinstance(columns, dict) else [(c, sentinel) for c in columns]
    cond = _all([F.col(c) != F.lit(v) for c, v in pairs])
    return df if cond is None else df.filter(cond)


def range_filter(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Keep the half-open range ``low <= column < high`` (NULL is dropped)."""
    c = F.col(column)
    return df.filter((c >= F.lit(low)) & (c < F.lit(high)))


def column_means(source: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: the mean of every listed column of ``source``.

    Values are read through ``try_cast(double)`` so a text column with bad
    cells (an inferred string column) averages its numeric cells; NaN is
    skipped.  A global aggregate with map-side partials.
    """
    return source.select(*[F.avg(nan_to_null(tolerant_double(c))).alias(c) for c in columns])


def impute_mean(df: DataFrame, columns: Iterable[str], source: DataFrame | None = None) -> DataFrame:
    """Fill NULL (and NaN) cells with the column mean.

    ``source`` is the frame the mean is taken over: the raw scan for the
    reference's staged pipeline ("raw scope") or ``df`` itself ("filtered
    scope").  A NULL mean (no value at all) leaves the cells NULL.  The fill
    value is cast to the column type (an int column truncates, as
    ``fillna`` does).  One column: a scalar subquery (one plan); several:
    one aggregate job whose single row is substituted as literals.
    """
    columns = list(columns)
    if not columns:
        return df
    means = column_means(df if source is None else source, columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    if len(columns) == 1:
        fill = {columns[0]: means.scalar()}
    else:  # several means: one aggregate job, the single row comes back as literals
        row = means.first()
        fill = {c: F.lit(row[c]).cast("double") for c in columns}
    base = df
    out = {}
    for c in columns:
        col = F.col(c)
        missing = col.isNull()
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(col)
        out[c] = F.when(missing, fill[c].cast(types[c])).otherwise(col)
    return base.withColumns(out)


def conform_columns(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Rename columns; names that are absent are ignored."""
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def clean_table(
    raw: DataFrame,
    spec: CleanSpec,
    order_by: Iterable[str] | None = None,
    scope: str = "raw",
) -> DataFrame:
    """One cleaning pass in the reference order.

    ``scope="raw"``: the imputation mean is taken over the scanned frame
    (before dedupe and filters), as the staged ingest job does.
    ``scope="filtered"``: over the deduped, cast, not-null-filtered frame,
    as the single-file job does.
    """
    if scope not in ("raw", "filtered"):
        raise ValueError(f"scope must be 'raw' or 'filtered', not {scope!r}")
    df = dedupe_by_key(raw, spec.key, order_by)
    df = tolerant_cast(df, spec.double_columns)
    df = parse_dates(df, spec.date_columns, spec.date_format)
    df = not_null_filter(df, spec.not_null)
    df = impute_mean(df, spec.impute_mean, source=raw if scope == "raw" else df)
    for column, bound in spec.upper_bounds:
        df = upper_bound_filter(df, column, bound)
    for column, low, high in spec.ranges:
        df = range_filter(df, column, low, high)
    if spec.sentinels:
        df = sentinel_filter(df, dict(spec.sentinels))
    return df


def clean_customer(raw: DataFrame, order_by: Iterable[str] | None = None, scope: str = "raw",
                   spec: CleanSpec = CUSTOMER_SPEC) -> DataFrame:
    """dedupe(id) -> try_cast(fea_2) -> not-null(fea_2, fea_3, fea_4) ->
    mean(fea_11) -> fea_4 < 1e6 -> fea_7, fea_8 != -1."""
    return clean_table(raw, spec, order_by, scope)


def clean_payment(raw: DataFrame, order_by: Iterable[str] | None = None, scope: str = "raw",
                  spec: CleanSpec = PAYMENT_SPEC) -> DataFrame:
    """dedupe(id) -> try_cast x3 -> dates dd/MM/yyyy -> not-null(limit, dates)
    -> mean(highest_balance) -> 0 <= new_balance < 2e6."""
    return clean_table(raw, spec, order_by, scope)


def conform_customer(df: DataFrame, spec: CleanSpec = CUSTOMER_SPEC) -> DataFrame:
    return conform_columns(df, spec.renames)


def conform_payment(df: DataFrame, spec: CleanSpec = PAYMENT_SPEC) -> DataFrame:
    return conform_columns(df, spec.renames)


def _all(conds: list[Column]) -> Column | None:
    out = None
    for c in conds:
        out = c if out is None else out & c
    return out
