"""Filters and predicates.

Literal predicates (F2, F4, F3 with a literal list, S5) are pushed into the
Parquet scan by Catalyst.  Data-dependent predicates are computed by an
aggregate with a structural size bound: F1's max year is a scalar subquery,
J1's top entities a k-row side broadcast into a semi join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evseq.operators.joins import semi_join


def recent_years(df: DataFrame, date_col: str, n_years: int, year_col: str | None = None) -> DataFrame:
    """keep ``year(date_col) >= max(year) - n_years`` (inclusive, so n+1 years)."""
    # scalar subquery: one partial aggregate (from file statistics where the
    # format has them); the bound is on the bare column, so it reaches the scan
    first_year = F.year(F.max(date_col)) - F.lit(n_years)
    bound = df.select(F.make_date(first_year, F.lit(1), F.lit(1)).cast(df.schema[date_col].dataType)).scalar()
    out = df.filter(F.col(date_col) >= bound)
    yr = F.year(F.col(date_col)).cast("int")
    if year_col:
        out = out.withColumn(year_col, yr)
    return out


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """drop rows with null in any of ``subset``; NaN is a value and stays."""
    cond = None
    for c in subset:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return df.filter(cond) if cond is not None else df


def is_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """F3 (literal list): null never matches."""
    return df.filter(F.col(column).isin(list(values)))


def equals(df: DataFrame, column: str, value) -> DataFrame:
    """F4."""
    return df.filter(F.col(column) == F.lit(value))


def case_when(branches: Sequence[tuple[Column, Column | object]], otherwise: Column | object) -> Column:
    """``when/then/otherwise``; a null condition falls through."""
    expr = None
    for cond, val in branches:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    o = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return expr.otherwise(o)


def top_k_keys(df: DataFrame, key: str, count_col: str, k: int) -> DataFrame:
    """A2: the k keys with most non-null ``count_col``; ties broken by key."""
    counts = df.groupBy(key).agg(F.count(F.col(count_col)).alias("count"))
    return counts.orderBy(F.col("count").desc(), F.col(key).asc_nulls_first()).limit(k)


def rows_of_top_k(df: DataFrame, key: str, count_col: str, k: int) -> DataFrame:
    """Rows of the top-k keys (semi join with a k-row broadcast side)."""
    return semi_join(df, top_k_keys(df, key, count_col, k).select(key), key)


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None, keep_first_by: Sequence[str] | None = None) -> DataFrame:
    """F8: one row per ``subset`` key; with ``keep_first_by`` the first row in
    that order (deterministic).  Uses ``min_by`` so the reduction is partial
    (map-side) and a hot key does not gather its rows in one task."""
    if not subset:
        return df.distinct()
    if not keep_first_by:
        return df.dropDuplicates(list(subset))
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.select(*subset).distinct()
    order = F.struct(*[F.col(c) for c in keep_first_by])
    picked = df.groupBy(*subset).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), order).alias("_r"))
    return picked.select(*subset, "_r.*").select(*df.columns)
