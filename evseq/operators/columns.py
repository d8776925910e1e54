"""Projections and column operators.

All of these are narrow transformations: one Project node each, no shuffle.
Column picks by type walk ``df.schema`` on the driver (metadata only).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from evseq.functions.exprs import fill_nan


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P1."""
    return df.select(*cols)


def add_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns in one projection."""
    return df.withColumns(dict(exprs))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P3."""
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P4."""
    return df.drop(*cols)


def map_columns(df: DataFrame, cols: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """P5: the same expression over many columns (keeps column order)."""
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of numeric columns, minus ``exclude``, in schema order."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ex]


def float_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in ex]


def columns_except(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """P7."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """ANSI cast (raises on overflow / bad text) or ``try_cast`` (null)."""
    if strict:
        return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def unnest(df: DataFrame, struct_col: str) -> DataFrame:
    """P10: replace a struct column by its fields."""
    others = [c for c in df.columns if c != struct_col]
    return df.select(*others, f"{struct_col}.*")


def fill_null_numeric(df: DataFrame, value=-1, exclude: Iterable[str] = ()) -> DataFrame:
    """Null -> ``value`` in every numeric column; NaN and text untouched."""
    cols = numeric_columns(df, exclude)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType)) for c in cols})


def fill_nan_float(df: DataFrame, value=-1.0, exclude: Iterable[str] = ()) -> DataFrame:
    """NaN -> ``value`` in every float column; null untouched."""
    return df.withColumns({c: fill_nan(c, value) for c in float_columns(df, exclude)})


def fill_sentinels(df: DataFrame, groups: Sequence[tuple[object, Sequence[str]]]) -> DataFrame:
    """Null -> sentinel per column group, e.g. ``[(-1, [...]), (-1.0, [...]), ('N/A', [...])]``
    (pairs, not a dict: ``-1`` and ``-1.0`` are the same dict key)."""
    exprs = {}
    for value, cols in groups:
        for c in cols:
            exprs[c] = F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType))
    return df.withColumns(exprs)
