"""Lookup joins.

No join carries a broadcast hint: with AQE on, Spark measures the built side at
runtime and switches to a broadcast hash join only when its bytes are under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it stays a shuffled
join (with skew-join splitting).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(df: DataFrame, other: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Join on group keys where a null key is a group of its own; the result
    has the columns of ``df`` and then those of ``other`` that are no keys."""
    s = other.select(*[F.col(k).alias(f"_k_{k}") for k in by], *[c for c in other.columns if c not in by])
    cond = None
    for k in by:
        term = df[k].eqNullSafe(s[f"_k_{k}"])
        cond = term if cond is None else cond & term
    return df.join(s, cond, how).drop(*[f"_k_{k}" for k in by])


def semi_join(big: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``big`` whose key is in ``keys`` (null keys never match)."""
    return big.join(keys.select(*([on] if isinstance(on, str) else on)), on, "left_semi")


def strict_lookup(
    df: DataFrame,
    mapping: DataFrame,
    on: Sequence[str],
    value_col: str,
    out: str,
    source_col: str,
) -> DataFrame:
    """Data-derived map joined on ``on``; a non-null ``source_col`` without
    a match raises (strict), null passes."""
    joined = null_safe_join(df, mapping.select(*on, F.col(value_col).alias("_hit")), list(on))
    src = F.col(source_col)
    checked = (
        F.when(src.isNull(), F.lit(None).cast(mapping.schema[value_col].dataType))
        .when(F.col("_hit").isNull(), F.raise_error(F.concat(F.lit("unmapped value: "), src.cast("string"))))
        .otherwise(F.col("_hit"))
    )
    return joined.withColumn(out, checked).drop("_hit")


def inverse_lookup(
    codes: DataFrame,
    mapping: DataFrame,
    on: Sequence[str],
    name_col: str,
    out: str,
    code_col: str,
    default_prefix: str = "Unknown-",
) -> DataFrame:
    """Code -> name, ``Unknown-{code}`` when the code is not in the map."""
    m = mapping.select(*on, F.col(name_col).alias("_name"))
    joined = null_safe_join(codes, m, list(on))
    name = F.coalesce(F.col("_name"), F.concat(F.lit(default_prefix), F.col(code_col).cast("string")))
    return joined.withColumn(out, name).drop("_name")
