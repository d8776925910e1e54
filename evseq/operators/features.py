"""Window features and scalers.

Row-frame windows go through ``ordered.ordered_window`` so the same call
works per (entity, game), per hot group and over the global order.  Scalers
are fitted with one aggregate (a one-row result read as a scalar subquery)
and applied as plain expressions; no MLlib scaler is used because their
constant-column and std conventions differ from the ones required here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from evseq.operators.aggregates import group_median, scaler_stats
from evseq.operators.filters import drop_nulls
from evseq.operators.joins import null_safe_join
from evseq.operators.ordered import ordered_fill, ordered_window
from evseq.operators.quantiles import exact_quantiles_many


def lead(
    df: DataFrame,
    column: str,
    out: str,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    offset: int = 1,
    strategy: str = "halo",
    **kw,
) -> DataFrame:
    """W1 (no partition, global order) / W2 (in partition): value ``offset`` rows ahead."""

    def build(w: WindowSpec) -> dict[str, Column]:
        return {out: F.lead(F.col(column), offset).over(w)}

    return ordered_window(df, partition_by, order_by, build, before=0, after=offset, strategy=strategy, **kw)


def rolling_mean(
    df: DataFrame,
    columns: Sequence[str],
    window: int,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    suffix: str = "_rolling_mean",
    strategy: str = "halo",
    **kw,
) -> DataFrame:
    """Mean of the last ``window`` rows incl. the current one over
    non-null values (null when all are null); all columns in one window node."""

    def build(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(-(window - 1), 0)
        return {f"{c}{suffix}": F.avg(F.col(c).cast("double")).over(frame) for c in columns}

    return ordered_window(df, partition_by, order_by, build, before=window - 1, after=0, strategy=strategy, **kw)


def fill_backward(df: DataFrame, column: str, out: str, order_by: Sequence[str], partition_by: Sequence[str] = (), strategy: str = "halo", **kw) -> DataFrame:
    """Current or next non-null value in the partition (looks ahead)."""
    return ordered_fill(df, partition_by, order_by, column, out, "backward", True, strategy=strategy, **kw)


def last_value_before(df: DataFrame, column: str, out: str, order_by: Sequence[str], partition_by: Sequence[str] = (), strategy: str = "halo", **kw) -> DataFrame:
    """Last non-null value strictly before the row (leak-free)."""
    return ordered_fill(df, partition_by, order_by, column, out, "forward", False, strategy=strategy, **kw)


def group_stat_to_rows(df: DataFrame, by: Sequence[str], column: str, out: str) -> DataFrame:
    """Exact group median attached to every row (distributed quantile + join, not a window)."""
    med = group_median(df, by, column, out)
    return null_safe_join(df, med, by).select(*df.columns, out)


def impute_group_median(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Null -> exact median of the row's group (all columns in one
    distributed quantile pass; a null group key is a group)."""
    q = exact_quantiles_many(df, columns, [0.5], by)
    meds = q.groupBy(*by).agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"_med_{c}") for c in columns])
    joined = null_safe_join(df, meds, by)
    filled = joined.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_med_{c}").cast(df.schema[c].dataType)) for c in columns}
    )
    return filled.select(*df.columns)


def next_event_target(
    df: DataFrame,
    column: str,
    out: str,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    strategy: str = "halo",
    **kw,
) -> DataFrame:
    """Next value in the partition; rows without a target (or without a
    current value) are dropped."""
    led = lead(df, column, out, order_by, partition_by, 1, strategy=strategy, **kw)
    return drop_nulls(led, [out, column])


def min_max_scale(df: DataFrame, columns: Sequence[str], fit_on: Column | None = None, suffix: str = "") -> DataFrame:
    """``(x - min) / (max - min)``; a constant column gives 0; null and NaN
    pass through; min/max ignore NaN; fitted on rows matching ``fit_on``."""
    st = _fit_scalar(scaler_stats(df, columns, fit_on))
    exprs = {}
    for c in columns:
        lo, hi = st[f"{c}__min"], st[f"{c}__max"]
        rng = hi - lo
        scale = F.when(rng == 0, F.lit(1.0)).otherwise(rng)
        exprs[f"{c}{suffix}"] = (F.col(c).cast("double") - lo) / scale
    return df.withColumns(exprs)


def _fit_scalar(stats: DataFrame) -> Column:
    """The one-row fit as a struct-valued scalar subquery (no join)."""
    return stats.select(F.struct(*stats.columns).alias("_fit")).scalar()


def standard_scale(df: DataFrame, columns: Sequence[str], fit_on: Column | None = None, suffix: str = "") -> DataFrame:
    """``(x - mean) / std`` with population std fitted on ``fit_on`` rows
    (e.g. the train split) and applied to all; a constant column gives 0."""
    st = _fit_scalar(scaler_stats(df, columns, fit_on))
    exprs = {}
    for c in columns:
        mu, sd = st[f"{c}__mean"], st[f"{c}__std"]
        scale = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        exprs[f"{c}{suffix}"] = (F.col(c).cast("double") - mu) / scale
    return df.withColumns(exprs)
