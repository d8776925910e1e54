"""Aggregations and profiling.

Every aggregate is a ``groupBy().agg()`` so Spark combines partially on the
map side before the shuffle: a key holding a third of the rows is reduced to
one partial row per task first.  Windows appear only over tables already
reduced to (entity, class) counts.  Percentiles are exact (linear
interpolation) and distributed: see ``quantiles`` (no group's values are
gathered in one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evseq.operators.quantiles import exact_median, exact_quantiles_many


def count_non_null_by(df: DataFrame, key: str, column: str, alias: str = "count") -> DataFrame:
    """A1."""
    return df.groupBy(key).agg(F.count(F.col(column)).alias(alias))


def value_counts(df: DataFrame, column: str, by: Sequence[str] = (), sort: bool = True) -> DataFrame:
    """A3: counts per value; null is a value of its own."""
    out = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("count"))
    if sort:
        out = out.orderBy(*by, F.col("count").desc(), F.col(column).asc_nulls_first())
    return out


def value_proportions(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """A4: normalized value counts, globally or per ``by`` group."""
    counts = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("count"))
    if not by:  # the total is one number: a scalar subquery, no single-partition window
        return counts.withColumn("proportion", F.col("count") / counts.select(F.sum("count")).scalar())
    return counts.withColumn("proportion", F.col("count") / F.sum("count").over(Window.partitionBy(*by)))


def frequency_filter(props: DataFrame, op: str, threshold: float) -> DataFrame:
    """strict comparison of a proportion with a threshold (``<`` or ``>``)."""
    p = F.col("proportion")
    cond = p < F.lit(threshold) if op == "<" else p > F.lit(threshold)
    return props.filter(cond)


def scalar_max(df: DataFrame, expr: Column, alias: str) -> DataFrame:
    """A5: a one-row frame."""
    return df.agg(F.max(expr).alias(alias))


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, n): distinct values of each column, null as one value.

    The columns are stacked as (column, value) and made distinct map-side; several
    ``count_distinct`` in one aggregate would expand every row once per column.
    Values are compared by their text, -0.0 as 0.0.  An empty table gives no rows."""

    def text(c: str) -> Column:
        real = df.schema[c].dataType.typeName() in ("float", "double")
        return (F.col(c) + F.lit(0.0) if real else F.col(c)).cast("string")

    pairs = F.array(*[F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in cols])
    found = df.select(F.explode(pairs).alias("_p")).select("_p.*").distinct()
    return found.groupBy("column").agg(F.count(F.lit(1)).alias("n"))


def n_unique(df: DataFrame, cols: Sequence[str], prefix: str = "n_unique_") -> DataFrame:
    """Distinct count with null counted as one value (one row)."""
    counts = distinct_counts(df, cols)
    # without rows a maximum over nothing is null, as it is for one column alone
    return counts.agg(*[F.max(F.when(F.col("column") == c, F.col("n"))).cast("bigint").alias(f"{prefix}{c}") for c in cols])


def _unpivot(wide: DataFrame, names: Sequence[str], value_cols: Sequence[Sequence[str]], out_names: Sequence[str]) -> DataFrame:
    """One output row per name: ``value_cols[i]`` holds the wide column per output column."""
    structs = [
        F.struct(F.lit(n).alias("column"), *[F.col(vc[i]).alias(o) for vc, o in zip(value_cols, out_names, strict=True)])
        for i, n in enumerate(names)
    ]
    return wide.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long form (column, null_count)."""
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(f"_n_{c}") for c in cols])
    wide = wide.select(*[F.coalesce(F.col(f"_n_{c}"), F.lit(0).cast("bigint")).alias(f"_n_{c}") for c in cols])
    return _unpivot(wide, cols, [[f"_n_{c}" for c in cols]], ["null_count"])


DESCRIBE_STATS = ["count", "null_count", "mean", "std", "min", "q25", "q50", "q75", "max"]


def describe(df: DataFrame, cols: Sequence[str], method: str = "distributed") -> DataFrame:
    """Count, null count, mean, sample std, min, exact 25/50/75 % (linear
    interpolation), max per column; long form.

    Moments come from one aggregate.  Quantiles come from the distributed exact
    method (all columns stacked in one pass, see ``quantiles``); ``method=
    'builtin'`` uses Spark's ``percentile`` instead (one value->count map per
    column merged in one task: only for columns with few distinct values)."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"count_{i}"),
            F.sum(x.isNull().cast("bigint")).alias(f"null_count_{i}"),
            F.avg(x).alias(f"mean_{i}"),
            F.stddev_samp(x).alias(f"std_{i}"),
            F.min(x).alias(f"min_{i}"),
            F.max(x).alias(f"max_{i}"),
        ]
        if method == "builtin":
            aggs.append(F.percentile(x, [0.25, 0.5, 0.75]).alias(f"q_{i}"))
    wide = df.agg(*aggs)
    if method == "builtin":
        wide = wide.withColumns({f"q{p}_{i}": F.col(f"q_{i}")[j] for i in range(len(cols)) for j, p in enumerate((25, 50, 75))})
        value_cols = [[f"{s}_{i}" for i in range(len(cols))] for s in DESCRIBE_STATS]
        return _unpivot(wide, cols, value_cols, DESCRIBE_STATS)
    moments = [s for s in DESCRIBE_STATS if not s.startswith("q")]
    long = _unpivot(wide, cols, [[f"{s}_{i}" for i in range(len(cols))] for s in moments], moments)
    q = exact_quantiles_many(df, cols, [0.25, 0.5, 0.75])
    qw = q.groupBy("column").agg(
        *[F.max(F.when(F.col("q") == F.lit(p / 100), F.col("value"))).alias(f"q{p}") for p in (25, 50, 75)]
    )
    return long.join(qw, "column", "left").select("column", *DESCRIBE_STATS)


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols) as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


def sorted_distinct(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """A10."""
    return df.select(*by, column).distinct().orderBy(*by, F.col(column).asc_nulls_first())


def group_median(df: DataFrame, by: Sequence[str], column: str, alias: str, method: str = "distributed") -> DataFrame:
    """Exact median per group (linear interpolation), one row per group
    (null when the group has no value).  Distributed by default; ``builtin``
    uses Spark's ``median`` (one value->count map per group in one task)."""
    if method == "builtin":
        return df.groupBy(*by).agg(F.median(F.col(column)).alias(alias))
    groups = df.select(*by).distinct()
    med = exact_median(df, column, by, alias)
    return _left_join_null_safe(groups, med, list(by))


def _left_join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = term if cond is None else cond & term
    return left.join(r, cond, "left").drop(*[f"_r_{k}" for k in keys])


def balanced_class_weights(labels: DataFrame, label: str, by: Sequence[str] = (), weight: str = "weight") -> DataFrame:
    """``n / (C * n_c)`` over the classes present, per ``by`` group."""
    counts = labels.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n_c"))
    if by:
        w = Window.partitionBy(*by)
        n, c = F.sum("n_c").over(w), F.count(F.lit(1)).over(w)
    else:  # totals over the class table as scalar subqueries
        tot = counts.select(F.struct(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("c"))).scalar()
        n, c = tot["n"], tot["c"]
    return counts.select(*by, label, "n_c", (n / (c * F.col("n_c"))).alias(weight))


def scaler_stats(df: DataFrame, cols: Sequence[str], where: Column | None = None) -> DataFrame:
    """Min, max, mean, population std per column, NaN ignored (one row)."""
    src = df.filter(where) if where is not None else df
    aggs = []
    for c in cols:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        aggs += [
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_pop(x).alias(f"{c}__std"),
        ]
    return src.agg(*aggs)
