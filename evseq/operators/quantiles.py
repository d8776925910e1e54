"""Exact quantiles without gathering a group in one task.

Spark's exact ``percentile``/``median`` merge a value->count map per group in
one task, so a column with very many distinct values (or one hot group) puts an
unbounded buffer on a single executor.  Here the same numbers (linear
interpolation between the order statistics at ``q * (n - 1)``) come from:

1. a histogram ``(group, value, count)`` by partial aggregation (duplicates
   collapse map-side);
2. ``repartitionByRange(group, value)`` of the histogram, written with its
   partition: a hot group is spread over many partitions in value order;
3. running counts inside each (partition, group) and per-(partition, group)
   offsets from a small summary (one row per group and partition it touches);
4. only the histogram rows that hold the ranks ``floor(q(n-1))`` and
   ``ceil(q(n-1))`` survive (at most two per group and q); interpolate.

Several columns are handled in one pass by stacking them into
``(column, value)`` and treating the column name as one more group key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evseq.operators.joins import null_safe_join
from evseq.session import materialize

VAL = "_qv"
CNT = "_qc"
PID = "_qpid"


def _histogram(df: DataFrame, value: Column, by: Sequence[str]) -> DataFrame:
    return (
        df.select(*by, value.cast("double").alias(VAL))
        .filter(F.col(VAL).isNotNull())
        .groupBy(*by, VAL)
        .agg(F.count(F.lit(1)).alias(CNT))
    )


def _stacked_histogram(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias(VAL)) for c in cols])
    long = df.select(*by, F.explode(pairs).alias("_p")).select(*by, "_p.column", f"_p.{VAL}")
    return long.filter(F.col(VAL).isNotNull()).groupBy(*by, "column", VAL).agg(F.count(F.lit(1)).alias(CNT))


def quantiles_from_histogram(hist: DataFrame, by: Sequence[str], probs: Sequence[float], n_partitions: int | None = None) -> DataFrame:
    """(by..., q, value) from a histogram (by..., _qv, _qc)."""
    G = list(by)
    spark = hist.sparkSession
    n = n_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = hist.repartitionByRange(n, *G, VAL).sortWithinPartitions(*G, VAL)
    t = materialize(ranged.withColumn(PID, F.spark_partition_id()), "quantiles")
    # running count inside (partition, group); a growing frame, one pass
    w = Window.partitionBy(PID, *G).orderBy(VAL).rowsBetween(Window.unboundedPreceding, 0)
    local = t.withColumn("_run", F.sum(CNT).over(w))
    # per (partition, group) totals -> offsets over earlier partitions of the group
    part = t.groupBy(PID, *G).agg(F.sum(CNT).alias("_pt"))
    wo = (Window.partitionBy(*G) if G else Window.partitionBy()).orderBy(PID).rowsBetween(Window.unboundedPreceding, 0)
    part = part.withColumn("_off", F.sum("_pt").over(wo) - F.col("_pt"))
    wn = Window.partitionBy(*G) if G else Window.partitionBy()
    part = part.withColumn("_n", F.sum("_pt").over(wn)).drop("_pt")
    pos = null_safe_join(local, part, [PID, *G], "inner")
    pos = pos.withColumn("_end", F.col("_off") + F.col("_run")).withColumn("_start", F.col("_end") - F.col(CNT))
    # wanted ranks: floor and ceil of q * (n - 1), per q
    qs = F.explode(F.array(*[F.lit(float(q)) for q in probs])).alias("q")
    targets = pos.select(*G, VAL, "_start", "_end", "_n", qs)
    r = F.col("q") * (F.col("_n") - 1)
    lo, hi = F.floor(r), F.ceil(r)
    hit_lo = (F.col("_start") <= lo) & (lo < F.col("_end"))
    hit_hi = (F.col("_start") <= hi) & (hi < F.col("_end"))
    picked = targets.filter(hit_lo | hit_hi).select(
        *G,
        "q",
        r.alias("_r"),
        F.when(hit_lo, F.col(VAL)).alias("_vlo"),
        F.when(hit_hi, F.col(VAL)).alias("_vhi"),
    )
    agg = picked.groupBy(*G, "q").agg(F.max("_r").alias("_r"), F.max("_vlo").alias("_vlo"), F.max("_vhi").alias("_vhi"))
    frac = F.col("_r") - F.floor(F.col("_r"))
    value = F.when(frac == 0, F.col("_vlo")).otherwise(F.col("_vlo") + frac * (F.col("_vhi") - F.col("_vlo")))
    return agg.select(*G, "q", value.alias("value"))


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = (), n_partitions: int | None = None) -> DataFrame:
    """(by..., q, value): exact linear-interpolation quantiles of ``column``."""
    return quantiles_from_histogram(_histogram(df, F.col(column), by), by, probs, n_partitions)


def exact_quantiles_many(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), n_partitions: int | None = None) -> DataFrame:
    """(by..., column, q, value) for several columns in one pass."""
    return quantiles_from_histogram(_stacked_histogram(df, cols, by), [*by, "column"], probs, n_partitions)


def exact_median(df: DataFrame, column: str, by: Sequence[str], alias: str, n_partitions: int | None = None) -> DataFrame:
    """(by..., alias): exact median per group; groups with no value are absent."""
    q = exact_quantiles(df, column, [0.5], by, n_partitions)
    return q.select(*by, F.col("value").alias(alias))
