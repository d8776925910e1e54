"""Learned vectors of categorical codes (embedding inputs of Q3's channels).

Codes that stand near each other in an ordered group are counted as pairs; the
log count table, which has at most codes x codes rows, is factored by MLlib's
alternating least squares.  Only the pair counting reads the event rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from evseq.operators.joins import null_safe_join
from evseq.operators.ordered import ordered_window


def cooccurrence(
    df: DataFrame, code: str, order_by: Sequence[str], partition_by: Sequence[str] = (), reach: int = 2, **kw
) -> DataFrame:
    """(code, other, n): how often ``other`` is one of the ``reach`` codes before
    ``code`` in its group.  Rows without a code stand in the order but pair with nothing."""

    def build(w: WindowSpec) -> dict[str, Column]:
        return {f"_p{i}": F.lag(F.col(code), i).over(w) for i in range(1, reach + 1)}

    back = ordered_window(df, partition_by, order_by, build, before=reach, after=0, **kw)
    pairs = back.select(F.col(code).alias("code"), F.explode(F.array(*[f"_p{i}" for i in range(1, reach + 1)])).alias("other"))
    return pairs.dropna().groupBy("code", "other").agg(F.count(F.lit(1)).alias("n"))


def factor(counts: DataFrame, rank: int = 4, rounds: int = 10, reg: float = 0.01, seed: int = 0, value: Column | None = None):
    """ALS on ``value`` (log(1 + n) by default): tables (code, vector) of the
    codes and (other, vector) of their contexts; ``vector . vector`` gives the value."""
    value = F.log1p("n") if value is None else value
    data = counts.select(F.col("code").cast("int"), F.col("other").cast("int"), value.cast("float").alias("value"))
    als = ALS(userCol="code", itemCol="other", ratingCol="value", rank=rank, maxIter=rounds, regParam=reg, seed=seed)
    model = als.fit(data)
    as_vector = F.transform("features", lambda x: x.cast("double")).alias("vector")
    codes = model.userFactors.select(F.col("id").alias("code"), as_vector)
    return codes, model.itemFactors.select(F.col("id").alias("other"), as_vector)


def embed(df: DataFrame, code: str, vectors: DataFrame, out: str) -> DataFrame:
    """Attach each row's vector; a code without one (or null) gets a null."""
    return null_safe_join(df, vectors.select(F.col("code").alias(code), F.col("vector").alias(out)), [code])
