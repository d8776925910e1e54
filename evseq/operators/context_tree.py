"""L1 as a pruned context tree (prediction suffix tree).

The order-k transition model keeps every context that occurs, up to entities x
C^k rows.  Here the contexts are grown level by level, each only where its parent
(without the oldest code) was grown and while it has ``min_count`` training rows,
so a level has at most rows / min_count contexts.  Then the tree is pruned from
the deepest level up: a context stays if it raises the likelihood of the training
rows by at least ``min_gain`` nats over its parent, or if one below it stays.
Probabilities are interpolated down the tree,

    p(next | context) = (count + kappa * p(next | parent)) / (total + kappa),

so a rare context leans on its parent instead of replacing it.  Each level is
one aggregate over the rows whose parent was grown and one join with the level
above; the table has the columns of ``model.transition_table``, so
``model.score_transitions`` reads it.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evseq.operators.joins import null_safe_join
from evseq.session import materialize


def _counts(rows: DataFrame, by: Sequence[str], target: str, level: int) -> DataFrame:
    """(by..., context, parent, counts map, total) of the contexts of one level."""
    parent = F.col(f"ctx_{level - 1}") if level else F.lit(None).cast("string")
    each = rows.filter(F.col(f"ctx_{level}").isNotNull()).select(
        *by, F.col(f"ctx_{level}").alias("context"), parent.alias("parent"), F.col(target).alias("next")
    )
    counted = each.groupBy(*by, "context", "parent", "next").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*by, "context", "parent").agg(
        F.map_from_entries(F.collect_list(F.struct("next", "n"))).alias("counts"), F.sum("n").alias("total")
    )


def _interpolated(above: Column, kappa: float) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.col("n_classes") - 1),
        lambda i: (F.coalesce(F.col("counts")[i], F.lit(0)).cast("double") + F.lit(kappa) * F.get(above, i))
        / (F.col("total") + F.lit(kappa)),
    )


def fit_context_tree(
    ctx_rows: DataFrame,
    classes: DataFrame,
    by: Sequence[str],
    target: str,
    k: int,
    min_gain: float,
    kappa: float = 1.0,
    min_count: int = 1,
    train: Column | None = None,
) -> DataFrame:
    """(by..., order, context, total, n_classes, p, gain): the nodes of the tree.

    ``ctx_rows`` has ``ctx_0`` .. ``ctx_k`` (``model.with_contexts``).  The root of
    every entity stays, with a null gain; rows without a target are left out.
    """
    B = list(by)
    rows = ctx_rows.filter(train) if train is not None else ctx_rows
    rows = rows.filter(F.col(target).isNotNull()).select(*B, target, *[f"ctx_{j}" for j in range(k + 1)])
    levels: list[DataFrame] = []
    for j in range(k + 1):
        if j:
            nodes = levels[-1].select(*B, F.col("context").alias(f"ctx_{j - 1}"), F.lit(True).alias("_grown"))
            rows = null_safe_join(rows, nodes, [*B, f"ctx_{j - 1}"], "inner").drop("_grown")
        found = _counts(rows, B, target, j)
        if j:
            found = found.filter(F.col("total") >= F.lit(int(min_count)))
        if j == 0:
            found = null_safe_join(found, classes, B, "inner")
            uniform = F.transform(F.sequence(F.lit(0), F.col("n_classes") - 1), lambda i: F.lit(1.0) / F.col("n_classes"))
            found = found.withColumn("p", _interpolated(uniform, kappa)).withColumn("gain", F.lit(None).cast("double"))
        else:
            above = levels[-1].select(*B, F.col("context").alias("parent"), "n_classes", F.col("p").alias("_above"))
            found = null_safe_join(found, above, [*B, "parent"], "inner")
            found = found.withColumn("p", _interpolated(F.col("_above"), kappa))
            gain = F.aggregate(
                F.map_entries("counts"),
                F.lit(0.0),
                lambda a, e: a + e["value"] * F.log(F.get(F.col("p"), e["key"]) / F.get(F.col("_above"), e["key"])),
            )
            found = found.withColumn("gain", gain)
        out = found.select(*B, F.lit(j).alias("order"), "context", "parent", "total", "n_classes", "p", "gain")
        levels.append(materialize(out, f"context-level-{j}"))
    kept, below = [], None
    for found in reversed(levels):
        stays = F.col("gain").isNull() | (F.col("gain") >= F.lit(float(min_gain)))
        if below is not None:
            found = null_safe_join(found, below, [*B, "context"])
            stays = stays | F.col("_below").isNotNull()
        found = found.filter(stays).select(*B, "order", "context", "parent", "total", "n_classes", "p", "gain")
        kept.append(found.drop("parent"))
        below = found.select(*B, F.col("parent").alias("context"), F.lit(True).alias("_below")).distinct()
    return functools.reduce(DataFrame.unionByName, kept[::-1])
