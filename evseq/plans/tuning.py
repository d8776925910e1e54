"""Parameter grid search by validation log loss.

The grid is a handful of parameter pairs (order k, smoothing alpha).  The true
class's probability under any of them needs only its count, the context's total
and the number of classes, so the validation rows are joined once with the
counts of each order and one aggregate sums the loss of every grid point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evseq.functions.exprs import clip
from evseq.operators import model as L
from evseq.operators.joins import null_safe_join
from evseq.plans.stages import ROLES, Roles, classes_of
from evseq.session import materialize


def grid_search_transitions(
    split_rows: DataFrame,
    mapping: DataFrame,
    ks: Sequence[int] = (1, 2),
    alphas: Sequence[float] = (0.5, 1.0),
    roles: Roles = ROLES,
    strategy: str = "halo",
) -> DataFrame:
    """One row per grid point with its validation log loss and a ``best`` flag
    (lowest loss; ties to the smaller k, then smaller alpha)."""
    r = roles
    by = [r.entity]
    kmax = max(ks)
    ctx = split_rows
    if f"ctx_{kmax}" not in ctx.columns:
        ctx = L.with_contexts(ctx, r.code, kmax, list(r.order), [r.entity, r.game], strategy=strategy)
    cols = [r.entity, "split", r.target, *[f"ctx_{j}" for j in range(kmax + 1)]]
    ctx = materialize(ctx.select(*cols), "contexts")
    counts = materialize(L.fit_transition_counts(ctx, by, r.target, kmax, F.col("split") == "train"), "counts")
    totals = counts.groupBy(*by, "order", "context").agg(F.sum("count").alias("total"))
    rows = null_safe_join(ctx.filter(F.col("split") == "val"), classes_of(mapping, r), by)
    for j in range(kmax + 1):
        own = totals.filter((F.col("order") == j) & F.col("context").isNotNull())
        rows = null_safe_join(rows, own.select(*by, F.col("context").alias(f"ctx_{j}"), F.col("total").alias(f"_t{j}")), [*by, f"ctx_{j}"])
        hit = counts.filter((F.col("order") == j) & F.col("context").isNotNull())
        hit = hit.select(*by, F.col("context").alias(f"ctx_{j}"), F.col("next").alias(r.target), F.col("count").alias(f"_c{j}"))
        rows = null_safe_join(rows, hit, [*by, f"ctx_{j}", r.target])

    def loss(k: int, alpha: float):
        c = F.col("n_classes")
        p = [
            F.when(
                F.col(f"_t{j}").isNotNull(),
                (F.coalesce(F.col(f"_c{j}"), F.lit(0)) + F.lit(float(alpha))) / (F.col(f"_t{j}") + F.lit(float(alpha)) * c),
            )
            for j in range(k, -1, -1)
        ]
        return F.avg(-F.log(clip(F.coalesce(*p, F.lit(1.0) / c), L.EPSILON, 1 - L.EPSILON)))

    grid = [(int(k), float(a)) for k in ks for a in alphas]
    one = rows.agg(*[loss(k, a).alias(f"l{i}") for i, (k, a) in enumerate(grid)])
    points = F.array(
        *[F.struct(F.col(f"l{i}").alias("loss"), F.lit(k).alias("k"), F.lit(a).alias("alpha")) for i, (k, a) in enumerate(grid)]
    )
    # an undefined loss (no validation rows) is never the best
    ranked = one.select(points.alias("g")).withColumn("best", F.array_min(F.filter("g", lambda x: x["loss"].isNotNull())))
    each = ranked.select(F.explode("g").alias("x"), "best")
    return each.select(
        "x.k", "x.alpha", F.round("x.loss", 6).alias("val_log_loss"), F.coalesce(F.col("x") == F.col("best"), F.lit(False)).alias("best")
    )
