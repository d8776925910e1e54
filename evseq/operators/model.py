"""Next-event models fitted for all entities in one job.

L1 is an order-k transition model: for every entity, counts of
``(context of the last j codes) -> next code`` for j = 0..k on the training
rows, scored with the longest context seen in training (back-off) and additive
smoothing over the entity's classes.  Counting is one aggregate; the model
table has at most ``entities x sum_j C^j`` rows, and scoring is k+1 equi-joins
against it (AQE broadcasts it when its measured size is small).

L2 is MLlib's multinomial logistic regression on flattened windows with an
optional weight column; L7 picks grid parameters by validation log loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from evseq.functions.exprs import argmax, clip
from evseq.operators.aggregates import balanced_class_weights, distinct_counts
from evseq.operators.joins import null_safe_join
from evseq.operators.ordered import ordered_window

EPSILON = 1e-7  # probability clip for the losses (the usual backend epsilon)


def context_lags(w: WindowSpec, code: str, k: int) -> dict[str, Column]:
    """Window columns ``_lag1.._lag{k-1}`` for the contexts of order up to k."""
    return {f"_lag{i}": F.lag(F.col(code), i).over(w) for i in range(1, k)}


def context_strings(lagged: DataFrame, code: str, k: int) -> DataFrame:
    """``ctx_0..ctx_k`` from the code and its ``_lag`` columns (most recent
    first, comma separated); null when fewer than j rows exist."""
    parts = [F.col(code).cast("string")] + [F.col(f"_lag{i}").cast("string") for i in range(1, k)]
    ctx = {"ctx_0": F.lit("")}
    for j in range(1, k + 1):
        # concat is null as soon as one part is null: no context of that length
        pieces = []
        for i in range(j):
            if i:
                pieces.append(F.lit(","))
            pieces.append(parts[i])
        ctx[f"ctx_{j}"] = F.concat(*pieces)
    return lagged.withColumns(ctx).drop(*[f"_lag{i}" for i in range(1, k)])


def with_contexts(
    df: DataFrame,
    code: str,
    k: int,
    order_by: Sequence[str],
    partition_by: Sequence[str],
    strategy: str = "halo",
    **kw,
) -> DataFrame:
    """Add ``ctx_0..ctx_k``: the last j codes of the group ending at the row."""
    if k <= 1:
        return context_strings(df, code, k)
    lagged = ordered_window(
        df, partition_by, order_by, lambda w: context_lags(w, code, k), before=k - 1, after=0, strategy=strategy, **kw
    )
    return context_strings(lagged, code, k)


def fit_transition_counts(ctx_rows: DataFrame, by: Sequence[str], target: str, k: int, train: Column | None = None) -> DataFrame:
    """L1 fit: (by..., order, context, next, count) for order j = 0..k."""
    src = ctx_rows.filter(train) if train is not None else ctx_rows
    src = src.filter(F.col(target).isNotNull())
    ctxs = F.array(*[F.struct(F.lit(j).alias("order"), F.col(f"ctx_{j}").alias("context")) for j in range(k + 1)])
    ex = src.select(*by, F.col(target).alias("next"), F.explode(ctxs).alias("_c")).filter(F.col("_c.context").isNotNull())
    return ex.groupBy(*by, "_c.order", "_c.context", "next").agg(F.count(F.lit(1)).alias("count"))


def transition_table(counts: DataFrame, classes: DataFrame, by: Sequence[str], alpha: float) -> DataFrame:
    """L1 model: (by..., order, context, total, p array over the entity's classes)."""
    agg = counts.groupBy(*by, "order", "context").agg(
        F.map_from_entries(F.collect_list(F.struct("next", "count"))).alias("_counts"),
        F.sum("count").alias("total"),
    )
    j = null_safe_join(agg, classes, list(by), "inner")
    c = F.col("n_classes")
    p = F.transform(
        F.sequence(F.lit(0), c - 1),
        lambda i: (F.coalesce(F.col("_counts")[i], F.lit(0)).cast("double") + F.lit(alpha)) / (F.col("total") + F.lit(alpha) * c),
    )
    return j.select(*by, "order", "context", "total", "n_classes", p.alias("p"))


def class_counts(mapping: DataFrame, by: Sequence[str], code: str) -> DataFrame:
    """Number of classes per entity from a code map (codes are 0..C-1)."""
    return mapping.groupBy(*by).agg(F.count_distinct(F.col(code)).cast("int").alias("n_classes"))


def score_transitions(
    ctx_rows: DataFrame,
    model: DataFrame,
    classes: DataFrame,
    by: Sequence[str],
    k: int,
    alpha: float,
) -> DataFrame:
    """L1 scoring / L4: ``p`` from the longest context seen in training, the
    uniform prior ``alpha / (alpha * C)`` when even order 0 is unseen."""
    out = ctx_rows
    for j in range(k, -1, -1):
        mj = model.filter(F.col("order") == j).select(*by, F.col("context").alias(f"ctx_{j}"), F.col("p").alias(f"_p{j}"))
        out = null_safe_join(out, mj.filter(F.col(f"ctx_{j}").isNotNull()), [*by, f"ctx_{j}"])
    out = null_safe_join(out, classes, list(by))
    uniform = F.transform(F.sequence(F.lit(0), F.col("n_classes") - 1), lambda i: F.lit(1.0) / F.col("n_classes"))
    used = F.coalesce(*[F.when(F.col(f"_p{j}").isNotNull(), F.lit(j)) for j in range(k, -1, -1)])
    p = F.coalesce(*[F.col(f"_p{j}") for j in range(k, -1, -1)], uniform)
    out = out.withColumn("p", p).withColumn("order_used", used).withColumn("pred", argmax("p"))
    return out.drop(*[f"_p{j}" for j in range(k + 1)], *[f"ctx_{j}" for j in range(k + 1)], "n_classes")


def sample_weights(rows: DataFrame, train_rows: DataFrame, label: str, by: Sequence[str], weight: str = "weight") -> DataFrame:
    """L3: balanced class weights (from the train rows) attached to each row by label."""
    w = balanced_class_weights(train_rows, label, by, weight).select(*by, label, weight)
    return null_safe_join(rows, w.filter(F.col(label).isNotNull()), [*by, label])


def prob_of_true(p: str = "p", y: str = "y") -> Column:
    return F.element_at(F.col(p), F.col(y) + 1)


def focal_loss(scored: DataFrame, by: Sequence[str] = (), gamma: float = 2.0, alpha: float = 0.25, p: str = "p", y: str = "y") -> DataFrame:
    """Mean over rows of ``sum_c alpha * y_c * (1-p_c)^gamma * -log(p_c)``,
    p clipped to [eps, 1-eps]; only the true class has y_c = 1."""
    pc = clip(prob_of_true(p, y), EPSILON, 1 - EPSILON)
    term = F.lit(alpha) * F.pow(F.lit(1.0) - pc, F.lit(gamma)) * -F.log(pc)
    return scored.groupBy(*by).agg(F.avg(term).alias("focal_loss"))


def log_loss(scored: DataFrame, by: Sequence[str] = (), p: str = "p", y: str = "y") -> DataFrame:
    """Mean of ``-log(clip(p_true))``."""
    pc = clip(prob_of_true(p, y), EPSILON, 1 - EPSILON)
    return scored.groupBy(*by).agg(F.avg(-F.log(pc)).alias("log_loss"))


def cardinalities(df: DataFrame, cols: Sequence[str], plus_one: Sequence[str] = ()) -> DataFrame:
    """Number of distinct values (null counts as one) per model input, long
    form; ``plus_one`` columns report n + 1 (an embedding sized max+1)."""
    more = F.when(F.col("column").isin(*plus_one), 1).otherwise(0) if plus_one else F.lit(0)
    return distinct_counts(df, cols).select(F.col("column").alias("input"), (F.col("n") + more).cast("bigint").alias("cardinality"))


def fit_logistic(
    train: DataFrame,
    features: str,
    label: str,
    weight: str | None = None,
    reg_param: float = 0.0,
    max_iter: int = 1000,
    tol: float = 1e-6,
):
    """L2: multinomial logistic regression (MLlib) on an array<double> feature
    column.  The fit stops by ``tol``; ending at ``max_iter`` raises."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    data = train.withColumn("_features", array_to_vector(F.col(features)))
    lr = LogisticRegression(
        featuresCol="_features",
        labelCol=label,
        family="multinomial",
        regParam=reg_param,
        maxIter=max_iter,
        tol=tol,
        probabilityCol="_prob",
        predictionCol="_pred",
        rawPredictionCol="_raw",
    )
    if weight:
        lr.setWeightCol(weight)
    model = lr.fit(data)
    if model.summary.totalIterations >= max_iter:
        raise RuntimeError(f"the fit did not converge in {max_iter} steps")
    return model


def score_logistic(model, rows: DataFrame, features: str) -> DataFrame:
    """L2/L4: ``p`` array and arg-max ``pred`` from a fitted MLlib model."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    data = rows.withColumn("_features", array_to_vector(F.col(features)))
    out = model.transform(data)
    out = out.withColumn("p", vector_to_array("_prob")).withColumn("pred", argmax("p"))
    return out.drop("_features", "_prob", "_pred", "_raw")
