"""Evaluation of a scored table.

A scored table has one row per sample with the entity key(s), the true class
``y``, the class probabilities ``p`` (array indexed by class) and ``pred``.
Everything is a grouped aggregate per entity; the fixed class list of an
entity (0..C-1) is generated with ``sequence`` from its class count, so zero
cells are kept without joining the event rows against anything large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evseq.functions.exprs import top_k_indices


def class_list(classes: DataFrame, by: Sequence[str], out: str = "class") -> DataFrame:
    """(by..., class) for class in 0..n_classes-1."""
    return classes.select(*by, F.explode(F.sequence(F.lit(0), F.col("n_classes") - 1)).alias(out))


def accuracy(scored: DataFrame, by: Sequence[str], y: str = "y", pred: str = "pred") -> DataFrame:
    """E1."""
    return scored.groupBy(*by).agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"))


def top_k_accuracy(scored: DataFrame, by: Sequence[str], k: int = 2, y: str = "y", p: str = "p") -> DataFrame:
    """Share of rows whose class is among the k most probable (O4 ties)."""
    hit = F.array_contains(top_k_indices(p, k), F.col(y)).cast("double")
    return scored.groupBy(*by).agg(F.avg(hit).alias(f"top{k}_accuracy"))


def confusion_matrix(scored: DataFrame, classes: DataFrame, by: Sequence[str], y: str = "y", pred: str = "pred") -> DataFrame:
    """(by..., true, predicted, n) for every pair of the entity's classes."""
    counts = scored.groupBy(*by, F.col(y).alias("true"), F.col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    seq = F.sequence(F.lit(0), F.col("n_classes") - 1)
    cells = classes.select(*by, F.explode(seq).alias("true"), seq.alias("_s")).select(*by, "true", F.explode("_s").alias("predicted"))
    out = cells.join(counts, [*by, "true", "predicted"], "left")
    return out.select(*by, "true", "predicted", F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n"))


def _safe_div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def class_stats(scored: DataFrame, classes: DataFrame, by: Sequence[str], y: str = "y", pred: str = "pred", p: str = "p", k: int = 2) -> DataFrame:
    """(by..., class, support, tp, predicted, topk) for every class of every
    entity, zero classes kept, in ONE pass over the scored rows: each row emits
    a record for its true class (support, correct, top-k hit) and one for its
    predicted class; one aggregate sums them.  Every figure of the report and
    of the entity metrics derives from this small table."""
    one, zero = F.lit(1), F.lit(0)
    hit = F.array_contains(top_k_indices(p, k), F.col(y)).cast("int") if p in scored.columns else zero
    recs = F.array(
        F.struct(F.col(y).alias("class"), one.alias("s"), (F.col(y) == F.col(pred)).cast("int").alias("t"), zero.alias("q"), hit.alias("h")),
        F.struct(F.col(pred).alias("class"), zero.alias("s"), zero.alias("t"), one.alias("q"), zero.alias("h")),
    )
    stats = (
        scored.select(*by, F.explode(recs).alias("r"))
        .groupBy(*by, F.col("r.class").alias("class"))
        .agg(
            F.sum("r.s").cast("bigint").alias("support"),
            F.sum("r.t").cast("bigint").alias("tp"),
            F.sum("r.q").cast("bigint").alias("predicted"),
            F.sum("r.h").cast("bigint").alias("topk"),
        )
    )
    keys = [*by, "class"]
    j = class_list(classes, by).join(stats, keys, "left")
    z = F.lit(0).cast("bigint")
    return j.select(*keys, *[F.coalesce(F.col(c), z).alias(c) for c in ("support", "tp", "predicted", "topk")])


def _with_prf(stats: DataFrame) -> DataFrame:
    prec = _safe_div(F.col("tp"), F.col("predicted"))
    rec = _safe_div(F.col("tp"), F.col("support"))
    j = stats.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0)).otherwise(
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
    )
    return j.withColumn("f1", f1)


def per_class_report(scored: DataFrame, classes: DataFrame, by: Sequence[str], y: str = "y", pred: str = "pred") -> DataFrame:
    """E4 per class: precision, recall, F1 (0 on zero division) and support (one pass)."""
    per = _with_prf(class_stats(scored, classes, by, y, pred))
    return per.select(*by, "class", "precision", "recall", "f1", "support")


def report_averages(report: DataFrame, by: Sequence[str]) -> DataFrame:
    """E4/E5 averages: macro (plain mean over classes) and weighted (by support)."""
    tot = F.sum("support")
    macro = report.groupBy(*by).agg(
        F.lit("macro avg").alias("average"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
        tot.alias("support"),
    )
    weighted = report.groupBy(*by).agg(
        F.lit("weighted avg").alias("average"),
        _safe_div(F.sum(F.col("precision") * F.col("support")), tot).alias("precision"),
        _safe_div(F.sum(F.col("recall") * F.col("support")), tot).alias("recall"),
        _safe_div(F.sum(F.col("f1") * F.col("support")), tot).alias("f1"),
        tot.alias("support"),
    )
    return macro.unionByName(weighted)


def class_distribution(scored: DataFrame, classes: DataFrame, by: Sequence[str], y: str = "y") -> DataFrame:
    """Rows per true class, classes with no row kept as 0."""
    counts = scored.groupBy(*by, F.col(y).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    base = class_list(classes, by)
    j = base.join(counts, [*by, "class"], "left")
    return j.select(*by, "class", F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n"))


def entity_metrics(scored: DataFrame, classes: DataFrame, mapping: DataFrame, by: Sequence[str], code: str = "code") -> DataFrame:
    """One row per entity with scored rows: accuracy, top-2 accuracy, class
    count and the class distribution as ``map<class name, count>``
    (``Unknown-{code}`` when a code has no name).  One pass over the scores."""
    st = class_stats(scored, classes, by)
    named = st.join(mapping.select(*by, F.col(code).alias("class"), "name"), [*by, "class"], "left")
    named = named.withColumn("name", F.coalesce(F.col("name"), F.concat(F.lit("Unknown-"), F.col("class").cast("string"))))
    n = F.sum("support")
    per_entity = named.groupBy(*by).agg(
        n.alias("_n"),
        F.try_divide(F.sum("tp"), n).alias("accuracy"),  # entities without rows are dropped below
        F.try_divide(F.sum("topk"), n).alias("top2_accuracy"),
        # entries in class order, whatever order the rows arrive in
        F.map_from_entries(
            F.transform(
                F.sort_array(F.collect_list(F.struct("class", "name", "support"))),
                lambda e: F.struct(e["name"].alias("name"), e["support"].alias("support")),
            )
        ).alias("class_distribution"),
    )
    return (
        per_entity.filter(F.col("_n") > 0)
        .join(classes, list(by))
        .select(*by, "accuracy", "top2_accuracy", F.col("n_classes").alias("num_classes"), "class_distribution")
    )


def summary(metrics: DataFrame) -> DataFrame:
    """Mean accuracy and top-2 accuracy over entities, entity count."""
    return metrics.agg(
        F.avg("accuracy").alias("avg_accuracy"),
        F.avg("top2_accuracy").alias("avg_top2_accuracy"),
        F.count(F.lit(1)).alias("total_players"),
    )


def classification_report(scored: DataFrame, classes: DataFrame, mapping: DataFrame, by: Sequence[str], code: str = "code") -> DataFrame:
    """The full report in long form (by..., label, precision, recall,
    f1, support): one row per class under its name (``Unknown-{code}`` without
    one), then ``accuracy`` (in the f1 column, support = all rows; only for
    entities with rows), ``macro avg`` and ``weighted avg``.  One pass over the
    scores; the summary rows come from one aggregate of the class table."""
    per = _with_prf(class_stats(scored, classes, by))
    names = mapping.select(*by, F.col(code).alias("class"), F.col("name").alias("_name"))
    rows = per.join(names, [*by, "class"], "left").select(
        *by,
        F.coalesce(F.col("_name"), F.concat(F.lit("Unknown-"), F.col("class").cast("string"))).alias("label"),
        "precision",
        "recall",
        "f1",
        "support",
    )
    tot = F.col("_n")
    s = per.groupBy(*by).agg(
        F.sum("support").alias("_n"),
        F.sum("tp").alias("_tp"),
        F.avg("precision").alias("_mp"),
        F.avg("recall").alias("_mr"),
        F.avg("f1").alias("_mf"),
        F.sum(F.col("precision") * F.col("support")).alias("_wp"),
        F.sum(F.col("recall") * F.col("support")).alias("_wr"),
        F.sum(F.col("f1") * F.col("support")).alias("_wf"),
    )
    none = F.lit(None).cast("double")
    summary_rows = F.array(
        F.struct(F.lit("accuracy").alias("label"), none.alias("precision"), none.alias("recall"), _safe_div(F.col("_tp"), tot).alias("f1"), tot.alias("support")),
        F.struct(F.lit("macro avg").alias("label"), F.col("_mp").alias("precision"), F.col("_mr").alias("recall"), F.col("_mf").alias("f1"), tot.alias("support")),
        F.struct(
            F.lit("weighted avg").alias("label"),
            _safe_div(F.col("_wp"), tot).alias("precision"),
            _safe_div(F.col("_wr"), tot).alias("recall"),
            _safe_div(F.col("_wf"), tot).alias("f1"),
            tot.alias("support"),
        ),
    )
    summ = s.select(*by, F.explode(summary_rows).alias("_r")).select(*by, "_r.*")
    summ = summ.filter((F.col("label") != "accuracy") | (F.col("support") > 0))
    return rows.unionByName(summ)
