"""Category encodings.

Codes are computed on the distinct-value table (entities x categories rows),
never with a window over the event rows, and joined back.  The distinct table
is reduced with a partial aggregate first, so hot categories or entities do not
gather in one task.  The join back is a plain join: AQE broadcasts the code
table when its measured size is small, else the join stays shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evseq.functions.exprs import concat_text, one_hot
from evseq.operators.aggregates import value_proportions
from evseq.operators.joins import null_safe_join
from evseq.operators.ordered import rank_in_groups


def merge_rare(
    df: DataFrame,
    column: str,
    threshold: float,
    op: str = "<",
    by: Sequence[str] = (),
    other: str = "other",
    out: str | None = None,
) -> DataFrame:
    """M5: ``op='<'`` merges categories whose share is below ``threshold``;
    ``op='>'`` keeps categories whose share is above it and merges the rest.
    Shares are of the rows of ``df`` (per ``by`` group when given).  Both
    comparisons are strict.  A null value stays null under ``<`` and becomes
    ``other`` under ``>`` (a null membership test takes the otherwise branch).
    """
    out = out or column
    props = value_proportions(df, column, by)
    if op == "<":
        picked = props.filter(F.col("proportion") < F.lit(threshold))
    elif op == ">":
        picked = props.filter(F.col("proportion") > F.lit(threshold))
    else:
        raise ValueError(f"op must be '<' or '>', got {op!r}")
    flags = picked.filter(F.col(column).isNotNull()).select(*by, column, F.lit(True).alias("_hit"))
    joined = null_safe_join(df, flags, [*by, column])  # flags hold no null category
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if op == "<":
        expr = F.when(hit, F.lit(other)).otherwise(F.col(column))
    else:
        expr = F.when(hit, F.col(column)).otherwise(F.lit(other))
    return joined.withColumn(out, expr).drop("_hit").select(*df.columns, *([out] if out not in df.columns else []))


def sorted_code_map(df: DataFrame, column: str, by: Sequence[str] = (), code: str = "code", strategy: str = "halo") -> DataFrame:
    """W6/M6/M7 mapping: (by..., value, code) with 0-based codes in byte order.

    Ranks the distinct-value table (values are unique per group, so the row
    position is the dense rank) over a range partitioning, so a column of many
    values is ranked by many tasks."""
    distinct = df.select(*by, column).filter(F.col(column).isNotNull()).distinct()
    ranked = rank_in_groups(distinct, list(by), [column], code, strategy)
    return ranked.withColumn(code, F.col(code).cast("int"))


def sorted_code(df: DataFrame, column: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Dense code of sorted values within a group (null -> null)."""
    m = sorted_code_map(df, column, by, code=out)
    return null_safe_join(df, m, [*by, column]).select(*df.columns, out)


def first_seen_code_map(
    df: DataFrame, column: str, order_by: Sequence[str], by: Sequence[str] = (), code: str = "code", strategy: str = "halo"
) -> DataFrame:
    """W7 mapping: codes by order of first appearance under ``order_by``
    (``strategy`` as in ``sorted_code_map``)."""
    first = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*by, column)
        .agg(F.min(F.struct(*[F.col(c) for c in order_by])).alias("_first"))
    )
    ranked = rank_in_groups(first, list(by), ["_first", column], code, strategy)
    return ranked.withColumn(code, F.col(code).cast("int")).drop("_first")


def first_seen_code(df: DataFrame, column: str, order_by: Sequence[str], out: str, by: Sequence[str] = ()) -> DataFrame:
    """Categorical code by first appearance (null -> null)."""
    m = first_seen_code_map(df, column, order_by, by, code=out)
    return null_safe_join(df, m, [*by, column]).select(*df.columns, out)


def composite_category(df: DataFrame, parts: Sequence[str], out: str, order_by: Sequence[str], sep: str = "-", drop: bool = True) -> DataFrame:
    """M4: ``a-b`` text category coded by first appearance."""
    tmp = df.withColumn(f"_{out}_text", concat_text(*parts, sep=sep))
    coded = first_seen_code(tmp, f"_{out}_text", order_by, out)
    coded = coded.drop(f"_{out}_text")
    return coded.drop(*parts) if drop else coded


def label_codes(df: DataFrame, column: str, by: Sequence[str], code: str) -> tuple[DataFrame, DataFrame]:
    """M6: per-group byte-order codes; returns (coded rows, mapping(by, code, name))."""
    m = sorted_code_map(df, column, by, code=code)
    coded = null_safe_join(df, m, [*by, column])
    mapping = m.select(*by, code, F.col(column).alias("name"))
    return coded, mapping


def dense_remap(labels: DataFrame, label: str, by: Sequence[str], out: str) -> DataFrame:
    """M9 mapping: (by..., original label, dense 0-based id) over all given rows."""
    return sorted_code_map(labels, label, by, code=out)


def one_hot_column(df: DataFrame, y: str, n_classes: Column | int, out: str) -> DataFrame:
    """``array<int>`` of length n_classes with 1 at ``y``."""
    return df.withColumn(out, one_hot(y, n_classes))
