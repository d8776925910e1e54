"""Ordered-sequence windows that survive hot groups and global order.

A window ``partitionBy(G).orderBy(O)`` puts every row of one group into one
task, and a window without ``partitionBy`` puts the whole table into one task.
Both break when one group (or the table) is large.  For frames that reach a
bounded number of rows back/forward (lead, rolling mean, sliding windows) and
for fills whose carry can be summarised per block, this module computes the
same result in bounded pieces:

1. ``repartitionByRange(n, G + O)`` + ``sortWithinPartitions`` spreads even a
   single hot group over many partitions in order; the rows are written with
   their partition and index (Parquet, below ``spark.checkpoint.dir``) so
   sampled range bounds and row positions are fixed once.
2. A global position ``_gpos`` = index inside the Spark partition
   (``monotonically_increasing_id`` low bits) + offset of the partition.  The
   offsets come from an aggregate with one row per Spark partition.
3. ``_blk = _gpos div B``; the last ``before`` rows of every block are copied to
   the next block, the first ``after`` rows to the previous one (halo).
4. The window runs partitioned by ``(G, _blk)``: at most ``B + before + after``
   rows per window partition, whatever the group sizes.  Copies are dropped.

This is the one path of every operator here.  A caller whose groups are small by
the meaning of the data (the events of one game) may name ``strategy='direct'``,
a plain window per group; nothing is measured and both give the same rows, null
group keys included.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from evseq.operators.joins import null_safe_join
from evseq.session import materialize

GPOS = "_gpos"
BLK = "_blk"
OWN = "_own"

DEFAULT_BLOCK_ROWS = 1_000_000

WindowBuilder = Callable[[WindowSpec], Mapping[str, Column]]


def _n_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_global_position(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    n_partitions: int | None = None,
) -> DataFrame:
    """Add ``_gpos``: 0-based position of the row in ``(partition_by, order_by)`` order.

    ``order_by`` must end in a unique key so the order is total.
    """
    keys = [*partition_by, *order_by]
    n = _n_partitions(df, n_partitions)
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    mid = materialize(ranged.withColumn("_mid", F.monotonically_increasing_id()), "ordered")
    mid = mid.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_idx", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )
    # one row per Spark partition
    sizes = mid.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias(
            "_off"
        ),
    )
    out = mid.join(offsets, "_pid").withColumn(GPOS, F.col("_idx") + F.col("_off"))
    return out.drop("_mid", "_pid", "_idx", "_off")


def _with_blocks(df: DataFrame, block_rows: int, before: int, after: int) -> DataFrame:
    """Each row once in its own block, plus a copy in the next block when it is
    among the last ``before`` rows and in the previous block when among the
    first ``after`` rows; one pass (explode), no union of re-reads."""
    b = max(int(block_rows), before, after, 1)
    gp = F.col(GPOS)
    blk = F.floor(gp / F.lit(b)).cast("long")
    entries = [F.struct(blk.alias(BLK), F.lit(True).alias(OWN))]
    if before > 0:
        entries.append(F.when(gp % b >= b - before, F.struct((blk + 1).alias(BLK), F.lit(False).alias(OWN))))
    if after > 0:
        entries.append(F.when(gp % b < after, F.struct((blk - 1).alias(BLK), F.lit(False).alias(OWN))))
    copies = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return df.withColumn("_e", F.explode(copies)).select(*df.columns, "_e.*")


def ordered_window(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    build: WindowBuilder,
    before: int,
    after: int,
    strategy: str = "halo",
    block_rows: int = DEFAULT_BLOCK_ROWS,
    n_partitions: int | None = None,
) -> DataFrame:
    """Add the columns ``build(w)`` returns, where ``w`` is the window
    ``partitionBy(partition_by).orderBy(order_by)``.

    Every frame used by ``build`` must stay within ``before`` rows back and
    ``after`` rows forward of the current row (``lead(c, k)`` needs ``after>=k``,
    ``rowsBetween(-4, 0)`` needs ``before>=4``).
    """
    G, O = list(partition_by), list(order_by)
    if strategy == "direct":
        w = Window.partitionBy(*G).orderBy(*O) if G else Window.orderBy(*O)
        return df.withColumns(dict(build(w)))
    pos = with_global_position(df, O, G, n_partitions=n_partitions)
    blocks = _with_blocks(pos, block_rows, before, after)
    w = Window.partitionBy(*G, BLK).orderBy(GPOS)
    out = blocks.withColumns(dict(build(w))).filter(F.col(OWN))
    return out.drop(GPOS, BLK, OWN)


def ordered_fill(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    value: str,
    out: str,
    direction: str = "backward",
    include_current: bool = True,
    strategy: str = "halo",
    block_rows: int = DEFAULT_BLOCK_ROWS,
    n_partitions: int | None = None,
) -> DataFrame:
    """Gap fill inside ordered groups.

    ``backward``: first non-null value at (or, without ``include_current``,
    after) the row.  ``forward``: last non-null value at or before (or strictly
    before) the row.  Unbounded frames, so the skew-safe form carries one value
    per block: a small ``(G, block)`` summary, a window over blocks of a group,
    and a join on ``(G, block)`` that shares the window's partitioning.
    """
    G, O = list(partition_by), list(order_by)
    start = 0 if include_current else 1
    backward = direction == "backward"

    def frame(partition: list[str], order: list[str]) -> Column:
        # Both directions as a *growing* frame (unbounded preceding .. current
        # or .. 1 preceding): one running pass.  A backward fill is a forward
        # fill over the reversed order; the shrinking frame (current ..
        # unbounded following) would re-aggregate the rest of the partition
        # for every row.
        keys = [F.col(c).desc_nulls_last() for c in order] if backward else [F.col(c).asc_nulls_first() for c in order]
        w = Window.partitionBy(*partition).orderBy(*keys) if partition else Window.orderBy(*keys)
        return F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -start))

    if strategy == "direct":
        return df.withColumn(out, frame(G, O))

    pos = with_global_position(df, O, G, n_partitions=n_partitions)
    b = max(int(block_rows), 1)
    blk = pos.withColumn(BLK, F.floor(F.col(GPOS) / F.lit(b)).cast("long"))
    local = blk.withColumn("_local", frame([*G, BLK], [GPOS]))
    nn = F.col(value).isNotNull()
    if backward:
        summary = blk.groupBy(*G, BLK).agg(F.min_by(F.col(value), F.when(nn, F.col(GPOS))).alias("_edge"))
        carry_w = Window.partitionBy(*G).orderBy(F.col(BLK).desc()).rowsBetween(Window.unboundedPreceding, -1)
        carry = summary.select(*G, BLK, F.last("_edge", ignorenulls=True).over(carry_w).alias("_carry"))
    else:
        summary = blk.groupBy(*G, BLK).agg(F.max_by(F.col(value), F.when(nn, F.col(GPOS))).alias("_edge"))
        carry_w = Window.partitionBy(*G).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
        carry = summary.select(*G, BLK, F.last("_edge", ignorenulls=True).over(carry_w).alias("_carry"))
    keys = [*G, BLK]
    joined = null_safe_join(local, carry, keys)
    res = joined.withColumn(out, F.coalesce(F.col("_local"), F.col("_carry")))
    return res.select(*df.columns, out)


def rank_in_groups(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str | Column],
    out: str,
    strategy: str = "halo",
    n_partitions: int | None = None,
) -> DataFrame:
    """0-based position of each row inside its group in ``order_by`` order
    (``order_by`` must make rows of a group distinct).

    Global position over a range partitioning minus the group's first position
    (a small per-group aggregate), so a group with very many rows is ranked by
    many tasks.  ``direct``: ``row_number`` over a window per group, for groups
    that are small by the meaning of the data."""
    G = list(partition_by)
    if strategy == "direct":
        w = (Window.partitionBy(*G) if G else Window.partitionBy()).orderBy(*order_by)
        return df.withColumn(out, (F.row_number().over(w) - 1).cast("long"))
    names = [c for c in order_by if isinstance(c, str)]
    if len(names) != len(order_by):
        raise ValueError("the halo ranking needs column names to order by")
    pos = with_global_position(df, names, G, n_partitions=n_partitions)
    starts = pos.groupBy(*G).agg(F.min(GPOS).alias("_start"))
    if G:
        ranked = null_safe_join(pos, starts, G)
    else:
        ranked = pos.withColumn("_start", starts.select(F.col("_start")).scalar())
    return ranked.withColumn(out, F.col(GPOS) - F.col("_start")).drop(GPOS, "_start")
