"""Sliding windows and splits.

A window of ``L`` rows is built as a bounded row frame, so it runs through
``ordered.ordered_window``: over halo blocks, or with a plain window per game
when the caller says that groups are games.  Arrays hold structs (``collect_list`` of a struct keeps
null fields) and are then projected into per-channel arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from evseq.operators.joins import null_safe_join
from evseq.operators.ordered import GPOS, ordered_window, rank_in_groups, with_global_position

SPLITS = ("train", "val", "test")


def sliding_windows(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    length: int,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    label_offset: int = 0,
    drop_last: bool = False,
    keep: Sequence[str] = (),
    strategy: str = "halo",
    **kw,
) -> DataFrame:
    """Q1/Q2: one row per window of ``length`` consecutive rows.

    ``x`` is ``array<struct<features>>`` (oldest first) and ``y`` is
    ``label`` of the window's last row, or of the row ``label_offset`` rows
    after it.  Groups shorter than ``length`` give no window; ``drop_last``
    also skips the window ending at a group's last row.  Windows without a
    label are dropped.
    """
    L = int(length)
    after = max(label_offset, 1 if drop_last else 0)

    def build(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(-(L - 1), 0)
        cols = {
            "x": F.collect_list(F.struct(*[F.col(c) for c in features])).over(frame),
            "_n": F.count(F.lit(1)).over(frame),
            "y": (F.lead(F.col(label), label_offset).over(w) if label_offset else F.col(label)),
        }
        if drop_last:
            cols["_last"] = F.lead(F.lit(1), 1).over(w).isNull()
        return cols

    out = ordered_window(df, partition_by, order_by, build, before=L - 1, after=after, strategy=strategy, **kw)
    cond = (F.col("_n") == L) & F.col("y").isNotNull()
    if drop_last:
        cond = cond & ~F.col("_last")
    key = [*partition_by, *[c for c in order_by if c not in partition_by], *[c for c in keep if c not in partition_by and c not in order_by]]
    return out.filter(cond).select(*key, "x", "y")


def window_channels(windows: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Q3: ``x_num`` (L x numeric features, doubles) + one int array per categorical channel."""
    num = F.transform(F.col("x"), lambda s: F.array(*[s[c].cast("double") for c in numeric]))
    chans = {f"x_{c}": F.transform(F.col("x"), _field_as_int(c)) for c in categorical}
    return windows.withColumn("x_num", num).withColumns(chans).drop("x")


def _field_as_int(name: str):
    # a one-argument lambda: a second parameter would make Spark pass the index
    return lambda s: s[name].cast("int")


def window_labels(
    df: DataFrame, label: str, length: int, order_by: Sequence[str], partition_by: Sequence[str] = (), out: str = "y", strategy: str = "halo", **kw
) -> DataFrame:
    """Q4: label ``length`` rows ahead in the group (the label of each window
    that ends before the group's last row); rows without one dropped."""

    def build(w: WindowSpec) -> dict[str, Column]:
        return {out: F.lead(F.col(label), length).over(w)}

    res = ordered_window(df, partition_by, order_by, build, before=0, after=length, strategy=strategy, **kw)
    return res.filter(F.col(out).isNotNull())


def chronological_split(
    df: DataFrame,
    order_by: Sequence[str],
    by: Sequence[str] = (),
    held_out: float = 0.3,
    test_of_held: float = 0.5,
    out: str = "split",
    strategy: str = "halo",
) -> DataFrame:
    """Q5: first rows train, then val, then test, without shuffling.
    ``ceil(held_out * n)`` rows are held out, ``ceil(test_of_held * held)`` of
    them (the last ones) are test (float arithmetic, as the usual splitter)."""
    G, O = list(by), list(order_by)
    if strategy == "direct":
        w = Window.partitionBy(*G).orderBy(*O) if G else Window.orderBy(*O)
        pos = df.withColumn("_rn", F.row_number().over(w) - 1)
        base = pos
        sizes = df.groupBy(*G).agg(F.count(F.lit(1)).alias("_cnt"))
    else:
        g = with_global_position(df, O, G)
        sizes = g.groupBy(*G).agg(F.min(GPOS).alias("_start"), F.count(F.lit(1)).alias("_cnt"))
        base = g
    # per-group size (and start): a join per group, or a scalar subquery without groups
    if G:
        joined = null_safe_join(base, sizes, G)
    else:
        one = sizes.select(F.struct(*sizes.columns).alias("_s")).scalar()
        joined = base.withColumns({c: one[c] for c in sizes.columns})
    if strategy != "direct":
        joined = joined.withColumn("_rn", F.col(GPOS) - F.col("_start")).drop(GPOS, "_start")
    n = F.col("_cnt")
    held = F.ceil(F.lit(float(held_out)) * n)
    test = F.ceil(F.lit(float(test_of_held)) * held)
    n_train = n - held
    n_val = held - test
    rn = F.col("_rn")
    split = F.when(rn < n_train, "train").when(rn < n_train + n_val, "val").otherwise("test")
    return joined.withColumn(out, split).drop("_rn", "_cnt")


def game_split_table(
    df: DataFrame,
    game: str,
    order_by: Sequence[str],
    by: Sequence[str] = (),
    train: float = 0.8,
    val: float = 0.9,
    out: str = "split",
    strategy: str = "halo",
) -> DataFrame:
    """Q6: one row per game with its split: games ordered by first event
    (then game key); cuts at ``int(train * g)`` and ``int(val * g)``.

    The ranking runs on the games table (one row per game, from a partial
    aggregate), by global position over a range partitioning; ``direct`` is a
    window per entity."""
    G = list(by)
    games = df.groupBy(*G, game).agg(F.min(F.struct(*[F.col(c) for c in order_by])).alias("_first"))
    if strategy == "direct":
        w = (Window.partitionBy(*G) if G else Window.partitionBy()).orderBy("_first", game)
        wn = Window.partitionBy(*G) if G else Window.partitionBy()
        ranked = games.withColumn("_i", F.row_number().over(w) - 1).withColumn("_g", F.count(F.lit(1)).over(wn))
    else:
        pos = with_global_position(games, ["_first", game], G)
        stats = pos.groupBy(*G).agg(F.min(GPOS).alias("_s"), F.count(F.lit(1)).alias("_g"))
        if G:
            ranked = null_safe_join(pos, stats, G)
        else:
            one = stats.select(F.struct("_s", "_g")).scalar()
            ranked = pos.withColumns({"_s": one["_s"], "_g": one["_g"]})
        ranked = ranked.withColumn("_i", F.col(GPOS) - F.col("_s"))
    g = F.col("_g").cast("double")
    cut1 = F.floor(F.lit(float(train)) * g)
    cut2 = F.floor(F.lit(float(val)) * g)
    split = F.when(F.col("_i") < cut1, "train").when(F.col("_i") < cut2, "val").otherwise("test")
    return ranked.select(*by, game, split.alias(out))


def rows_with_split(df: DataFrame, splits: DataFrame, game: str, by: Sequence[str] = (), only: str | None = None) -> DataFrame:
    """Attach the game's split to each row (one join), optionally keep one split."""
    out = null_safe_join(df, splits, [*by, game], "inner")
    return out.filter(F.col("split") == only) if only else out


def seeded_shuffle(df: DataFrame, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Q7: deterministic pseudo-random order (hash of key and seed), distributed sort."""
    return df.orderBy(F.xxhash64(*[F.col(c) for c in key], F.lit(seed)), *key)


def block_shuffle(
    df: DataFrame, key: Sequence[str], epoch: int = 0, seed: int = 42, block_rows: int = 100_000, n_rows: int | None = None
) -> DataFrame:
    """Q7 without a global sort: rows are dealt to blocks of about ``block_rows``
    by a seeded hash of the key and put in a second hash's order inside; one hash
    exchange, and never more than a block to sort at a time.  Another ``epoch``
    gives another order.  Adds ``block`` and ``slot`` (place in the block); the key
    must tell rows apart.  ``n_rows``: the number of rows where it is known."""
    n = df.count() if n_rows is None else n_rows
    blocks = max(1, -(-n // block_rows))
    mixed = [F.lit(seed), F.lit(epoch), *[F.col(c) for c in key]]
    block = F.pmod(F.xxhash64(F.lit("block"), *mixed), F.lit(blocks))
    order = Window.partitionBy("block").orderBy(F.xxhash64(F.lit("slot"), *mixed), *key)
    return df.withColumn("block", block).withColumn("slot", F.row_number().over(order) - 1)


def padded_windows(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    length: int,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    buckets: Sequence[int] = (),
    keep: Sequence[str] = (),
    **kw,
) -> DataFrame:
    """Windows of all rows, those with fewer than ``length`` rows before them too.

    ``x`` is padded in front with nulls up to ``bucket``, the smallest of
    ``buckets`` (``length`` is always one) that holds the rows there are, and
    ``mask`` is 1 where a row stands.  Rows without a label are dropped."""
    L = int(length)
    sizes = sorted({b for b in buckets if 0 < b < L} | {L})

    def build(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(-(L - 1), 0)
        return {"x": F.collect_list(F.struct(*[F.col(c) for c in features])).over(frame), "y": F.col(label)}

    out = ordered_window(df, partition_by, order_by, build, before=L - 1, after=0, **kw).filter(F.col("y").isNotNull())
    n = F.size("x")
    bucket = F.coalesce(*[F.when(n <= b, F.lit(b)) for b in sizes])
    key = list(dict.fromkeys([*partition_by, *order_by, *keep]))
    pad = bucket - n
    empty = F.lit(None).cast(out.schema["x"].dataType.elementType)
    return out.select(
        *key,
        F.concat(F.array_repeat(empty, pad), "x").alias("x"),
        F.concat(F.array_repeat(F.lit(0), pad), F.array_repeat(F.lit(1), n)).alias("mask"),
        bucket.alias("bucket"),
        "y",
    )


def mini_batches(df: DataFrame, by: Sequence[str], order_by: Sequence[str], batch_rows: int) -> DataFrame:
    """Number rows into batches of ``batch_rows`` in order, from 0 for each value of
    ``by`` (split, length bucket), so that no batch crosses one; the last batch of
    each may be short.  ``order_by`` must make rows of a group distinct."""
    ranked = rank_in_groups(df, by, order_by, "_at")
    b = F.lit(int(batch_rows))
    return ranked.withColumn("batch", F.floor(F.col("_at") / b).cast("long")).withColumn("slot", (F.col("_at") % b).cast("int")).drop("_at")


def flatten_windows(windows: DataFrame, key: Sequence[str], array_col: str = "x_num", features: Sequence[str] = ()) -> DataFrame:
    """Q8: window x step -> one row per (window, step) with one column per feature."""
    ex = windows.select(*key, F.posexplode(array_col).alias("step", "_v"))
    return ex.select(*key, F.col("step").cast("int").alias("step"), *[F.col("_v")[i].alias(f) for i, f in enumerate(features)])


def unflatten_windows(flat: DataFrame, key: Sequence[str], features: Sequence[str], out: str = "x_num") -> DataFrame:
    """Q8 inverse: back to one array of feature arrays per window (bounded by L rows each)."""
    rows = F.sort_array(F.collect_list(F.struct(F.col("step"), F.array(*[F.col(f) for f in features]).alias("v"))))
    return flat.groupBy(*key).agg(F.transform(rows, lambda s: s["v"]).alias(out))
