"""Composed stages: clean -> featurize -> split -> fit -> score -> evaluate.

Each stage is a function of DataFrames; nothing is collected.  The default
arguments are those of the reference workflow (top 2 entities, rare share
3 %, codes per entity in byte order, next code per (entity, game), windows of
10, games split 80/10/10), expressed through column-name arguments so other
event tables work the same way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from evseq.functions.exprs import concat_text, fill_null, flag_not_null, strict_map, weighted_sum
from evseq.operators.encode import first_seen_code, label_codes, merge_rare
from evseq.operators.features import next_event_target
from evseq.operators.filters import drop_nulls, rows_of_top_k
from evseq.operators.model import (
    class_counts,
    context_lags,
    context_strings,
    fit_transition_counts,
    score_transitions,
    transition_table,
    with_contexts,
)
from evseq.operators.ordered import ordered_window
from evseq.operators.sequences import game_split_table, rows_with_split
from evseq.session import materialize

# Fixed values of the reference workflow.
HAND_CODES = {"R": 0, "L": 1}
TOP_K_ENTITIES = 2
RARE_SHARE = 0.03
SEQ_LEN = 10


@dataclass(frozen=True)
class Roles:
    """Column roles of an event table."""

    entity: str = "player_name"
    game: str = "game_pk"
    order: tuple[str, ...] = ("game_date", "at_bat_number", "pitch_number")
    label: str = "pitch_type"
    required: tuple[str, ...] = ("pitch_type", "release_speed")
    code: str = "pitch_type_code"
    target: str = "next_pitch_type_code"
    extra: dict = field(default_factory=dict)


ROLES = Roles()


def label_counts(f: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Counts per (entity, label): one partial aggregate over the event rows."""
    r = roles
    return f.groupBy(r.entity, r.label).agg(F.count(F.lit(1)).alias("n"))


def label_lookup(counts: DataFrame, roles: Roles = ROLES, top_k: int = TOP_K_ENTITIES, rare: float = RARE_SHARE) -> DataFrame:
    """The whole per-entity label logic on the (entity, label) count table.

    Top-k entities (A2), shares and the rare merge (A4, M5) and the byte-order
    codes of the merged labels (M6) are all computed on the small count table.
    Output: (entity, label, merged label, code), at most k x labels rows.
    """
    r = roles
    per_entity = counts.groupBy(r.entity).agg(F.sum(F.when(F.col(r.label).isNotNull(), F.col("n"))).alias("count"))
    top = per_entity.orderBy(F.col("count").desc(), F.col(r.entity).asc_nulls_first()).limit(top_k).select(r.entity)
    kept = counts.join(top, r.entity, "left_semi")
    w = Window.partitionBy(r.entity)
    share = F.col("n") / F.sum("n").over(w)
    merged = kept.withColumn("_merged", F.when(share < F.lit(rare), F.lit("other")).otherwise(F.col(r.label)))
    code = (F.dense_rank().over(Window.partitionBy(r.entity).orderBy("_merged")) - 1).cast("int")
    return merged.withColumn(r.code, code).select(r.entity, r.label, "_merged", r.code)


def clean_slice(df: DataFrame, roles: Roles = ROLES, top_k: int = TOP_K_ENTITIES, rare: float = RARE_SHARE) -> tuple[DataFrame, DataFrame]:
    """Required non-null -> top-k entities -> rare labels merged per entity ->
    label codes per entity.  Returns (coded rows, code map (entity, code, name)).

    Two passes over the event rows: the count aggregate and one join with the
    small lookup (which also drops the rows of the other entities).  Needs the
    label among the required columns (null labels dropped first); otherwise
    the operator chain (J1 -> M5 -> M6) is used.
    """
    r = roles
    f = drop_nulls(df, list(r.required))
    if r.label not in r.required:
        t = rows_of_top_k(f, r.entity, r.label, top_k)
        m = merge_rare(t, r.label, rare, "<", by=[r.entity])
        return label_codes(m, r.label, [r.entity], r.code)
    # the count table (entities x labels rows) is written once: the lookup, the
    # code map and the class counts all derive from it, so the event rows are
    # scanned exactly twice (this aggregate and the join below)
    counts = materialize(label_counts(f, roles))
    # the derived lookup (<= k x labels rows) is written too: the row join,
    # the code map and the class counts then read it instead of re-deriving it
    lookup = materialize(label_lookup(counts, roles, top_k, rare))
    coded = f.join(lookup, [r.entity, r.label], "inner")
    coded = coded.withColumn(r.label, F.col("_merged")).drop("_merged")
    mapping = lookup.select(r.entity, r.code, F.col("_merged").alias("name")).distinct()
    return coded, mapping


def encode_columns(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The cleaning encodings of the event table, chained (fixture columns).

    hands -> 0/1 strict; ``type`` -> ``pitch_result`` coded by first
    appearance after null -> 'N/A'; ``spin_axis`` -> -1 then smallint;
    ``hit_location`` -> 0 then tinyint; sentinels -1 / -1.0; ``balls-strikes``
    coded by first appearance; runner ids -> presence flags.
    """
    out = df.withColumns(
        {
            "stand": strict_map("stand", HAND_CODES, "stand"),
            "p_throws": strict_map("p_throws", HAND_CODES, "p_throws"),
            "spin_axis": fill_null("spin_axis", "-1").cast("smallint"),
            "hit_location": fill_null("hit_location", 0).cast("tinyint"),
            "release_spin_rate": fill_null("release_spin_rate", -1.0),
            "effective_speed": fill_null("effective_speed", -1.0),
            "pitch_result": fill_null("type", "N/A"),
            "_bs": concat_text("balls", "strikes", sep="-"),
            "on_1b": flag_not_null("on_1b"),
            "on_2b": flag_not_null("on_2b"),
            "on_3b": flag_not_null("on_3b"),
        }
    ).drop("type")
    out = first_seen_code(out, "pitch_result", list(order), "_pr")
    out = first_seen_code(out, "_bs", list(order), "balls_strikes")
    out = out.withColumn("pitch_result", F.col("_pr")).drop("_pr", "_bs", "balls", "strikes")
    return out.withColumn("baserunner_state", weighted_sum(["on_1b", "on_2b", "on_3b"], (1, 2, 3)))


def with_target(coded: DataFrame, roles: Roles = ROLES, strategy: str = "halo", context_k: int = 0) -> DataFrame:
    """Next code per (entity, game), rows without one dropped.

    With ``context_k`` the transition contexts (last codes of the game) come
    from the same window node as the lead: one sort of the rows instead of
    two.  Dropping rows without a target removes only the last row of each
    game, so the backward-looking contexts are the same as after the drop."""
    r = roles
    G, O = [r.entity, r.game], list(r.order)
    if context_k <= 1:
        out = next_event_target(coded, r.code, r.target, O, G, strategy=strategy)
        return context_strings(out, r.code, context_k) if context_k else out

    def build(w: WindowSpec) -> dict[str, Column]:
        return {r.target: F.lead(F.col(r.code), 1).over(w), **context_lags(w, r.code, context_k)}

    led = ordered_window(coded, G, O, build, before=context_k - 1, after=1, strategy=strategy)
    return context_strings(drop_nulls(led, [r.target, r.code]), r.code, context_k)


def split_by_game(rows: DataFrame, roles: Roles = ROLES, strategy: str = "halo") -> DataFrame:
    r = roles
    splits = game_split_table(rows, r.game, list(r.order), [r.entity], strategy=strategy)
    return rows_with_split(rows, splits, r.game, [r.entity])


def transition_scores(
    split_rows: DataFrame,
    mapping: DataFrame,
    roles: Roles = ROLES,
    k: int = 2,
    alpha: float = 1.0,
    strategy: str = "halo",
    write_scores: bool = True,
) -> DataFrame:
    """Fit the order-k transition model on ``split='train'`` and score every row.

    Output: entity, game, order keys, split, ``y`` (true next code), ``p``,
    ``pred``, ``order_used``.  ``write_scores`` cuts lineage after scoring;
    worth it when two or more aggregates read the scores, not for one.
    """
    r = roles
    by = [r.entity]
    # stage boundary: fit and k+1 scoring joins all read these rows
    if f"ctx_{k}" not in split_rows.columns:
        split_rows = with_contexts(split_rows, r.code, k, list(r.order), [r.entity, r.game], strategy=strategy)
    # only what the fit and the scores use is written
    cols = [r.entity, r.game, *r.order, "split", r.target, *[f"ctx_{j}" for j in range(k + 1)]]
    ctx = materialize(split_rows.select(*dict.fromkeys(cols)), "contexts")
    classes = class_counts(mapping, by, r.code)
    counts = fit_transition_counts(ctx, by, r.target, k, F.col("split") == "train")
    # the fitted model (entities x contexts rows) is an artifact of its own:
    # written once, read by the k+1 back-off joins
    model = materialize(transition_table(counts, classes, by, alpha), "model")
    scored = score_transitions(ctx, model, classes, by, k, alpha)
    out = scored.select(r.entity, r.game, *r.order, "split", F.col(r.target).alias("y"), "p", "pred", "order_used")
    # stage boundary: every metric of the evaluation reads the scored table
    return materialize(out) if write_scores else out


def classes_of(mapping: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return class_counts(mapping, [roles.entity], roles.code)
