"""Registered queries: one per operator ID of the inventory.

Every query reads the driver's tables (``events`` through the fixture view,
``lineitem`` for the calendar operators) in full and returns a DataFrame; the
matching DuckDB text is in ``ORACLE`` when SQL can express it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evseq.fixtures import pitches
from evseq.functions import exprs as X
from evseq.operators import aggregates as A
from evseq.operators import columns as P
from evseq.operators import encode as E
from evseq.operators import evaluate as EV
from evseq.operators import features as W
from evseq.operators import filters as FL
from evseq.operators import joins as J
from evseq.operators import model as L
from evseq.operators import sequences as Q
from evseq.plans import sql as S
from evseq.plans.stages import (
    HAND_CODES,
    ROLES,
    SEQ_LEN,
    classes_of,
    clean_slice,
    encode_columns,
    split_by_game,
    transition_scores,
    with_target,
)
from evseq.session import materialize, shared_dir
from evseq.sources import io

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

ENT = ROLES.entity
GAME = ROLES.game
ORDER = list(ROLES.order)
ORD = S.ORD


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- builders
def _f(spark, sf):
    return FL.drop_nulls(pitches(spark, sf), ["pitch_type", "release_speed"])


def _coded(spark, sf):
    return clean_slice(pitches(spark, sf))


def _target(spark, sf, context_k=0, keep=()):
    """Rows with the next code: keys, order, code and the columns in ``keep``.
    The ordered stage is written, so what it does not hold is never read."""
    c, m = _coded(spark, sf)
    c = c.select(*dict.fromkeys([ENT, GAME, "event_id", *ORDER, "pitch_type_code", *keep]))
    return with_target(c, context_k=context_k), m


def _split(spark, sf, keep=()):
    t, m = _target(spark, sf, keep=keep)
    return split_by_game(t), m


def _scored(spark, sf, reused=True):
    """Scored rows; written (lineage cut) only when ``reused`` by several aggregates."""
    t, m = _target(spark, sf, context_k=2)  # contexts from the target's window node
    s = split_by_game(t, strategy="halo")
    return transition_scores(s, m, write_scores=reused), m


def _test(spark, sf, reused=True):
    sc, m = _scored(spark, sf, reused)
    return sc.filter(F.col("split") == "test"), m


TGT_COLS = "player_name, game_pk, event_id, pitch_type, pitch_type_code, next_pitch_type_code"


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Minimal slice: required non-null, top-2 entities, rare merge per
    entity, codes per entity, next code per (entity, game)."""
    t, _ = _target(spark, sf, keep=["pitch_type"])
    return t.select(ENT, GAME, "event_id", "pitch_type", "pitch_type_code", "next_pitch_type_code")


register("M13_next_event_target", S.q(S.TARGET, f"select {TGT_COLS} from tgt"))(flagship)


# ---------------------------------------------------------------- 2.1 sources / sinks
@register("S1_parquet_scan", "select event_id, ts, user_id, event_type, value from events")
def s1(spark, sf):
    return io.read_events(spark, io.table_path(sf, "events"), ["event_id", "ts", "user_id", "event_type", "value"])


CLEAN_OUT = "player_name, game_pk, event_id, game_date, at_bat_number, pitch_number, pitch_type, pitch_type_code, release_speed"


def _clean_out(spark, sf):
    c, _ = _coded(spark, sf)
    return c.select(ENT, GAME, "event_id", *ORDER, "pitch_type", "pitch_type_code", "release_speed")


@register("S2_parquet_sink", S.q(S.CLEAN, f"select {CLEAN_OUT} from c"))
def s2(spark, sf):
    return io.round_trip_parquet(spark, _clean_out(spark, sf), shared_dir(spark, "s2"))


@register("S3_parquet_sink_gzip", S.q(S.CLEAN, f"select {CLEAN_OUT} from c"))
def s3(spark, sf):
    return io.round_trip_parquet(spark, _clean_out(spark, sf), shared_dir(spark, "s3"), compression="gzip")


@register("S4_partitioned_sink", S.q(S.CLEAN, f"select {CLEAN_OUT} from c"))
def s4(spark, sf):
    return io.round_trip_parquet(spark, _clean_out(spark, sf), shared_dir(spark, "s4"), partition_by=[ENT])


@register(
    "S5_date_range_load",
    "select l_orderkey, l_linenumber, l_shipdate, l_quantity from lineitem "
    "where cast(l_shipdate as date) between date '1996-03-01' and date '1996-09-30'",
)
def s5(spark, sf):
    li = io.read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"])
    return io.load_date_range(li, "l_shipdate", "1996-03-01", "1996-09-30")


METRICS_SQL = S.q(
    S.MODEL + [S.TEST],
    "select te.player_name, round(avg(case when y = pred then 1.0 else 0.0 end), 6) as accuracy, "
    "round(avg(case when list_contains([x.i for x in list_slice(list_reverse(list_sort(list_transform(p, lambda v, i: {'v': v, 'i': i - 1}))), 1, 2)], y) then 1.0 else 0.0 end), 6) as top2_accuracy "
    "from te group by te.player_name",
)


@register("S6_metrics_json", METRICS_SQL)
def s6(spark, sf):
    """The evaluation written as JSON at full precision: metrics per entity
    (one folder each), the report per entity and the summary.  The scores are
    made once; the per-entity metrics are read back and rounded for the result."""
    te, m = _test(spark, sf)
    names = m.withColumnRenamed("pitch_type_code", "code")
    met = materialize(EV.entity_metrics(te, classes_of(m), names, [ENT]), "metrics")
    base = shared_dir(spark, "s6")
    io.write_json(EV.summary(met), f"{base}/summary")
    io.write_json(EV.classification_report(te, classes_of(m), names, [ENT]), f"{base}/reports", partition_by=[ENT])
    back = io.round_trip_json(spark, met, f"{base}/entities", partition_by=[ENT])
    return back.select(ENT, X.round6("accuracy").alias("accuracy"), X.round6("top2_accuracy").alias("top2_accuracy"))


SEQ_FEATURES = ["release_speed", "release_spin_rate", "effective_speed", "pitch_type_code"]


def _windows(spark, sf, keep_split=True):
    s, _ = _split(spark, sf, keep=SEQ_FEATURES)
    w = Q.sliding_windows(
        s, SEQ_FEATURES, "next_pitch_type_code", SEQ_LEN, ORDER, [ENT, GAME], keep=["event_id", "split"]
    )
    return w


WIN_SQL_BODY = (
    "wv as (select player_name, game_pk, game_date, at_bat_number, pitch_number, event_id, split, "
    "list([release_speed, release_spin_rate, effective_speed, cast(pitch_type_code as double)]) over w as x_num, "
    "count(*) over w as n_rows, next_pitch_type_code as y from sr "
    "window w as (partition by player_name, game_pk order by " + ORD + " rows between 9 preceding and current row))"
)


@register(
    "S7_sequence_store",
    S.q(S.SPLIT + [WIN_SQL_BODY], "select player_name, game_pk, event_id, split, x_num, y from wv where n_rows = 10"),
)
def s7(spark, sf):
    w = Q.window_channels(_windows(spark, sf), SEQ_FEATURES, [])
    out = w.select(ENT, GAME, "event_id", "split", "x_num", "y")
    return io.round_trip_parquet(spark, out, shared_dir(spark, "s7"), partition_by=[ENT, "split"])


def _lr_inputs(spark, sf):
    """Flattened windows with the global name code as label (L2 inputs)."""
    s, m = _split(spark, sf, keep=["release_speed", "release_spin_rate"])
    names = E.sorted_code_map(m.select(F.col("name").alias("label_name")), "label_name", code="label")
    cols = [ENT, GAME, "event_id", *ORDER, "split", "pitch_type_code", "next_pitch_type_code", "release_speed", "release_spin_rate"]
    s = materialize(s.select(*dict.fromkeys(cols)), "split")
    s = W.standard_scale(s, ["release_speed", "release_spin_rate"], fit_on=F.col("split") == "train")
    s2 = s.join(
        m.select(ENT, F.col("pitch_type_code").alias("next_pitch_type_code"), F.col("name").alias("label_name")),
        [ENT, "next_pitch_type_code"],
        "left",
    ).join(names, "label_name", "left")
    feats = ["release_speed", "release_spin_rate", "pitch_type_code"]
    w = Q.sliding_windows(
        s2, feats, "label", SEQ_LEN, ORDER, [ENT, GAME], keep=["event_id", "split", "label_name"]
    )
    w = Q.window_channels(w, feats, [])
    flat = F.transform(F.flatten("x_num"), lambda v: F.coalesce(v, F.lit(0.0)))  # 0 is the scaled mean
    w = w.withColumn("features", flat).withColumn("y", F.col("y").cast("double"))
    return materialize(w.select(ENT, "event_id", "split", "label_name", "features", "y"), "windows")


def _lr_fit(data):
    """The fit of L2 and S8: balanced class weights of the training windows (L3)."""
    train = data.filter(F.col("split") == "train")
    return L.fit_logistic(L.sample_weights(train, train, "y", [], "weight"), "features", "y", weight="weight")


@register("S8_training_history")
def s8(spark, sf):
    data = _lr_inputs(spark, sf)
    model = _lr_fit(data)
    hist = model.summary.objectiveHistory  # one value per iteration
    h = spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "epoch int, loss double")
    base = shared_dir(spark, "s8")
    # class map of the fit: label code <-> class name (M9-style dense ids)
    classes = data.select("label_name", F.col("y").cast("int").alias("label")).distinct()
    io.write_parquet(classes, f"{base}/classes")
    return io.round_trip_parquet(spark, h, f"{base}/history")


# ---------------------------------------------------------------- 2.2 projections
KEEP = ["pitch_type", "game_date", "release_speed", "player_name", "stand", "p_throws", "type", "balls", "strikes", "on_3b", "on_2b", "on_1b"]


@register("P1_select", S.q([], "select " + ", ".join(KEEP) + " from pitches"))
def p1(spark, sf):
    return P.select_columns(pitches(spark, sf), KEEP)


@register(
    "P2_add_columns",
    S.q(
        [],
        "select event_id, case when coalesce(on_1b, 0) = 0 then 0 else 1 end as on_1b, "
        "cast(year(strptime(game_date, '%Y-%m-%d')) as integer) as year, release_speed * 2 as speed2 from pitches",
    ),
)
def p2(spark, sf):
    df = pitches(spark, sf)
    out = P.add_columns(
        df,
        {"on_1b": X.flag_nonzero("on_1b"), "year": X.year_of(X.parse_date("game_date")), "speed2": F.col("release_speed") * 2},
    )
    return out.select("event_id", "on_1b", "year", "speed2")


@register("P3_rename", S.q([], "select event_id, type as pitch_result from pitches"))
def p3(spark, sf):
    return P.rename(pitches(spark, sf), {"type": "pitch_result"}).select("event_id", "pitch_result")


@register("P4_drop", S.q([], "select * exclude (on_1b, on_2b, on_3b) from pitches"))
def p4(spark, sf):
    return P.drop_columns(pitches(spark, sf), ["on_1b", "on_2b", "on_3b"])


FILL_COLS = ["release_spin_rate", "release_speed", "effective_speed"]


@register(
    "P5_map_columns",
    S.q([], "select event_id, " + ", ".join(f"coalesce({c}, -1.0) as {c}" for c in FILL_COLS) + " from pitches"),
)
def p5(spark, sf):
    out = P.map_columns(pitches(spark, sf), FILL_COLS, lambda c: F.coalesce(c, F.lit(-1.0)))
    return out.select("event_id", *FILL_COLS)


NUM_EXCL = ["event_id", "pitcher", "game_pk", "pitch_number"]


@register(
    "P6_numeric_columns",
    S.q(
        [],
        "select at_bat_number, release_speed, release_spin_rate, effective_speed, hit_location, balls, strikes, "
        "outs_when_up, inning, on_1b, on_2b, on_3b from pitches",
    ),
)
def p6(spark, sf):
    df = pitches(spark, sf)
    return df.select(*P.numeric_columns(df, NUM_EXCL))


@register(
    "P7_exclude_columns",
    S.q([], "select * exclude (game_date, player_name, pitch_type, spin_axis, stand, p_throws, type) from pitches"),
)
def p7(spark, sf):
    df = pitches(spark, sf)
    return df.select(*P.columns_except(df, ["game_date", "player_name", "pitch_type", "spin_axis", "stand", "p_throws", "type"]))


@register(
    "P8_cast",
    S.q(
        [],
        "select event_id, cast(spin_axis as smallint) as spin_axis, cast(release_spin_rate as float) as release_spin_rate, "
        "cast(hit_location as tinyint) as hit_location, try_cast(player_name as integer) as name_as_int from pitches",
    ),
)
def p8(spark, sf):
    df = P.cast_columns(pitches(spark, sf), {"spin_axis": "smallint", "release_spin_rate": "float", "hit_location": "tinyint"})
    df = df.withColumn("name_as_int", F.col("player_name").try_cast("int"))
    return df.select("event_id", "spin_axis", "release_spin_rate", "hit_location", "name_as_int")


@register(
    "P9_literal_alias",
    S.q([], "select event_id as id, 'other' as tag, cast(1 as integer) as one, release_speed as speed from pitches"),
)
def p9(spark, sf):
    df = pitches(spark, sf)
    return df.select(F.col("event_id").alias("id"), F.lit("other").alias("tag"), F.lit(1).alias("one"), F.col("release_speed").alias("speed"))


@register(
    "P10_unnest_struct",
    S.q([S.F], "select pitch_type, cast(count(*) as bigint) as count from f group by pitch_type"),
)
def p10(spark, sf):
    vc = A.value_counts(_f(spark, sf), "pitch_type", sort=False)
    nested = vc.select(F.struct("pitch_type", "count").alias("vc"))
    return P.unnest(nested, "vc")


# ---------------------------------------------------------------- 2.3 filters
@register(
    "F1_recent_years",
    "select l_orderkey, l_linenumber, cast(year(l_shipdate) as integer) as year from lineitem "
    "where year(l_shipdate) >= (select max(year(l_shipdate)) from lineitem) - 3",
)
def f1(spark, sf):
    li = io.read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"])
    return FL.recent_years(li, "l_shipdate", 3, year_col="year").select("l_orderkey", "l_linenumber", "year")


@register("F2_drop_nulls", S.q([S.F], "select event_id, pitch_type, release_speed, effective_speed from f"))
def f2(spark, sf):
    return _f(spark, sf).select("event_id", "pitch_type", "release_speed", "effective_speed")


@register("F3_is_in", S.q([], "select event_id, pitch_type from pitches where pitch_type in ('CL', 'VI', 'EP')"))
def f3(spark, sf):
    return FL.is_in(pitches(spark, sf), "pitch_type", ["CL", "VI", "EP"]).select("event_id", "pitch_type")


@register("F4_equals", S.q([], "select event_id, player_name, game_pk from pitches where player_name = 'P1'"))
def f4(spark, sf):
    return FL.equals(pitches(spark, sf), "player_name", "P1").select("event_id", "player_name", "game_pk")


@register(
    "F5_is_null",
    S.q([], "select event_id, pitch_type is null as pitch_type_null, case when on_3b is null then 0 else 1 end as on_3b from pitches"),
)
def f5(spark, sf):
    df = pitches(spark, sf)
    return df.select("event_id", F.col("pitch_type").isNull().alias("pitch_type_null"), X.flag_not_null("on_3b").alias("on_3b"))


@register(
    "F6_case_when",
    S.q(
        [],
        "select event_id, case when balls = 3 and strikes = 2 then 'full' when balls > strikes then 'ahead' "
        "when type is null then 'unknown' else 'other' end as count_state from pitches",
    ),
)
def f6(spark, sf):
    df = pitches(spark, sf)
    b, s = F.col("balls"), F.col("strikes")
    expr = FL.case_when([((b == 3) & (s == 2), "full"), (b > s, "ahead"), (F.col("type").isNull(), "unknown")], "other")
    return df.select("event_id", expr.alias("count_state"))


@register("F7_frequency_filter", S.q([S.F, S.TOP, S.T, S.PE], "select player_name, pitch_type, proportion from pe where proportion < 0.03"))
def f7(spark, sf):
    t = FL.rows_of_top_k(_f(spark, sf), ENT, "pitch_type", 2)
    props = A.value_proportions(t, "pitch_type", [ENT])
    return A.frequency_filter(props, "<", 0.03).select(ENT, "pitch_type", "proportion")


@register(
    "F8_drop_duplicates",
    S.q(
        [],
        "select player_name, game_pk, pitch_type, event_id, release_speed from pitches "
        "qualify row_number() over (partition by player_name, game_pk, pitch_type order by " + ORD + ") = 1",
    ),
)
def f8(spark, sf):
    df = pitches(spark, sf).select(ENT, GAME, "pitch_type", "event_id", "release_speed", *ORDER)
    out = FL.drop_duplicates(df, [ENT, GAME, "pitch_type"], keep_first_by=ORDER)
    return out.select(ENT, GAME, "pitch_type", "event_id", "release_speed")


# ---------------------------------------------------------------- 2.4 joins
@register("J1_top_k_rows", S.q([S.F, S.TOP, S.T], "select event_id, player_name from t"))
def j1(spark, sf):
    return FL.rows_of_top_k(_f(spark, sf), ENT, "pitch_type", 2).select("event_id", ENT)


@register(
    "J2a_strict_literal_map",
    S.q(
        [],
        "select event_id, case stand when 'R' then 0 when 'L' then 1 end as stand, "
        "case p_throws when 'R' then 0 when 'L' then 1 end as p_throws from pitches",
    ),
)
def j2a(spark, sf):
    df = pitches(spark, sf)
    return df.select("event_id", X.strict_map("stand", HAND_CODES, "stand").alias("stand"), X.strict_map("p_throws", HAND_CODES, "p_throws").alias("p_throws"))


@register("J2b_strict_data_map", S.q(S.CLEAN, "select event_id, player_name, pitch_type, pitch_type_code from c"))
def j2b(spark, sf):
    c, m = _coded(spark, sf)
    base = c.drop("pitch_type_code")
    mp = m.select(ENT, F.col("name").alias("pitch_type"), "pitch_type_code")
    out = J.strict_lookup(base, mp, [ENT, "pitch_type"], "pitch_type_code", "pitch_type_code", "pitch_type")
    return out.select("event_id", ENT, "pitch_type", "pitch_type_code")


@register(
    "J3_inverse_lookup",
    S.q(
        S.CLEAN + [S.CLS, S.MAPPING],
        "select k.player_name, k.code, coalesce(mp.name, 'Unknown-' || cast(k.code as varchar)) as name "
        "from (select player_name, cast(unnest(range(n_classes + 1)) as integer) as code from cls) k "
        "left join mp on mp.player_name = k.player_name and mp.pitch_type_code = k.code",
    ),
)
def j3(spark, sf):
    _, m = _coded(spark, sf)
    cls = classes_of(m)
    codes = cls.select(ENT, F.explode(F.sequence(F.lit(0), F.col("n_classes"))).alias("code"))
    mp = m.select(ENT, F.col("pitch_type_code").alias("code"), "name")
    return J.inverse_lookup(codes, mp, [ENT, "code"], "name", "name", "code").select(ENT, "code", "name")


@register("J4_rows_of_split", S.q(S.SPLIT, "select event_id, player_name, game_pk, split from sr where split = 'val'"))
def j4(spark, sf):
    t, _ = _target(spark, sf)
    splits = Q.game_split_table(t, GAME, ORDER, [ENT], strategy="halo")
    return Q.rows_with_split(t, splits, GAME, [ENT], only="val").select("event_id", ENT, GAME, "split")


# ---------------------------------------------------------------- 2.5 aggregations
@register("A1_count_non_null", S.q([], "select player_name, count(pitch_type) as count from pitches group by player_name"))
def a1(spark, sf):
    return A.count_non_null_by(pitches(spark, sf), ENT, "pitch_type")


@register(
    "A2_top_k_groups",
    S.q([S.F], "select player_name, count(pitch_type) as count from f group by player_name order by count desc, player_name limit 2"),
)
def a2(spark, sf):
    return FL.top_k_keys(_f(spark, sf), ENT, "pitch_type", 2)


@register("A3_value_counts", S.q([], "select pitch_type, count(*) as count from pitches group by pitch_type"))
def a3(spark, sf):
    return A.value_counts(pitches(spark, sf), "pitch_type")


@register(
    "A4_normalized_counts_global",
    S.q(
        [],
        "select pitch_type, count(*) as count, cast(count(*) as double) / sum(count(*)) over () as proportion "
        "from pitches group by pitch_type",
    ),
)
def a4g(spark, sf):
    return A.value_proportions(pitches(spark, sf), "pitch_type")


@register(
    "A4_normalized_counts_per_entity",
    S.q(
        [],
        "select player_name, pitch_type, count(*) as count, "
        "cast(count(*) as double) / sum(count(*)) over (partition by player_name) as proportion "
        "from pitches group by player_name, pitch_type",
    ),
)
def a4e(spark, sf):
    return A.value_proportions(pitches(spark, sf), "pitch_type", [ENT])


@register("A5_scalar_max", "select max(cast(year(l_shipdate) as integer)) as max_year from lineitem")
def a5(spark, sf):
    li = io.read_table(spark, sf, "lineitem", ["l_shipdate"])
    return A.scalar_max(li, X.year_of("l_shipdate"), "max_year")


NU_COLS = ["pitch_type", "type", "hit_location", "inning", "spin_axis"]


@register(
    "A6_n_unique",
    S.q(
        [],
        "select "
        + ", ".join(
            f"cast(count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as bigint) as n_unique_{c}" for c in NU_COLS
        )
        + " from pitches",
    ),
)
def a6(spark, sf):
    return A.n_unique(pitches(spark, sf), NU_COLS)


NC_COLS = ["pitch_type", "release_speed", "release_spin_rate", "effective_speed", "spin_axis", "type", "hit_location", "on_1b", "on_2b", "on_3b"]


@register(
    "A7_null_counts",
    S.q(
        [],
        " union all ".join(
            f"select '{c}' as column, cast(count(*) - count({c}) as bigint) as null_count from pitches" for c in NC_COLS
        ),
    ),
)
def a7(spark, sf):
    return A.null_counts(pitches(spark, sf), NC_COLS)


DESC_COLS = ["release_speed", "release_spin_rate", "hit_location", "balls", "inning"]


def _describe_sql() -> str:
    parts = []
    for c in DESC_COLS:
        x = f"cast({c} as double)"
        parts.append(
            f"select '{c}' as column, count({x}) as count, cast(count(*) - count({x}) as bigint) as null_count, "
            f"round(avg({x}), 6) as mean, round(stddev_samp({x}), 6) as std, min({x}) as min, "
            f"round(quantile_cont({x}, 0.25), 6) as q25, round(quantile_cont({x}, 0.5), 6) as q50, "
            f"round(quantile_cont({x}, 0.75), 6) as q75, max({x}) as max from pitches"
        )
    return S.q([], " union all ".join(parts))


@register("A8_describe", _describe_sql())
def a8(spark, sf):
    d = A.describe(pitches(spark, sf), DESC_COLS)
    return d.withColumns({c: X.round6(c) for c in ("mean", "std", "q25", "q50", "q75")})


@register("A9_shape", S.q([], "select count(*) as n_rows, cast(23 as bigint) as n_cols from pitches"))
def a9(spark, sf):
    return A.shape(pitches(spark, sf))


@register("A10_sorted_distinct", S.q(S.CLEAN, "select distinct player_name, pitch_type from m"))
def a10(spark, sf):
    c, _ = _coded(spark, sf)
    return A.sorted_distinct(c, "pitch_type", [ENT])


CLASS_DIST_SQL = S.q(
    S.MODEL + [S.TEST],
    "select clsl.player_name, cast(clsl.i as integer) as class, count(te.y) as n from clsl "
    "left join te on te.player_name = clsl.player_name and te.y = clsl.i group by clsl.player_name, clsl.i",
)


@register("A11_class_distribution", CLASS_DIST_SQL)
def a11(spark, sf):
    te, m = _test(spark, sf, reused=False)
    return EV.class_distribution(te, classes_of(m), [ENT])


SUMMARY_SQL = S.q(
    S.MODEL + [S.TEST],
    "select round(avg(accuracy), 6) as avg_accuracy, round(avg(top2_accuracy), 6) as avg_top2_accuracy, count(*) as total_players from ("
    "select player_name, avg(case when y = pred then 1.0 else 0.0 end) as accuracy, "
    "avg(case when list_contains([x.i for x in list_slice(list_reverse(list_sort(list_transform(p, lambda v, i: {'v': v, 'i': i - 1}))), 1, 2)], y) then 1.0 else 0.0 end) as top2_accuracy "
    "from te group by player_name) e",
)


def _summary(spark, sf):
    te, m = _test(spark, sf, reused=False)
    met = EV.entity_metrics(te, classes_of(m), m.withColumnRenamed("pitch_type_code", "code"), [ENT])
    s = EV.summary(met)
    return s.select(X.round6("avg_accuracy").alias("avg_accuracy"), X.round6("avg_top2_accuracy").alias("avg_top2_accuracy"), "total_players")


register("A12_mean_over_entities", SUMMARY_SQL)(_summary)


WEIGHTS_SQL = S.q(
    S.SPLIT,
    "select player_name, next_pitch_type_code, n_c, "
    "cast(sum(n_c) over (partition by player_name) as double) / (count(*) over (partition by player_name) * n_c) as weight "
    "from (select player_name, next_pitch_type_code, count(*) as n_c from sr where split = 'train' group by all) x",
)


@register("A13_class_weights", WEIGHTS_SQL)
def a13(spark, sf):
    s, _ = _split(spark, sf)
    return A.balanced_class_weights(s.filter(F.col("split") == "train"), "next_pitch_type_code", [ENT])


@register("A14_group_median", S.q([], "select pitch_type, median(release_spin_rate) as median_spin from pitches group by pitch_type"))
def a14(spark, sf):
    return A.group_median(pitches(spark, sf), ["pitch_type"], "release_spin_rate", "median_spin")


SCALE_COLS = ["release_speed", "release_spin_rate", "effective_speed"]


def _nan_null(c):
    return f"case when isnan({c}) then null else {c} end"


@register(
    "A15_scaler_stats",
    S.q(
        [],
        "select "
        + ", ".join(
            f"min({_nan_null(c)}) as {c}__min, max({_nan_null(c)}) as {c}__max, "
            f"round(avg({_nan_null(c)}), 6) as {c}__mean, round(stddev_pop({_nan_null(c)}), 6) as {c}__std"
            for c in SCALE_COLS
        )
        + " from pitches",
    ),
)
def a15(spark, sf):
    st = A.scaler_stats(pitches(spark, sf), SCALE_COLS)
    return st.withColumns({f"{c}__{s}": X.round6(f"{c}__{s}") for c in SCALE_COLS for s in ("mean", "std")})


# ---------------------------------------------------------------- 2.6 windows
@register(
    "W1_lead_global",
    S.q([S.F], "select event_id, pitch_type, lead(pitch_type) over (order by " + ORD + ") as next_pitch_type from f"),
)
def w1(spark, sf):
    rows = _f(spark, sf).select("event_id", "pitch_type", *ORDER)
    out = W.lead(rows, "pitch_type", "next_pitch_type", ORDER)
    return out.select("event_id", "pitch_type", "next_pitch_type")


@register(
    "W2_lead_in_partition",
    S.q(
        S.CLEAN,
        "select event_id, pitch_type_code, lead(pitch_type_code) over (partition by player_name, game_pk order by "
        + ORD
        + ") as next_pitch_type_code from c",
    ),
)
def w2(spark, sf):
    c, _ = _coded(spark, sf)
    out = W.lead(c, "pitch_type_code", "next_pitch_type_code", ORDER, [ENT, GAME])
    return out.select("event_id", "pitch_type_code", "next_pitch_type_code")


ROLL_COLS = ["release_speed", "release_spin_rate", "effective_speed"]


def _roll_sql(src: str, partition: str) -> str:
    over = f"over (partition by {partition} order by {ORD} rows between 4 preceding and current row)" if partition else f"over (order by {ORD} rows between 4 preceding and current row)"
    return "select event_id, " + ", ".join(f"round(avg({c}) {over}, 6) as {c}_rolling_mean" for c in ROLL_COLS) + f" from {src}"


@register("W3_rolling_mean", S.q(S.CLEAN, _roll_sql("c", "player_name, game_pk")))
def w3(spark, sf):
    c, _ = _coded(spark, sf)
    out = W.rolling_mean(c, ROLL_COLS, 5, ORDER, [ENT, GAME])
    return out.select("event_id", *[X.round6(f"{x}_rolling_mean").alias(f"{x}_rolling_mean") for x in ROLL_COLS])


@register("W3b_rolling_mean_global", S.q([S.F], _roll_sql("f", "")))
def w3b(spark, sf):
    rows = _f(spark, sf).select("event_id", *ROLL_COLS, *ORDER)
    out = W.rolling_mean(rows, ROLL_COLS, 5, ORDER)
    return out.select("event_id", *[X.round6(f"{x}_rolling_mean").alias(f"{x}_rolling_mean") for x in ROLL_COLS])


FILL_PART_SQL = (
    "fp as (select event_id, " + ORD + ", type, cast(balls as varchar) || '-' || cast(strikes as varchar) as balls_strikes, "
    "case when on_1b is null then 0 else 1 end as on_1b, case when on_2b is null then 0 else 1 end as on_2b, "
    "case when on_3b is null then 0 else 1 end as on_3b from pitches)"
)
FILL_KEYS = ["balls_strikes", "on_3b", "on_2b", "on_1b"]


def _fill_input(spark, sf):
    df = pitches(spark, sf)
    return df.select(
        "event_id",
        *ORDER,
        "type",
        X.concat_text("balls", "strikes", sep="-").alias("balls_strikes"),
        X.flag_not_null("on_1b").alias("on_1b"),
        X.flag_not_null("on_2b").alias("on_2b"),
        X.flag_not_null("on_3b").alias("on_3b"),
    )


@register(
    "W4_fill_backward",
    S.q(
        [FILL_PART_SQL],
        "select event_id, type, first(type ignore nulls) over (partition by balls_strikes, on_3b, on_2b, on_1b order by "
        + ORD
        + " rows between current row and unbounded following) as last_pitch_result from fp",
    ),
)
def w4(spark, sf):
    out = W.fill_backward(_fill_input(spark, sf), "type", "last_pitch_result", ORDER, FILL_KEYS)
    return out.select("event_id", "type", "last_pitch_result")


@register(
    "W4b_last_value_before",
    S.q(
        [FILL_PART_SQL],
        "select event_id, type, last(type ignore nulls) over (partition by balls_strikes, on_3b, on_2b, on_1b order by "
        + ORD
        + " rows between unbounded preceding and 1 preceding) as prev_pitch_result from fp",
    ),
)
def w4b(spark, sf):
    out = W.last_value_before(_fill_input(spark, sf), "type", "prev_pitch_result", ORDER, FILL_KEYS)
    return out.select("event_id", "type", "prev_pitch_result")


@register(
    "W5_group_stat_to_rows",
    S.q([], "select event_id, pitch_type, median(release_spin_rate) over (partition by pitch_type) as median_spin from pitches"),
)
def w5(spark, sf):
    out = W.group_stat_to_rows(pitches(spark, sf), ["pitch_type"], "release_spin_rate", "median_spin")
    return out.select("event_id", "pitch_type", "median_spin")


@register("W6_sorted_code", S.q(S.CLEAN, "select event_id, player_name, pitch_type, pitch_type_code from c"))
def w6(spark, sf):
    c, _ = _coded(spark, sf)
    out = E.sorted_code(c.drop("pitch_type_code"), "pitch_type", "pitch_type_code", [ENT])
    return out.select("event_id", ENT, "pitch_type", "pitch_type_code")


FIRST_SEEN_SQL = S.q(
    [],
    "select p.event_id, p.type, k.code as type_code from pitches p left join ("
    "select type, cast(row_number() over (order by fd, fa, fp) - 1 as integer) as code from ("
    "select type, game_date as fd, at_bat_number as fa, pitch_number as fp from pitches where type is not null "
    "qualify row_number() over (partition by type order by " + ORD + ") = 1) x) k on p.type = k.type",
)


@register("W7_first_seen_code", FIRST_SEEN_SQL)
def w7(spark, sf):
    out = E.first_seen_code(pitches(spark, sf), "type", ORDER, "type_code")
    return out.select("event_id", "type", "type_code")


# ---------------------------------------------------------------- 2.7 sorts
@register("O1_multi_key_sort", S.q([], "select event_id, game_date, at_bat_number, pitch_number from pitches order by " + ORD))
def o1(spark, sf):
    return pitches(spark, sf).select("event_id", *ORDER).orderBy(*ORDER)


@register(
    "O2_descending_sort",
    S.q([], "select pitch_type, count(*) as count from pitches group by pitch_type order by count desc, pitch_type nulls first"),
)
def o2(spark, sf):
    vc = pitches(spark, sf).groupBy("pitch_type").agg(F.count(F.lit(1)).alias("count"))
    return vc.orderBy(F.col("count").desc_nulls_first(), F.col("pitch_type").asc_nulls_first())


@register(
    "O3_head_k",
    S.q([], "select event_id, release_speed from pitches order by release_speed desc nulls first, event_id limit 25"),
)
def o3(spark, sf):
    df = pitches(spark, sf).select("event_id", "release_speed")
    return df.orderBy(F.col("release_speed").desc_nulls_first(), "event_id").limit(25)


TOP2_SQL = "[x.i for x in list_slice(list_reverse(list_sort(list_transform(p, lambda v, i: {'v': v, 'i': i - 1}))), 1, 2)]"


@register(
    "O4_top2_classes",
    S.q(S.MODEL, f"select player_name, game_pk, pitch_number, cast({TOP2_SQL} as integer[]) as top2 from scored"),
)
def o4(spark, sf):
    sc, _ = _scored(spark, sf, reused=False)
    return sc.select(ENT, GAME, "pitch_number", X.top_k_indices("p", 2).alias("top2"))


@register("O5_argmax", S.q(S.MODEL, "select player_name, game_pk, pitch_number, pred from scored"))
def o5(spark, sf):
    sc, _ = _scored(spark, sf, reused=False)
    return sc.select(ENT, GAME, "pitch_number", X.argmax("p").alias("pred"))


# ---------------------------------------------------------------- 2.8 set operations
@register(
    "U1_union_all",
    S.q(S.SPLIT, " union all ".join(f"select event_id, split from sr where split = '{k}'" for k in Q.SPLITS)),
)
def u1(spark, sf):
    """Every split, put back together; the split rows are written once."""
    s, _ = _split(spark, sf)
    s = materialize(s.select("event_id", "split"), "split")
    parts = [s.filter(F.col("split") == k) for k in Q.SPLITS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(
    "U2_union_distinct_labels",
    S.q(S.SPLIT, "select distinct player_name, next_pitch_type_code as label from sr"),
)
def u2(spark, sf):
    s, _ = _split(spark, sf)
    s = materialize(s.select(ENT, "split", F.col("next_pitch_type_code").alias("label")), "split")
    parts = [s.filter(F.col("split") == k).select(ENT, "label") for k in Q.SPLITS]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


# ---------------------------------------------------------------- 2.9 scalar functions
@register(
    "X1_fill_null_literal",
    S.q(
        [],
        "select event_id, coalesce(hit_location, 0) as hit_location, coalesce(release_spin_rate, -1.0) as release_spin_rate, "
        "coalesce(type, 'N/A') as type, coalesce(spin_axis, '') as spin_axis from pitches",
    ),
)
def x1(spark, sf):
    df = pitches(spark, sf)
    return df.select(
        "event_id",
        X.fill_null("hit_location", 0).alias("hit_location"),
        X.fill_null("release_spin_rate", -1.0).alias("release_spin_rate"),
        X.fill_null("type", "N/A").alias("type"),
        X.fill_null("spin_axis", "").alias("spin_axis"),
    )


X2_NUMERIC = ["event_id", "pitcher", "game_pk", "at_bat_number", "pitch_number", "release_speed", "release_spin_rate", "effective_speed", "hit_location", "balls", "strikes", "outs_when_up", "inning", "on_1b", "on_2b", "on_3b"]


@register(
    "X2_fill_null_frame",
    S.q(
        [],
        "select "
        + ", ".join(
            f"coalesce({c}, -1) as {c}" if c not in ("release_speed", "release_spin_rate", "effective_speed") else f"coalesce({c}, -1.0) as {c}"
            for c in X2_NUMERIC
        )
        + ", pitch_type from pitches",
    ),
)
def x2(spark, sf):
    out = P.fill_null_numeric(pitches(spark, sf), -1)
    return out.select(*X2_NUMERIC, "pitch_type")


@register(
    "X3_fill_nan",
    S.q([], "select event_id, case when isnan(effective_speed) then -1.0 else effective_speed end as effective_speed, release_speed from pitches"),
)
def x3(spark, sf):
    out = P.fill_nan_float(pitches(spark, sf), -1.0)
    return out.select("event_id", "effective_speed", "release_speed")


@register("X4_parse_date", S.q([], "select event_id, cast(strptime(game_date, '%Y-%m-%d') as date) as game_date from pitches"))
def x4(spark, sf):
    return pitches(spark, sf).select("event_id", X.parse_date("game_date").alias("game_date"))


@register(
    "X5_year",
    S.q([], "select event_id, cast(year(cast(strptime(game_date, '%Y-%m-%d') as date)) as integer) as year from pitches"),
)
def x5(spark, sf):
    return pitches(spark, sf).select("event_id", X.year_of(X.parse_date("game_date")).alias("year"))


@register(
    "X6_concat",
    S.q([], "select event_id, cast(balls as varchar) || '-' || cast(strikes as varchar) as balls_strikes, 'P-' || cast(pitcher as varchar) as tag from pitches"),
)
def x6(spark, sf):
    df = pitches(spark, sf)
    return df.select("event_id", X.concat_text("balls", "strikes", sep="-").alias("balls_strikes"), X.concat_text(F.lit("P"), "pitcher", sep="-").alias("tag"))


@register(
    "X7_arithmetic",
    S.q(
        [],
        "select event_id, balls + 2 * strikes as weighted, outs_when_up * 3 + inning as outs_idx, "
        "balls > strikes as ahead, release_speed * 10 - release_spin_rate as diff from pitches",
    ),
)
def x7(spark, sf):
    df = pitches(spark, sf)
    return df.select(
        "event_id",
        (F.col("balls") + 2 * F.col("strikes")).alias("weighted"),
        (F.col("outs_when_up") * 3 + F.col("inning")).alias("outs_idx"),
        (F.col("balls") > F.col("strikes")).alias("ahead"),
        (F.col("release_speed") * 10 - F.col("release_spin_rate")).alias("diff"),
    )


@register(
    "X8_clip_log_pow",
    S.q(
        [S.F, S.TOP, S.T, S.PE],
        "select player_name, pitch_type, round(ln(least(greatest(proportion, 1e-7), 1 - 1e-7)), 6) as log_p, "
        "round(pow(1 - least(greatest(proportion, 1e-7), 1 - 1e-7), 2.0), 6) as focal_w from pe",
    ),
)
def x8(spark, sf):
    t = FL.rows_of_top_k(_f(spark, sf), ENT, "pitch_type", 2)
    props = A.value_proportions(t, "pitch_type", [ENT])
    pc = X.clip("proportion", L.EPSILON, 1 - L.EPSILON)
    return props.select(ENT, "pitch_type", X.round6(F.log(pc)).alias("log_p"), X.round6(F.pow(F.lit(1.0) - pc, F.lit(2.0))).alias("focal_w"))


# ---------------------------------------------------------------- 2.10 feature operators
@register(
    "M1_flag_two_step",
    S.q([], "select event_id, " + ", ".join(f"case when coalesce({c}, 0) = 0 then 0 else 1 end as {c}" for c in ("on_1b", "on_2b", "on_3b")) + " from pitches"),
)
def m1(spark, sf):
    df = pitches(spark, sf)
    return df.select("event_id", *[X.flag_nonzero(c).alias(c) for c in ("on_1b", "on_2b", "on_3b")])


@register(
    "M2_flag_not_null",
    S.q([], "select event_id, " + ", ".join(f"case when {c} is null then 0 else 1 end as {c}" for c in ("on_1b", "on_2b", "on_3b")) + " from pitches"),
)
def m2(spark, sf):
    df = pitches(spark, sf)
    return df.select("event_id", *[X.flag_not_null(c).alias(c) for c in ("on_1b", "on_2b", "on_3b")])


M3_SQL = S.q(
    [],
    "select event_id, f1 + 2 * f2 + 3 * f3 as baserunner_state, f1 + 2 * f2 + 4 * f3 as baserunner_state_unique from ("
    "select event_id, case when on_1b is null then 0 else 1 end as f1, case when on_2b is null then 0 else 1 end as f2, "
    "case when on_3b is null then 0 else 1 end as f3 from pitches) x",
)


@register("M3_weighted_state", M3_SQL)
def m3(spark, sf):
    df = pitches(spark, sf).select("event_id", *[X.flag_not_null(c).alias(c) for c in ("on_1b", "on_2b", "on_3b")])
    flags = ["on_1b", "on_2b", "on_3b"]
    return df.select(
        "event_id",
        X.weighted_sum(flags, (1, 2, 3)).alias("baserunner_state"),
        X.weighted_sum(flags, (1, 2, 4)).alias("baserunner_state_unique"),
    )


M4_SQL = S.q(
    [
        "bs as (select event_id, " + ORD + ", cast(balls as varchar) || '-' || cast(strikes as varchar) as b from pitches)",
        "k as (select b, cast(row_number() over (order by game_date, at_bat_number, pitch_number) - 1 as integer) as code from ("
        "select b, " + ORD + " from bs qualify row_number() over (partition by b order by " + ORD + ") = 1) x)",
    ],
    "select bs.event_id, k.code as balls_strikes from bs join k on bs.b = k.b",
)


@register("M4_composite_category", M4_SQL)
def m4(spark, sf):
    df = pitches(spark, sf).select("event_id", *ORDER, "balls", "strikes")
    return E.composite_category(df, ["balls", "strikes"], "balls_strikes", ORDER).select("event_id", "balls_strikes")


@register("M5_rare_merge_per_entity", S.q(S.CLEAN, "select event_id, player_name, pitch_type from m"))
def m5a(spark, sf):
    t = FL.rows_of_top_k(_f(spark, sf), ENT, "pitch_type", 2)
    return E.merge_rare(t, "pitch_type", 0.03, "<", by=[ENT]).select("event_id", ENT, "pitch_type")


@register(
    "M5_rare_merge_global",
    S.q(
        [
            S.F,
            "pg as (select pitch_type, cast(count(*) as double) / sum(count(*)) over () as proportion from f group by pitch_type)",
        ],
        "select f.event_id, case when pg.proportion < 0.05 then 'other' else f.pitch_type end as pitch_type "
        "from f join pg on f.pitch_type = pg.pitch_type",
    ),
)
def m5b(spark, sf):
    return E.merge_rare(_f(spark, sf), "pitch_type", 0.05, "<").select("event_id", "pitch_type")


@register(
    "M5_keep_frequent_global",
    S.q(
        [
            "pn as (select * from pitches where pitch_type is not null)",
            "pg as (select pitch_type, cast(count(*) as double) / sum(count(*)) over () as proportion from pn group by pitch_type)",
        ],
        "select pn.event_id, case when pg.proportion > 0.01 then pn.pitch_type else 'other' end as pitch_type "
        "from pn join pg on pn.pitch_type = pg.pitch_type",
    ),
)
def m5c(spark, sf):
    df = FL.drop_nulls(pitches(spark, sf), ["pitch_type"])
    return E.merge_rare(df, "pitch_type", 0.01, ">").select("event_id", "pitch_type")


@register("M6_code_per_entity", S.q(S.CLEAN, "select event_id, player_name, pitch_type_code from c"))
def m6(spark, sf):
    c, _ = _coded(spark, sf)
    return c.select("event_id", ENT, "pitch_type_code")


@register("M6_code_mapping", S.q(S.CLEAN + [S.MAPPING], "select player_name, pitch_type_code, name from mp"))
def m6m(spark, sf):
    _, m = _coded(spark, sf)
    return m


@register(
    "M7_label_code_global",
    S.q(
        [
            "pn as (select * from pitches where pitch_type is not null)",
            "k as (select pitch_type, cast(dense_rank() over (order by pitch_type) - 1 as integer) as label from (select distinct pitch_type from pn) d)",
        ],
        "select pn.event_id, k.label from pn join k on pn.pitch_type = k.pitch_type",
    ),
)
def m7(spark, sf):
    df = FL.drop_nulls(pitches(spark, sf), ["pitch_type"])
    return E.sorted_code(df, "pitch_type", "label").select("event_id", "label")


@register(
    "M8_first_seen_code",
    S.q(
        [
            "k as (select stand, cast(row_number() over (order by game_date, at_bat_number, pitch_number) - 1 as integer) as code from ("
            "select stand, " + ORD + " from pitches qualify row_number() over (partition by stand order by " + ORD + ") = 1) x)"
        ],
        "select p.event_id, k.code as stand from pitches p join k on p.stand = k.stand",
    ),
)
def m8(spark, sf):
    return E.first_seen_code(pitches(spark, sf), "stand", ORDER, "stand_code").select("event_id", F.col("stand_code").alias("stand"))


@register(
    "M9_dense_remap",
    S.q(
        S.SPLIT,
        "select player_name, next_pitch_type_code as label, "
        "cast(dense_rank() over (partition by player_name order by next_pitch_type_code) - 1 as integer) as remapped "
        "from (select distinct player_name, next_pitch_type_code from sr) d",
    ),
)
def m9(spark, sf):
    s, _ = _split(spark, sf)
    labels = s.select(ENT, F.col("next_pitch_type_code").alias("label"))
    return E.dense_remap(labels, "label", [ENT], "remapped")


@register(
    "M10_one_hot",
    S.q(
        S.SPLIT + [S.CLS],
        "select sr.event_id, list_transform(range(cls.n_classes), lambda i: case when i = sr.next_pitch_type_code then 1 else 0 end) as y_one_hot "
        "from sr join cls on sr.player_name = cls.player_name",
    ),
)
def m10(spark, sf):
    s, m = _split(spark, sf)
    j = s.join(classes_of(m), ENT)
    return E.one_hot_column(j, "next_pitch_type_code", F.col("n_classes"), "y_one_hot").select("event_id", "y_one_hot")


def _scale_sql(kind: str) -> str:
    cols = []
    for c in SCALE_COLS:
        x = _nan_null(c)
        if kind == "minmax":
            cols.append(
                f"round(({c} - (select min({x}) from pitches)) / (case when (select max({x}) - min({x}) from pitches) = 0 then 1.0 "
                f"else (select max({x}) - min({x}) from pitches) end), 6) as {c}"
            )
        else:
            cols.append(
                f"round(({c} - (select avg({x}) from sr0 where split = 'train')) / (case when (select stddev_pop({x}) from sr0 where split = 'train') = 0 then 1.0 "
                f"else (select stddev_pop({x}) from sr0 where split = 'train') end), 6) as {c}"
            )
    src = "pitches" if kind == "minmax" else "sr0"
    return "select event_id, " + ", ".join(cols) + f" from {src}"


@register("M11_min_max_scale", S.q([], _scale_sql("minmax")))
def m11(spark, sf):
    out = W.min_max_scale(pitches(spark, sf), SCALE_COLS)
    return out.select("event_id", *[X.round6(c).alias(c) for c in SCALE_COLS])


SR0 = "sr0 as (select * from sr)"


@register("M12_standard_scale", S.q(S.SPLIT + [SR0], _scale_sql("standard")))
def m12(spark, sf):
    s, _ = _split(spark, sf, keep=SCALE_COLS)
    rows = materialize(s.select("event_id", "split", *SCALE_COLS), "split")  # read by the fit and the scaling
    out = W.standard_scale(rows, SCALE_COLS, fit_on=F.col("split") == "train")
    return out.select("event_id", *[X.round6(c).alias(c) for c in SCALE_COLS])


M14_SQL = S.q(
    [],
    "select event_id, coalesce(hit_location, -1) as hit_location, coalesce(on_1b, -1) as on_1b, "
    "coalesce(release_spin_rate, -1.0) as release_spin_rate, coalesce(effective_speed, -1.0) as effective_speed, "
    "coalesce(type, 'N/A') as type from pitches",
)


@register("M14_sentinel_fill", M14_SQL)
def m14(spark, sf):
    out = P.fill_sentinels(
        pitches(spark, sf), [(-1, ["hit_location", "on_1b"]), (-1.0, ["release_spin_rate", "effective_speed"]), ("N/A", ["type"])]
    )
    return out.select("event_id", "hit_location", "on_1b", "release_spin_rate", "effective_speed", "type")


@register(
    "M15_group_median_impute",
    S.q(
        [],
        "select event_id, coalesce(release_spin_rate, median(release_spin_rate) over (partition by pitch_type)) as release_spin_rate, "
        "coalesce(release_speed, median(release_speed) over (partition by pitch_type)) as release_speed from pitches",
    ),
)
def m15(spark, sf):
    out = W.impute_group_median(pitches(spark, sf), ["pitch_type"], ["release_spin_rate", "release_speed"])
    return out.select("event_id", "release_spin_rate", "release_speed")


M16_COLS = ["release_speed", "release_spin_rate", "effective_speed", "hit_location", "balls", "strikes", "inning", "outs_when_up"]


@register(
    "M16_rolling_feature_set",
    S.q(
        S.CLEAN,
        "select event_id, "
        + ", ".join(
            f"round(avg({c}) over (partition by player_name, game_pk order by {ORD} rows between 4 preceding and current row), 6) as {c}_rolling_mean"
            for c in M16_COLS
        )
        + " from c",
    ),
)
def m16(spark, sf):
    c, _ = _coded(spark, sf)
    out = W.rolling_mean(c, M16_COLS, 5, ORDER, [ENT, GAME])
    return out.select("event_id", *[X.round6(f"{x}_rolling_mean").alias(f"{x}_rolling_mean") for x in M16_COLS])


# ---------------------------------------------------------------- 2.11 sequences and splits
@register(
    "Q1_windows_global",
    S.q(
        S.TARGET
        + [
            "gw as (select event_id, list(cast(pitch_type_code as double)) over w as codes, count(*) over w as n_rows, "
            "lead(next_pitch_type_code, 1) over (order by " + ORD + ") as y from tgt "
            "window w as (order by " + ORD + " rows between 9 preceding and current row))"
        ],
        "select event_id, codes, y from gw where n_rows = 10 and y is not null",
    ),
)
def q1(spark, sf):
    t, _ = _target(spark, sf)
    t = t.select("event_id", *ORDER, "pitch_type_code", "next_pitch_type_code")
    w = Q.sliding_windows(
        t, ["pitch_type_code"], "next_pitch_type_code", SEQ_LEN, ORDER, label_offset=1, keep=["event_id"]
    )
    return w.select("event_id", F.transform("x", lambda s: s["pitch_type_code"].cast("double")).alias("codes"), "y")


@register(
    "Q2_windows_per_game",
    S.q(S.SPLIT + [WIN_SQL_BODY], "select player_name, game_pk, event_id, x_num, y from wv where n_rows = 10"),
)
def q2(spark, sf):
    w = Q.window_channels(_windows(spark, sf), SEQ_FEATURES, [])
    return w.select(ENT, GAME, "event_id", "x_num", "y")


Q3_CHANNELS = ["stand", "baserunner_state", "outs_when_up", "inning", "balls_strikes", "pitch_type_code"]


#: what encode_columns and the channels read
ENCODE_IN = ["stand", "p_throws", "spin_axis", "hit_location", "release_speed", "release_spin_rate", "effective_speed", "type", "balls", "strikes",
             "on_1b", "on_2b", "on_3b", "outs_when_up", "inning"]


def _encoded_split(spark, sf):
    """Cleaned rows with the encodings chained before the target and split.

    The cleaned table is written once (the clean stage's output): the two
    first-seen code maps and the row join then read it instead of scanning
    the events three times."""
    c, m = _coded(spark, sf)
    e = encode_columns(materialize(c.select(*dict.fromkeys([ENT, GAME, "event_id", *ORDER, *ENCODE_IN, "pitch_type_code"])), "clean"), ORDER)
    return split_by_game(with_target(e), strategy="halo"), m


Q3_SQL = S.q(
    S.SPLIT
    + [
        "pe0 as (select event_id, case stand when 'R' then 0 when 'L' then 1 end as stand_c, "
        "(case when on_1b is null then 0 else 1 end) + 2 * (case when on_2b is null then 0 else 1 end) + 3 * (case when on_3b is null then 0 else 1 end) as state_c, "
        "coalesce(release_spin_rate, -1.0) as spin_c, coalesce(effective_speed, -1.0) as eff_c, "
        "cast(balls as varchar) || '-' || cast(strikes as varchar) as b, " + ORD + " from c)",
        "bk as (select b, cast(row_number() over (order by game_date, at_bat_number, pitch_number) - 1 as integer) as code from ("
        "select b, " + ORD + " from pe0 qualify row_number() over (partition by b order by " + ORD + ") = 1) x)",
        "e3 as (select sr.*, pe0.stand_c, pe0.state_c, pe0.spin_c, pe0.eff_c, bk.code as bs_c from sr join pe0 on sr.event_id = pe0.event_id join bk on pe0.b = bk.b)",
        "w3 as (select event_id, list([release_speed, spin_c, eff_c]) over w as x_num, list(stand_c) over w as x_stand, "
        "list(state_c) over w as x_baserunner_state, list(outs_when_up) over w as x_outs_when_up, list(inning) over w as x_inning, "
        "list(bs_c) over w as x_balls_strikes, list(pitch_type_code) over w as x_pitch_type_code, count(*) over w as n_rows, "
        "next_pitch_type_code as y from e3 "
        "window w as (partition by player_name, game_pk order by " + ORD + " rows between 9 preceding and current row))",
    ],
    "select event_id, x_num, x_stand, x_baserunner_state, x_outs_when_up, x_inning, x_balls_strikes, x_pitch_type_code, y from w3 where n_rows = 10",
)


@register("Q3_multichannel_windows", Q3_SQL)
def q3(spark, sf):
    e, _ = _encoded_split(spark, sf)
    num = ["release_speed", "release_spin_rate", "effective_speed"]
    w = Q.sliding_windows(
        e, num + Q3_CHANNELS, "next_pitch_type_code", SEQ_LEN, ORDER, [ENT, GAME], keep=["event_id"]
    )
    out = Q.window_channels(w, num, Q3_CHANNELS)
    return out.select("event_id", "x_num", *[f"x_{c}" for c in Q3_CHANNELS], "y")


@register(
    "Q4_window_labels",
    S.q(
        S.SPLIT,
        "select event_id, y from (select event_id, lead(pitch_type_code, 10) over (partition by player_name, game_pk order by "
        + ORD
        + ") as y from sr where split = 'train') x where y is not null",
    ),
)
def q4(spark, sf):
    s, _ = _split(spark, sf)
    tr = s.filter(F.col("split") == "train")
    return Q.window_labels(tr, "pitch_type_code", SEQ_LEN, ORDER, [ENT, GAME]).select("event_id", "y")


@register(
    "Q5_chronological_split",
    S.q(
        S.TARGET
        + [
            "r5 as (select event_id, player_name, row_number() over (partition by player_name order by " + ORD + ") - 1 as rn, "
            "count(*) over (partition by player_name) as n from tgt)",
            "h5 as (select *, ceil(cast(0.3 as double) * n) as held from r5)",
        ],
        "select event_id, player_name, case when rn < n - held then 'train' when rn < n - held + (held - ceil(cast(0.5 as double) * held)) "
        "then 'val' else 'test' end as split from h5",
    ),
)
def q5(spark, sf):
    t, _ = _target(spark, sf)
    return Q.chronological_split(t.select("event_id", ENT, *ORDER), ORDER, [ENT]).select("event_id", ENT, "split")


@register("Q6_game_split", S.q(S.SPLIT, "select player_name, game_pk, split from gs"))
def q6(spark, sf):
    t, _ = _target(spark, sf)
    return Q.game_split_table(t, GAME, ORDER, [ENT], strategy="halo")


@register("Q7_seeded_shuffle", S.q(S.SPLIT, "select event_id, split from sr where split = 'train'"))
def q7(spark, sf):
    s, _ = _split(spark, sf)
    return Q.seeded_shuffle(s.filter(F.col("split") == "train").select("event_id", "split"), ["event_id"], seed=42)


@register(
    "Q8_flatten_windows",
    S.q(
        S.SPLIT + [WIN_SQL_BODY],
        "select event_id, cast(s.step - 1 as integer) as step, x_num[s.step][1] as release_speed, x_num[s.step][2] as release_spin_rate, "
        "x_num[s.step][3] as effective_speed, x_num[s.step][4] as pitch_type_code "
        "from (select * from wv where n_rows = 10) v, (select unnest(range(1, 11)) as step) s",
    ),
)
def q8(spark, sf):
    w = Q.window_channels(_windows(spark, sf), SEQ_FEATURES, [])
    return Q.flatten_windows(w, ["event_id"], "x_num", SEQ_FEATURES)


# ---------------------------------------------------------------- 2.12 models
@register(
    "L1_transition_model",
    S.q(S.MODEL, "select player_name, o as \"order\", ctx as context, total, n_classes, p from mdl"),
)
def l1(spark, sf):
    t, m = _target(spark, sf, context_k=2)  # contexts from the target's window node
    ctx = split_by_game(t, strategy="halo")
    classes = classes_of(m)
    counts = L.fit_transition_counts(ctx, [ENT], "next_pitch_type_code", 2, F.col("split") == "train")
    return L.transition_table(counts, classes, [ENT], 1.0)


@register("L2_logistic_regression")
def l2(spark, sf):
    data = _lr_inputs(spark, sf)
    scored = L.score_logistic(_lr_fit(data), data.filter(F.col("split") == "test"), "features")
    return scored.select(ENT, "event_id", F.col("y").cast("int").alias("y"), "p", "pred")


@register(
    "L3_sample_weights",
    S.q(
        S.SPLIT,
        "select sr.event_id, w.weight from sr left join ("
        "select player_name, next_pitch_type_code, cast(sum(n_c) over (partition by player_name) as double) / (count(*) over (partition by player_name) * n_c) as weight "
        "from (select player_name, next_pitch_type_code, count(*) as n_c from sr where split = 'train' group by all) x) w "
        "on sr.player_name = w.player_name and sr.next_pitch_type_code = w.next_pitch_type_code where sr.split = 'train'",
    ),
)
def l3(spark, sf):
    s, _ = _split(spark, sf)
    tr = s.filter(F.col("split") == "train")
    return L.sample_weights(tr, tr, "next_pitch_type_code", [ENT]).select("event_id", "weight")


@register(
    "L4_scored_table",
    S.q(S.MODEL, "select player_name, game_pk, pitch_number, split, y, list_transform(p, lambda v: round(v, 6)) as p, pred, order_used from scored"),
)
def l4(spark, sf):
    sc, _ = _scored(spark, sf, reused=False)
    return sc.select(ENT, GAME, "pitch_number", "split", "y", F.transform("p", lambda v: F.round(v, 6)).alias("p"), "pred", "order_used")


PY_SQL = "least(greatest(p[y + 1], 1e-7), 1 - 1e-7)"


@register(
    "L5_focal_loss",
    S.q(S.MODEL + [S.TEST], f"select player_name, round(avg(0.25 * pow(1 - {PY_SQL}, 2.0) * -ln({PY_SQL})), 6) as focal_loss from te group by player_name"),
)
def l5(spark, sf):
    te, _ = _test(spark, sf, reused=False)
    return L.focal_loss(te, [ENT]).select(ENT, X.round6("focal_loss").alias("focal_loss"))


@register(
    "L6_log_loss",
    S.q(S.MODEL + [S.TEST], f"select player_name, round(avg(-ln({PY_SQL})), 6) as log_loss from te group by player_name"),
)
def l6(spark, sf):
    te, _ = _test(spark, sf, reused=False)
    return L.log_loss(te, [ENT]).select(ENT, X.round6("log_loss").alias("log_loss"))


L7_CTES = [
    "v as (select cx.player_name, cls.n_classes, t0.total as t0, t1.total as t1, t2.total as t2, "
    "coalesce(c0.cnt, 0) as c0, coalesce(c1.cnt, 0) as c1, coalesce(c2.cnt, 0) as c2 from cx join cls on cls.player_name = cx.player_name "
    + " ".join(
        f"left join tot t{j} on t{j}.player_name = cx.player_name and t{j}.o = {j} and t{j}.ctx = cx.ctx_{j} "
        f"left join cnt c{j} on c{j}.player_name = cx.player_name and c{j}.o = {j} and c{j}.ctx = cx.ctx_{j} and c{j}.nxt = cx.next_pitch_type_code"
        for j in range(3)
    )
    + " where cx.split = 'val')",
    "gp as (select g.k, g.alpha, case when g.k >= 2 and t2 is not null then (c2 + g.alpha) / (t2 + g.alpha * n_classes) "
    "when t1 is not null then (c1 + g.alpha) / (t1 + g.alpha * n_classes) when t0 is not null then (c0 + g.alpha) / (t0 + g.alpha * n_classes) "
    "else cast(1.0 as double) / n_classes end as p from v, "
    "(select cast(k as integer) as k, cast(alpha as double) as alpha from (values (1, 0.5), (1, 1.0), (2, 0.5), (2, 1.0)) x(k, alpha)) g)",
    "gl as (select k, alpha, avg(-ln(least(greatest(p, 1e-7), 1 - 1e-7))) as loss from gp group by k, alpha)",
]


@register(
    "L7_grid_search",
    S.q(S.MODEL + L7_CTES, "select k, alpha, round(loss, 6) as val_log_loss, row_number() over (order by loss, k, alpha) = 1 as best from gl"),
)
def l7(spark, sf):
    from evseq.plans.tuning import grid_search_transitions

    t, m = _target(spark, sf, context_k=2)
    return grid_search_transitions(split_by_game(t), m, ks=(1, 2), alphas=(0.5, 1.0))


@register(
    "L8_cardinalities",
    S.q(
        [],
        "select 'pitch_type' as input, cast(count(distinct pitch_type) + max(case when pitch_type is null then 1 else 0 end) as bigint) as cardinality from pitches "
        "union all select 'stand', cast(count(distinct stand) as bigint) from pitches "
        "union all select 'inning', cast(count(distinct inning) + 1 as bigint) from pitches "
        "union all select 'outs_when_up', cast(count(distinct outs_when_up) as bigint) from pitches",
    ),
)
def l8(spark, sf):
    return L.cardinalities(pitches(spark, sf), ["pitch_type", "stand", "inning", "outs_when_up"], plus_one=["inning"])


# ---------------------------------------------------------------- 2.13 evaluation
@register(
    "E1_accuracy",
    S.q(S.MODEL + [S.TEST], "select player_name, round(avg(case when y = pred then 1.0 else 0.0 end), 6) as accuracy from te group by player_name"),
)
def e1(spark, sf):
    te, _ = _test(spark, sf, reused=False)
    return EV.accuracy(te, [ENT]).select(ENT, X.round6("accuracy").alias("accuracy"))


@register(
    "E2_top2_accuracy",
    S.q(
        S.MODEL + [S.TEST],
        f"select player_name, round(avg(case when list_contains({TOP2_SQL}, y) then 1.0 else 0.0 end), 6) as top2_accuracy from te group by player_name",
    ),
)
def e2(spark, sf):
    te, _ = _test(spark, sf, reused=False)
    return EV.top_k_accuracy(te, [ENT], 2).select(ENT, X.round6("top2_accuracy").alias("top2_accuracy"))


@register(
    "E3_confusion_matrix",
    S.q(
        S.MODEL + [S.TEST, "pairs as (select a.player_name, cast(a.i as integer) as true, cast(b.i as integer) as predicted from clsl a join clsl b on a.player_name = b.player_name)"],
        "select pairs.player_name, pairs.true, pairs.predicted, count(te.y) as n from pairs left join te "
        "on te.player_name = pairs.player_name and te.y = pairs.true and te.pred = pairs.predicted "
        "group by pairs.player_name, pairs.true, pairs.predicted",
    ),
)
def e3(spark, sf):
    te, m = _test(spark, sf, reused=False)
    return EV.confusion_matrix(te, classes_of(m), [ENT])


REPORT_CTE = (
    "rep as (select clsl.player_name, cast(clsl.i as integer) as class, "
    "count(case when te.y = te.pred then 1 end) as tp, count(te.y) as support, "
    "(select count(*) from {src} t2 where t2.player_name = clsl.player_name and t2.pred = clsl.i) as predicted "
    "from clsl left join {src} te on te.player_name = clsl.player_name and te.y = clsl.i group by clsl.player_name, clsl.i)"
)
PRF_CTE = (
    "prf as (select player_name, class, case when predicted = 0 then 0.0 else tp / predicted end as precision, "
    "case when support = 0 then 0.0 else tp / support end as recall, support from rep), "
    "pr as (select player_name, class, precision, recall, "
    "case when precision + recall = 0 then 0.0 else 2 * precision * recall / (precision + recall) end as f1, support from prf)"
)
REPORT_BODY = (
    "select pr.player_name, coalesce(mp.name, 'Unknown-' || cast(pr.class as varchar)) as label, round(precision, 6) as precision, "
    "round(recall, 6) as recall, round(f1, 6) as f1, support from pr left join mp "
    "on mp.player_name = pr.player_name and mp.pitch_type_code = pr.class "
    "union all select player_name, 'accuracy', cast(null as double), cast(null as double), "
    "round(avg(case when y = pred then 1.0 else 0.0 end), 6), count(*) from {src} group by player_name "
    "union all select player_name, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), "
    "round(avg(f1), 6), cast(sum(support) as bigint) from pr group by player_name "
    "union all select player_name, 'weighted avg', round(case when sum(support) = 0 then 0.0 else sum(precision * support) / sum(support) end, 6), "
    "round(case when sum(support) = 0 then 0.0 else sum(recall * support) / sum(support) end, 6), "
    "round(case when sum(support) = 0 then 0.0 else sum(f1 * support) / sum(support) end, 6), cast(sum(support) as bigint) from pr group by player_name"
)


def _full_report(scored, m):
    mp = m.withColumnRenamed("pitch_type_code", "code")
    r = EV.classification_report(scored, classes_of(m), mp, [ENT])
    return r.select(ENT, "label", *[X.round6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@register(
    "E4_classification_report",
    S.q(S.MODEL + [S.TEST, S.MAPPING, REPORT_CTE.format(src="te"), PRF_CTE], REPORT_BODY.format(src="te")),
)
def e4(spark, sf):
    te, m = _test(spark, sf, reused=False)
    return _full_report(te, m)


VAL = "va as (select * from scored where split = 'val')"


@register(
    "E5_validation_report",
    S.q(S.MODEL + [VAL, S.MAPPING, REPORT_CTE.format(src="va"), PRF_CTE], REPORT_BODY.format(src="va")),
)
def e5(spark, sf):
    sc, m = _scored(spark, sf, reused=False)
    return _full_report(sc.filter(F.col("split") == "val"), m)


@register(
    "E5_validation_macro_prf",
    S.q(
        S.MODEL + [VAL, S.MAPPING, REPORT_CTE.format(src="va"), PRF_CTE],
        "select * from (" + REPORT_BODY.format(src="va") + ") r where label in ('macro avg', 'weighted avg')",
    ),
)
def e5_avg(spark, sf):
    r = e5(spark, sf)
    return r.filter(F.col("label").isin("macro avg", "weighted avg"))


register("E6_class_distribution", CLASS_DIST_SQL)(a11)


@register(
    "E7_entity_metrics",
    S.q(
        S.MODEL + [S.TEST, S.MAPPING],
        "select a.player_name, a.accuracy, a.top2_accuracy, cls.n_classes as num_classes, d.class_names, d.class_counts from ("
        f"select player_name, round(avg(case when y = pred then 1.0 else 0.0 end), 6) as accuracy, "
        f"round(avg(case when list_contains({TOP2_SQL}, y) then 1.0 else 0.0 end), 6) as top2_accuracy from te group by player_name) a "
        "join cls on cls.player_name = a.player_name join ("
        "select clsl.player_name, list(coalesce(mp.name, 'Unknown-' || cast(clsl.i as varchar)) order by clsl.i) as class_names, list(coalesce(n, 0) order by clsl.i) as class_counts "
        "from clsl left join (select player_name, y, count(*) as n from te group by all) c on c.player_name = clsl.player_name and c.y = clsl.i "
        "left join mp on mp.player_name = clsl.player_name and mp.pitch_type_code = clsl.i "
        "group by clsl.player_name) d on d.player_name = a.player_name",
    ),
)
def e7(spark, sf):
    te, m = _test(spark, sf, reused=False)
    met = EV.entity_metrics(te, classes_of(m), m.withColumnRenamed("pitch_type_code", "code"), [ENT])
    return met.select(
        ENT,
        X.round6("accuracy").alias("accuracy"),
        X.round6("top2_accuracy").alias("top2_accuracy"),
        "num_classes",
        # the map's entries in class order; a collected map has no order of its own
        F.map_keys("class_distribution").alias("class_names"),
        F.map_values("class_distribution").alias("class_counts"),
    )


register("E7_summary", SUMMARY_SQL)(_summary)
