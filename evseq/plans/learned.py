"""Registered queries of the trained models (L1, L2, L5, L7, Q3, S8) and of what
feeds them (Q7, S4, S7).

Their windows come from the split table of the catalog; all are written once
and then read by every step.  SQL cannot say a gradient fit, so pytest holds the
pieces against finite differences, other fits and hand-made schedules.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evseq.functions import exprs as X
from evseq.operators import context_tree as CT
from evseq.operators import embeddings as V
from evseq.operators import encode as E
from evseq.operators import features as W
from evseq.operators import model as L
from evseq.operators import sequences as Q
from evseq.operators import training as T
from evseq.plans import catalog as C
from evseq.plans import sql as S
from evseq.plans.catalog import register
from evseq.plans.stages import SEQ_LEN, classes_of, split_by_game
from evseq.session import materialize, shared_dir
from evseq.sources import io, store

NUMERIC = ["release_speed", "release_spin_rate"]
N_BATCHES = 4  # gradient steps of an epoch
N_SLOTS = 16  # entities are hashed to so many vectors
MAX_EPOCHS, PATIENCE, RATE = 5, 2, 0.02


def training_windows(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """Windows as a recurrent model reads them, written by split and batch, and
    the number of classes (label names over all entities)."""
    s, m = C._split(spark, sf, keep=NUMERIC)
    names = materialize(E.sorted_code_map(m.select(F.col("name").alias("label_name")), "label_name", code="label"), "classes")
    n_classes = names.count()  # one row a class
    lookup = m.join(names, m["name"] == names["label_name"]).select(C.ENT, "pitch_type_code", "label")
    s = materialize(s.select(C.ENT, C.GAME, "event_id", *C.ORDER, "split", "pitch_type_code", "next_pitch_type_code", *NUMERIC), "split")
    s = W.standard_scale(s, NUMERIC, fit_on=F.col("split") == "train")
    own = lookup.withColumnRenamed("label", "class")
    coming = lookup.select(C.ENT, F.col("pitch_type_code").alias("next_pitch_type_code"), "label")
    s = s.join(own, [C.ENT, "pitch_type_code"], "left").join(coming, [C.ENT, "next_pitch_type_code"], "left")
    w = Q.sliding_windows(s, [*NUMERIC, "class"], "label", SEQ_LEN, C.ORDER, [C.ENT, C.GAME], keep=["event_id", "split"])
    w = Q.window_channels(w, NUMERIC, ["class"])
    out = w.select(
        C.ENT,
        "event_id",
        "split",
        F.flatten("x_num").alias("num"),
        F.col("x_class").alias("code"),
        F.pmod(F.xxhash64(C.ENT), F.lit(N_SLOTS)).cast("int").alias("slot"),
        "y",
    )
    out = T.with_batches(out, ["event_id"], N_BATCHES)
    return io.round_trip_parquet(spark, out, shared_dir(spark, "training"), partition_by=["split", "batch"]), n_classes


def _of(windows: DataFrame, split: str) -> DataFrame:
    return windows.filter(F.col("split") == split)


def _focal(n_classes: int) -> T.FocalSoftmax:
    return T.FocalSoftmax(SEQ_LEN * len(NUMERIC), n_classes, gamma=2.0, alpha=0.25, l2=1e-4)


def _recurrent(n_classes: int) -> T.GatedRecurrent:
    return T.GatedRecurrent(SEQ_LEN, len(NUMERIC), n_classes, N_SLOTS, n_classes, hidden=8, l2=1e-4)


def _focal_fit(windows: DataFrame, n_classes: int):
    """Focal loss with balanced class weights, as one weighted objective."""
    train = _of(windows, "train")
    weighted = L.sample_weights(train, train, "y", [], "w")
    return T.lbfgs(weighted, _focal(n_classes), max_rounds=20, tol=1e-4)


def _predictions(windows: DataFrame, objective: T.Objective, params) -> DataFrame:
    scored = T.score(_of(windows, "test"), objective, params, keep=[C.ENT, "event_id"])
    return scored.select(
        C.ENT, "event_id", "y", X.argmax("p").alias("pred"), F.round(L.prob_of_true(), 6).alias("p_true")
    )


@register("L5_focal_training")
def l5_training(spark: SparkSession, sf: str) -> DataFrame:
    """The loss and the largest gradient entry of each quasi-Newton round."""
    windows, n_classes = training_windows(spark, sf)
    _, history = _focal_fit(windows, n_classes)
    rows = [(h.round, h.loss, h.gradient_norm) for h in history]
    return spark.createDataFrame(rows, "round int, loss double, gradient_norm double")


@register("L5_focal_scores")
def l5_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Test windows under the model trained by focal loss."""
    windows, n_classes = training_windows(spark, sf)
    params, _ = _focal_fit(windows, n_classes)
    return _predictions(windows, _focal(n_classes), params)


def _epochs(spark: SparkSession, windows: DataFrame, n_classes: int, state_dir: str | None = None) -> T.Trial:
    trial = T.Trial.new(_recurrent(n_classes), RATE, seed=1)
    T.fit_epochs(
        _of(windows, "train"), _of(windows, "val"), [trial], MAX_EPOCHS, PATIENCE, N_BATCHES, state_dir, seed=1
    )
    return trial


@register("L2_recurrent_scores")
def l2_recurrent(spark: SparkSession, sf: str) -> DataFrame:
    """Test windows under the recurrent model of the best epoch."""
    windows, n_classes = training_windows(spark, sf)
    trial = _epochs(spark, windows, n_classes)
    return _predictions(windows, trial.objective, trial.best)


@register("S8_epoch_history")
def s8_epochs(spark: SparkSession, sf: str) -> DataFrame:
    """Loss and validation loss by epoch, read back from the state store."""
    windows, n_classes = training_windows(spark, sf)
    state = shared_dir(spark, "epochs")
    best = _epochs(spark, windows, n_classes, state).best_epoch
    back = spark.read.schema(T.STATE).parquet(state)
    return back.select("epoch", "loss", "val_loss", (F.col("epoch") == best).alias("best"))


@register("L7_successive_halving")
def l7_halving(spark: SparkSession, sf: str) -> DataFrame:
    """Brackets over state size, code vectors and learning rate of the recurrent model."""
    windows, n_classes = training_windows(spark, sf)
    base = _recurrent(n_classes)
    grid = [(replace(base, hidden=h, code_dim=d), rate) for rate in (0.05, 0.01) for h in (4, 8) for d in (2, 4)]
    _, rungs = T.successive_halving(_of(windows, "train"), _of(windows, "val"), grid, max_epochs=3, n_batches=N_BATCHES, seed=2)
    rows = [(r.bracket, r.rung, r.trial, r.epochs, r.val_loss, r.promoted) for r in rungs]
    return spark.createDataFrame(rows, "bracket int, rung int, trial int, epochs int, val_loss double, promoted boolean")


@register("Q3_code_vectors")
def q3_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """A learned vector for every label code, from co-occurrence in the games."""
    s, m = C._split(spark, sf)
    names = E.sorted_code_map(m.select(F.col("name").alias("label_name")), "label_name", code="label")
    lookup = materialize(m.join(names, m["name"] == names["label_name"]).select(C.ENT, "pitch_type_code", "label", "label_name"))
    coded = s.filter(F.col("split") == "train").join(lookup, [C.ENT, "pitch_type_code"])
    pairs = V.cooccurrence(coded.select(C.ENT, C.GAME, *C.ORDER, "label"), "label", C.ORDER, [C.ENT, C.GAME])
    codes, _ = V.factor(pairs, rank=4)
    labels = lookup.select(F.col("label").alias("code"), "label_name").distinct()
    return labels.join(codes, "code").select("label_name", "code", F.transform("vector", lambda x: F.round(x, 6)).alias("vector"))


# ---------------------------------------------------------------- context tree
MIN_GAIN, MIN_COUNT = 3.0, 5  # nats over the parent; training rows
TREE_CTES = [
    "n0 as (select player_name, ctx, cast(total as double) as total from tot where o = 0)",
    "q0 as (select cnt.player_name, nxt, (cnt + cast(1.0 as double) / n_classes) / (total + 1) as p from cnt "
    "join n0 on n0.player_name = cnt.player_name join cls on cls.player_name = cnt.player_name where o = 0)",
    "q1 as (select cnt.player_name, cnt.ctx, cnt.nxt, cnt.cnt, tot.total, (cnt.cnt + q0.p) / (tot.total + 1) as p, q0.p as above from cnt "
    "join tot on tot.player_name = cnt.player_name and tot.o = 1 and tot.ctx = cnt.ctx and tot.total >= 5 "
    "join q0 on q0.player_name = cnt.player_name and q0.nxt = cnt.nxt where cnt.o = 1)",
    "q2 as (select cnt.player_name, cnt.ctx, cnt.nxt, cnt.cnt, tot.total, (cnt.cnt + q1.p) / (tot.total + 1) as p, q1.p as above from cnt "
    "join tot on tot.player_name = cnt.player_name and tot.o = 2 and tot.ctx = cnt.ctx and tot.total >= 5 "
    "join q1 on q1.player_name = cnt.player_name and q1.nxt = cnt.nxt and q1.ctx = split_part(cnt.ctx, ',', 1) where cnt.o = 2)",
    "n2 as (select player_name, ctx, any_value(total) as total, sum(cnt * ln(p / above)) as gain from q2 group by player_name, ctx "
    "having sum(cnt * ln(p / above)) >= 3.0)",
    "n1 as (select player_name, ctx, any_value(total) as total, sum(cnt * ln(p / above)) as gain from q1 group by player_name, ctx "
    "having sum(cnt * ln(p / above)) >= 3.0 or (player_name, ctx) in (select (player_name, split_part(ctx, ',', 1)) from n2))",
]


def _tree(spark: SparkSession, sf: str, k: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    t, m = C._target(spark, sf, context_k=k)
    ctx = materialize(split_by_game(t).select(C.ENT, C.GAME, *C.ORDER, "split", "next_pitch_type_code", *[f"ctx_{j}" for j in range(k + 1)]))
    classes = classes_of(m)
    tree = CT.fit_context_tree(ctx, classes, [C.ENT], "next_pitch_type_code", k, MIN_GAIN, min_count=MIN_COUNT, train=F.col("split") == "train")
    return tree, ctx, classes


@register(
    "L1_context_tree",
    S.q(
        S.MODEL + TREE_CTES,
        "select player_name, 0 as \"order\", ctx as context, cast(total as bigint) as total, cast(null as double) as gain from n0 "
        "union all select player_name, 1, ctx, cast(total as bigint), round(gain, 6) from n1 "
        "union all select player_name, 2, ctx, cast(total as bigint), round(gain, 6) from n2",
    ),
)
def l1_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of the pruned context tree with their training rows and gains."""
    tree, _, _ = _tree(spark, sf)
    return tree.select(C.ENT, "order", "context", "total", F.round("gain", 6).alias("gain"))


# ---------------------------------------------------------------- order and batches of windows
@register("Q7_block_shuffle", S.q(S.SPLIT, "select event_id, split from sr where split = 'train'"))
def q7_blocks(spark: SparkSession, sf: str) -> DataFrame:
    s, _ = C._split(spark, sf)
    train = materialize(s.filter(F.col("split") == "train").select("event_id", "split"), "train")
    return Q.block_shuffle(train, ["event_id"], epoch=1).select("event_id", "split")


BATCH_ROWS, BUCKETS = 64, (3, 6)
BATCH_SQL = (
    "w as (select event_id, player_name, game_pk, game_date, at_bat_number, pitch_number, split, next_pitch_type_code as y, "
    "count(*) over (partition by player_name, game_pk order by " + C.ORD + " rows between 9 preceding and current row) as n from sr), "
    "b as (select *, case when n <= 3 then 3 when n <= 6 then 6 else 10 end as bucket from w)"
)


@register(
    "S7_mini_batches",
    S.q(
        S.SPLIT + [BATCH_SQL],
        "select event_id, split, bucket, cast(n as integer) as n_rows, y, "
        "cast((row_number() over (partition by split, bucket order by event_id) - 1) // 64 as bigint) as batch, "
        "cast((row_number() over (partition by split, bucket order by event_id) - 1) % 64 as integer) as slot from b",
    ),
)
def s7_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Padded windows in fixed-size batches per split and length."""
    s, _ = C._split(spark, sf, keep=C.SEQ_FEATURES)
    w = Q.padded_windows(
        s, C.SEQ_FEATURES, "next_pitch_type_code", SEQ_LEN, C.ORDER, [C.ENT, C.GAME], buckets=BUCKETS, keep=["event_id", "split"]
    )
    batched = Q.mini_batches(w.select("event_id", "split", "bucket", "mask", "y"), ["split", "bucket"], ["event_id"], BATCH_ROWS)
    n_rows = F.aggregate("mask", F.lit(0), lambda a, v: a + v).alias("n_rows")
    return batched.select("event_id", "split", "bucket", n_rows, "y", "batch", "slot")


# ---------------------------------------------------------------- incremental store
@register("S4_incremental_store", S.q(S.CLEAN, f"select {C.CLEAN_OUT} from c"))
def s4_store(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned rows loaded in two parts, the second of which comes twice."""
    rows = materialize(C._clean_out(spark, sf), "clean")
    path = shared_dir(spark, "store")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    store.create_store(rows, table, path, "game_date", [C.ENT, C.GAME], C.ORDER)
    even = F.dayofmonth(F.to_date("game_date")) % 2 == 0
    store.load_days(rows.filter(even), table)
    for _ in range(2):
        store.load_days(rows.filter(~even), table)
    return store.read_store(spark, table).select(*rows.columns)
