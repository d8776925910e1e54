"""Trained models: gradients, fits, epochs with resume, brackets, code vectors."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from evseq.operators import embeddings as V
from evseq.operators import model as L
from evseq.operators import training as T

RNG = np.random.default_rng(5)
FOCAL = T.FocalSoftmax(4, 3, gamma=1.5, alpha=0.3, l2=0.01)
CELL = T.GatedRecurrent(length=5, n_numeric=2, n_codes=4, n_slots=3, n_classes=3, hidden=4, gamma=1.0, alpha=0.7, l2=0.01)


def numeric_gradient(f, x, eps=1e-6):
    return np.array([(f(x + eps * e) - f(x - eps * e)) / (2 * eps) for e in np.eye(len(x))])


@pytest.mark.parametrize("gamma", [0.0, 0.5, 2.0])
def test_focal_gradient(gamma):
    o = T.FocalSoftmax(4, 3, gamma=gamma, alpha=0.25, l2=0.1)
    x, y, w = RNG.standard_normal((20, 4)), RNG.integers(0, 3, 20), RNG.random(20)
    params = RNG.standard_normal(o.size)
    _, grad = o.loss(params, y, w, x)
    np.testing.assert_allclose(grad, numeric_gradient(lambda p: o.loss(p, y, w, x)[0], params), atol=1e-7)
    np.testing.assert_allclose(o.penalty(params)[1], numeric_gradient(lambda p: o.penalty(p)[0], params), atol=1e-7)


def test_recurrent_gradient():
    x, code, slot = RNG.standard_normal((20, 5, 2)), RNG.integers(0, 5, (20, 5)), RNG.integers(0, 3, 20)
    y, w = RNG.integers(0, 3, 20), RNG.random(20)
    params = CELL.start(1) * 1.5
    _, grad = CELL.loss(params, y, w, x, code, slot)
    np.testing.assert_allclose(grad, numeric_gradient(lambda p: CELL.loss(p, y, w, x, code, slot)[0], params), atol=1e-7)
    np.testing.assert_allclose(CELL.penalty(params)[1], numeric_gradient(lambda p: CELL.penalty(p)[0], params), atol=1e-7)


@pytest.fixture(scope="module")
def rows(spark):
    """Planted: the class follows the sign pattern of the inputs, with noise."""
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 4))
    y = np.where(x[:, 0] + 0.5 * rng.standard_normal(400) > 0.3, 0, np.where(x[:, 1] + 0.5 * rng.standard_normal(400) > 0, 1, 2))
    found = [(i, [float(v) for v in r], int(c), float(1 + i % 3)) for i, (r, c) in enumerate(zip(x, y))]
    df = T.with_batches(spark.createDataFrame(found, "id int, num array<double>, y int, w double"), ["id"], 4).repartition(3).cache()
    yield df
    df.unpersist()


def test_sums_hold_for_every_partitioning(rows):
    params = RNG.standard_normal(FOCAL.size)
    local = rows.orderBy("id").collect()
    x, y, w = (np.array([r[c] for r in local]) for c in ("num", "y", "w"))
    loss, grad = FOCAL.loss(params, y, w, x)
    extra, extra_grad = FOCAL.penalty(params)
    for n in (1, 8):
        ((got, got_grad),) = T.sums(rows.repartition(n), [FOCAL], [params])
        assert math.isclose(got, loss / w.sum() + extra, rel_tol=1e-9)
        np.testing.assert_allclose(got_grad, grad / w.sum() + extra_grad, atol=1e-9)


def test_sums_of_odd_rows(spark):
    found = [(0, [1.0, None, 0.0, 0.0], 1), (1, None, 1), (2, [0.0] * 4, None), (3, [1.0, 0.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(found, "id int, num array<double>, y int")
    params = RNG.standard_normal(FOCAL.size)
    loss, _ = FOCAL.loss(params, np.array([1, 1]), np.ones(2), np.array([[1.0, 0, 0, 0]] * 2))
    ((got, _),) = T.sums(df, [FOCAL], [params])
    assert math.isclose(got, loss / 2 + FOCAL.penalty(params)[0], rel_tol=1e-9)
    ((nothing, _),) = T.sums(df.limit(0), [FOCAL], [params])
    assert math.isnan(nothing)


def test_focal_fit_falls_every_round(rows):
    params, history = T.lbfgs(rows, T.FocalSoftmax(4, 3, gamma=2.0, alpha=0.25, l2=1e-3), max_rounds=25, tol=1e-4)
    losses = [h.loss for h in history]
    assert len(losses) > 4 and all(b < a for a, b in zip(losses, losses[1:]))
    assert history[-1].gradient_norm < history[0].gradient_norm / 20
    scored = T.score(rows, T.FocalSoftmax(4, 3), params, keep=["id"])
    # the trained loss is the one that L5 measures
    measured = L.focal_loss(scored).first()[0]
    ((unweighted, _),) = T.sums(rows.drop("w"), [T.FocalSoftmax(4, 3, gamma=2.0, alpha=0.25)], [params], gradient=False)
    assert math.isclose(measured, unweighted, rel_tol=1e-6)
    assert scored.filter(F.abs(F.aggregate("p", F.lit(0.0), lambda a, v: a + v) - 1) > 1e-9).count() == 0


def test_without_focusing_it_is_the_logistic_fit(rows):
    params, _ = T.lbfgs(rows, T.FocalSoftmax(4, 3, gamma=0.0, alpha=1.0), max_rounds=60, tol=1e-6)
    ours = {r.id: np.array(r.p) for r in T.score(rows, T.FocalSoftmax(4, 3), params, keep=["id"]).collect()}
    model = L.fit_logistic(rows.withColumn("y", F.col("y").cast("double")), "num", "y", weight="w", tol=1e-9)
    theirs = {r.id: np.array(r.p) for r in L.score_logistic(model, rows, "num").collect()}
    assert max(np.abs(ours[i] - theirs[i]).max() for i in ours) < 2e-3


@pytest.fixture(scope="module")
def sequences(spark):
    """Planted: the next code repeats the one four steps back, beyond order 2."""
    rng = np.random.default_rng(1)
    found = []
    for i in range(300):
        code = rng.integers(0, 3, 6).tolist()
        found.append((i, [0.0] * 6, code, i % 2, code[2], "train" if i < 200 else "val"))
    schema = "id int, num array<double>, code array<int>, slot int, y int, split string"
    df = T.with_batches(spark.createDataFrame(found, schema), ["id"], 2).repartition(2).cache()
    yield df
    df.unpersist()


MEMORY = T.GatedRecurrent(length=6, n_numeric=1, n_codes=3, n_slots=2, n_classes=3, hidden=8, code_dim=3, slot_dim=1, l2=1e-4)


def test_recurrent_cell_learns_what_short_contexts_cannot(sequences):
    train, val = (sequences.filter(F.col("split") == s) for s in ("train", "val"))
    params, history = T.lbfgs(train, MEMORY, max_rounds=60, tol=1e-4, seed=3)
    ((loss, _),) = T.sums(val, [T.replace(MEMORY, l2=0.0)], [params], gradient=False)
    # codes are independent: contexts of order 2 know nothing, their best loss is log 3
    assert loss < 0.75 * math.log(3)
    scored = T.score(val.withColumn("code", F.transform("code", lambda c: F.when(c < 9, c))), MEMORY, params, ["id"])
    assert scored.filter("y = array_position(p, array_max(p)) - 1").count() > 60


def trials():
    return [T.Trial.new(MEMORY, 0.05, seed=2)]


def test_killed_and_resumed_run_equals_an_unbroken_one(spark, sequences, tmp_path, monkeypatch):
    train, val = (sequences.filter(F.col("split") == s) for s in ("train", "val"))
    (whole,) = T.fit_epochs(train, val, trials(), 4, 9, 2, str(tmp_path / "whole"), seed=4)
    calls, real = [0], T.sums

    def killed(*a, **kw):
        calls[0] += 1
        if calls[0] == 5:  # in the middle of the second epoch
            raise RuntimeError("killed")
        return real(*a, **kw)

    monkeypatch.setattr(T, "sums", killed)
    with pytest.raises(RuntimeError, match="killed"):
        T.fit_epochs(train, val, trials(), 4, 9, 2, str(tmp_path / "broken"), seed=4)
    monkeypatch.setattr(T, "sums", real)
    (resumed,) = T.fit_epochs(train, val, trials(), 4, 9, 2, str(tmp_path / "broken"), seed=4)
    assert resumed.history == whole.history and len(whole.history) == 4
    assert (resumed.params == whole.params).all() and (resumed.best == whole.best).all()
    back = spark.read.schema(T.STATE).parquet(str(tmp_path / "broken"))
    assert sorted(tuple(r) for r in back.select("epoch", "loss", "val_loss").collect()) == whole.history
    (again,) = T.fit_epochs(train, val, trials(), 4, 9, 2, str(tmp_path / "broken"), seed=4)
    assert (again.params == whole.params).all() and back.count() == 4  # nothing left to do


def test_patience_keeps_the_best_state(rows):
    """A rate that overshoots: the validation loss rises, and the best state stays."""
    o = T.FocalSoftmax(4, 3, gamma=0.0, alpha=1.0)
    train, val = rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1")
    (t,) = T.fit_epochs(train, val, [T.Trial.new(o, 8.0)], 12, 2, 4)
    losses = [v for _, _, v in t.history]
    assert t.best_loss == min(losses) and t.best_epoch == losses.index(min(losses)) + 1
    assert len(losses) == min(12, t.best_epoch + 2) and t.stale == len(losses) - t.best_epoch
    ((loss, _),) = T.sums(val, [o], [t.best], gradient=False)
    assert math.isclose(loss, t.best_loss, rel_tol=1e-9)


def test_trials_step_alike_alone_and_together(rows):
    o = T.FocalSoftmax(4, 3, gamma=0.0, alpha=1.0)
    train, val = rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1")
    both = T.fit_epochs(train, val, [T.Trial.new(o, 0.1, trial=0), T.Trial.new(o, 0.01, trial=1)], 2, 9, 4)
    (alone,) = T.fit_epochs(train, val, [T.Trial.new(o, 0.01)], 2, 9, 4)
    assert (both[1].params == alone.params).all()


def test_brackets():
    assert T.brackets(9) == [[(9, 1), (3, 3), (1, 9)], [(5, 3), (1, 9)], [(3, 9)]]
    assert T.brackets(27)[0] == [(27, 1), (9, 3), (3, 9), (1, 27)] and [b[0][0] for b in T.brackets(27)] == [27, 12, 6, 4]
    assert T.brackets(1) == [[(1, 1)]] and T.brackets(4, 2)[0] == [(4, 1), (2, 2), (1, 4)]


def test_halving_finds_the_planted_optimum(rows):
    """One learning rate learns, the others hardly move: the best of the brackets
    is the best of the full grid."""
    train, val = rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1")
    o = T.FocalSoftmax(4, 3, gamma=0.0, alpha=1.0)
    grid = [(o, 1e-4), (o, 0.1), (o, 1e-5)]
    made, notes = T.successive_halving(train, val, grid, max_epochs=3, n_batches=4, seed=1)
    full = T.fit_epochs(train, val, [T.Trial.new(c, r, 1, trial=i) for i, (c, r) in enumerate(grid)], 3, 9, 4, seed=1)
    best = min(made, key=lambda t: (t.best_loss, t.trial))
    assert best.rate == min(full, key=lambda t: t.best_loss).rate == 0.1
    assert math.isclose(best.best_loss, min(t.best_loss for t in full), rel_tol=1e-12)
    assert [(n.bracket, n.rung, n.epochs) for n in notes] == [(0, 0, 1)] * 3 + [(0, 1, 3)] + [(1, 0, 3)] * 2
    assert [n.trial for n in notes if n.promoted] == [1]


def test_cooccurrence(spark):
    found = [("a", i, c) for i, c in enumerate([0, 1, None, 1, 2])] + [(None, i, c) for i, c in enumerate([2, 2])]
    got = V.cooccurrence(spark.createDataFrame(found, "g string, o int, c int"), "c", ["o"], ["g"], reach=2)
    assert {tuple(r) for r in got.collect()} == {(1, 0, 1), (1, 1, 1), (2, 1, 1), (2, 2, 1)}


def test_vectors_rebuild_planted_factors(spark):
    rng = np.random.default_rng(0)
    a, b = rng.random((12, 3)), rng.random((12, 3))
    found = [(i, j, float(a[i] @ b[j])) for i in range(12) for j in range(12)]
    counts = spark.createDataFrame(found, "code int, other int, n double")
    codes, others = V.factor(counts, rank=3, rounds=30, reg=1e-4, value=F.col("n"))
    u = {r.code: np.array(r.vector) for r in codes.collect()}
    v = {r.other: np.array(r.vector) for r in others.collect()}
    assert max(abs(u[i] @ v[j] - x) for i, j, x in found) < 0.05
    events = spark.createDataFrame([(1, 3), (2, 99), (3, None)], "id int, c int")
    got = {r.id: r.e for r in V.embed(events, "c", codes, "e").collect()}
    assert got[1] is not None and len(got[1]) == 3 and got[2] is None and got[3] is None


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_recurrent_model_beats_the_transition_model(spark):
    """Validation windows of the driver's table: log loss below L1's."""
    from evseq.plans import catalog as C
    from evseq.plans import learned

    windows, n_classes = learned.training_windows(spark, SF)
    trial = learned._epochs(spark, windows, n_classes)
    val = learned._of(windows, "val")
    ours = L.log_loss(T.score(val, trial.objective, trial.best, keep=[])).first()[0]
    scored, _ = C._scored(spark, SF, reused=False)
    events = val.select(F.col("event_id").alias("pitch_number"))
    theirs = L.log_loss(scored.filter("split = 'val'").join(events, "pitch_number", "left_semi")).first()[0]
    assert ours < theirs
