"""Next-event models trained by synchronous gradient steps.

A model is an *objective*: a parameter vector, the summed loss and gradient of
some rows, and the probabilities of some rows.  Spark deals the rows: each task
sums loss and gradient over its rows (numpy on Arrow batches), Spark adds the
sums up by cell, and the driver, which holds the parameters only, takes a step.
One model serves all entities, so no entity has to fit one task, and one job
evaluates any number of trials on the same rows.

Sums travel as integers (multiples of 2^-40), so the order in which tasks end
plays no part: a run that is killed and resumed equals an unbroken one.

* ``lbfgs``: full-batch quasi-Newton steps with a line search; the loss falls in
  every round.
* ``fit_epochs``: mini-batch Adam with validation loss, patience, the best state
  kept, and one appended state row an epoch in a shared folder, from which the
  same call goes on.
* ``successive_halving``: brackets of trials of which the best go on from their
  warm states.

Rows: ``num`` array<double>, ``y`` int (class 0 .. C-1), optionally ``w``
(weight, 1 where absent); ``GatedRecurrent`` also reads ``code`` array<int> and
``slot`` int.  Rows with a null label, weight or input are left out; a null
inside ``num`` counts as 0 (the mean of scaled inputs), a null inside ``code``
as the unknown code; a NaN or infinite input raises.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evseq.operators.model import EPSILON

FIXED = 1 << 40  # sums are multiples of 1 / FIXED
SLICE = 2_048  # rows turned into matrices at once


# ---------------------------------------------------------------- objectives
def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def focal_terms(p: np.ndarray, y: np.ndarray, gamma: float, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Focal loss of each row and its derivative by the logits.

    ``alpha * (1 - p)^gamma * -log(p)`` of the true class's probability, clipped
    as in ``model.focal_loss``; flat where the clip holds.
    """
    at = np.arange(len(y))
    true = p[at, y]
    q = np.clip(true, EPSILON, 1 - EPSILON)
    loss = alpha * (1 - q) ** gamma * -np.log(q)
    slope = alpha * (gamma * q * (1 - q) ** (gamma - 1) * np.log(q) - (1 - q) ** gamma)  # dloss/dq * q
    slope = np.where(true == q, slope, 0.0)
    by_logit = -p * slope[:, None]
    by_logit[at, y] += slope
    return loss, by_logit


def _matrix(column: pa.Array, width: int, kind, fill) -> np.ndarray:
    flat = column.flatten().fill_null(fill).to_numpy(zero_copy_only=False)
    return flat.astype(kind).reshape(-1, width)


@dataclass(frozen=True)
class FocalSoftmax:
    """Multinomial logistic model under focal loss; gamma = 0 and alpha = 1 is
    plain logistic regression."""

    n_features: int
    n_classes: int
    gamma: float = 2.0
    alpha: float = 0.25
    l2: float = 0.0  # on the coefficients, not the intercepts
    columns: tuple[str, ...] = ("num",)

    @property
    def size(self) -> int:
        return (self.n_features + 1) * self.n_classes

    def start(self, seed: int = 0) -> np.ndarray:
        return np.zeros(self.size)

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        return (_matrix(batch.column("num"), self.n_features, float, 0.0),)

    def probabilities(self, params: np.ndarray, x: np.ndarray) -> np.ndarray:
        w = params.reshape(self.n_features + 1, self.n_classes)
        return softmax(x @ w[:-1] + w[-1])

    def loss(self, params: np.ndarray, y: np.ndarray, weight: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
        loss, by_logit = focal_terms(self.probabilities(params, x), y, self.gamma, self.alpha)
        by_logit *= weight[:, None]
        return float(loss @ weight), np.concatenate([(x.T @ by_logit).ravel(), by_logit.sum(axis=0)])

    def penalty(self, params: np.ndarray) -> tuple[float, np.ndarray]:
        flat = params.copy()
        flat[self.n_features * self.n_classes :] = 0.0
        return 0.5 * self.l2 * float(flat @ flat), self.l2 * flat


@dataclass(frozen=True)
class GatedRecurrent:
    """A gated recurrent cell over a window, with learned vectors for codes and
    for entities (hashed to ``n_slots`` slots), and a softmax on its last state.

    Step t reads [numeric inputs, vector of the code, vector of the slot]:
    r, z = sigmoid(..), n = tanh(x Wn + r * (h Un) + bn), h = (1 - z) n + z h.
    """

    length: int
    n_numeric: int
    n_codes: int
    n_slots: int
    n_classes: int
    hidden: int = 16
    code_dim: int = 4
    slot_dim: int = 2
    gamma: float = 0.0
    alpha: float = 1.0
    l2: float = 0.0
    columns: tuple[str, ...] = ("num", "code", "slot")

    @property
    def shapes(self) -> dict[str, tuple[int, ...]]:
        width = self.n_numeric + self.code_dim + self.slot_dim
        return {
            "code": (self.n_codes + 1, self.code_dim),  # the last one: unknown
            "slot": (self.n_slots, self.slot_dim),
            "wx": (width, 3 * self.hidden),  # r, z, n
            "wh": (self.hidden, 3 * self.hidden),
            "b": (3 * self.hidden,),
            "wo": (self.hidden, self.n_classes),
            "bo": (self.n_classes,),
        }

    @property
    def size(self) -> int:
        return sum(math.prod(s) for s in self.shapes.values())

    def parts(self, params: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            out[name] = params[at : at + math.prod(shape)].reshape(shape)
            at += math.prod(shape)
        return out

    def start(self, seed: int = 0) -> np.ndarray:
        rng = np.random.default_rng(seed)
        params = rng.standard_normal(self.size)
        for name, part in self.parts(params).items():
            part *= 0.0 if name in ("b", "bo") else 0.1 if name in ("code", "slot") else 1 / math.sqrt(part.shape[0])
        return params

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        x = _matrix(batch.column("num"), self.length * self.n_numeric, float, 0.0)
        code = _matrix(batch.column("code"), self.length, np.int64, self.n_codes)
        code = np.where((code >= 0) & (code < self.n_codes), code, self.n_codes)
        slot = batch.column("slot").to_numpy(zero_copy_only=False).astype(np.int64)
        return x.reshape(-1, self.length, self.n_numeric), code, slot

    def _forward(self, p: dict[str, np.ndarray], x: np.ndarray, code: np.ndarray, slot: np.ndarray):
        k = self.hidden
        vector = np.broadcast_to(p["slot"][slot][:, None, :], (len(x), self.length, self.slot_dim))
        inputs = np.concatenate([x, p["code"][code], vector], axis=2)
        gates = inputs @ p["wx"] + p["b"]
        h, steps = np.zeros((len(x), k)), []
        for t in range(self.length):
            back = h @ p["wh"]
            r, z = (1 / (1 + np.exp(-(gates[:, t, : 2 * k] + back[:, : 2 * k])))).reshape(-1, 2, k).swapaxes(0, 1)
            n = np.tanh(gates[:, t, 2 * k :] + r * back[:, 2 * k :])
            steps.append((h, r, z, n, back[:, 2 * k :]))
            h = (1 - z) * n + z * h
        return inputs, steps, h, softmax(h @ p["wo"] + p["bo"])

    def probabilities(self, params: np.ndarray, x: np.ndarray, code: np.ndarray, slot: np.ndarray) -> np.ndarray:
        return self._forward(self.parts(params), x, code, slot)[-1]

    def loss(
        self, params: np.ndarray, y: np.ndarray, weight: np.ndarray, x: np.ndarray, code: np.ndarray, slot: np.ndarray
    ) -> tuple[float, np.ndarray]:
        p, k = self.parts(params), self.hidden
        inputs, steps, h, prob = self._forward(p, x, code, slot)
        loss, by_logit = focal_terms(prob, y, self.gamma, self.alpha)
        by_logit *= weight[:, None]
        grad = np.zeros(self.size)
        g = self.parts(grad)
        g["wo"] += h.T @ by_logit
        g["bo"] += by_logit.sum(axis=0)
        dh = by_logit @ p["wo"].T
        for t in range(self.length - 1, -1, -1):
            before, r, z, n, back = steps[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (before - n) * z * (1 - z)
            dr = dn * back * r * (1 - r)
            gate = np.concatenate([dr, dz, dn], axis=1)
            g["wx"] += inputs[:, t].T @ gate
            g["b"] += gate.sum(axis=0)
            by_back = np.concatenate([dr, dz, dn * r], axis=1)
            g["wh"] += before.T @ by_back
            dh = dh * z + by_back @ p["wh"].T
            by_input = gate @ p["wx"].T
            np.add.at(g["code"], code[:, t], by_input[:, self.n_numeric : self.n_numeric + self.code_dim])
            np.add.at(g["slot"], slot, by_input[:, self.n_numeric + self.code_dim :])
        return float(loss @ weight), grad

    def penalty(self, params: np.ndarray) -> tuple[float, np.ndarray]:
        flat = params.copy()
        g = self.parts(flat)
        g["b"][:], g["bo"][:] = 0.0, 0.0
        return 0.5 * self.l2 * float(flat @ flat), self.l2 * flat


Objective = FocalSoftmax | GatedRecurrent


# ---------------------------------------------------------------- sums over all rows
def _usable(rows: DataFrame, objective: Objective) -> DataFrame:
    weight = F.col("w").cast("double") if "w" in rows.columns else F.lit(1.0)
    cols = [F.col("y").cast("int").alias("y"), weight.alias("w"), *objective.columns]
    return rows.select(*cols).dropna(subset=["y", "w", *objective.columns])


def sums(
    rows: DataFrame, objectives: Sequence[Objective], params: Sequence[np.ndarray], gradient: bool = True
) -> list[tuple[float, np.ndarray | None]]:
    """Mean loss (penalty included) and its gradient over all rows, for each
    objective at its parameters, in one job.  The objectives read the same columns."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast([np.asarray(p) for p in params])  # parameters only

    def add(batches):
        total = [np.zeros(1 + (o.size if gradient else 0), dtype=object) for o in objectives]
        weight_sum = 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                y = part.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
                w = part.column("w").to_numpy(zero_copy_only=False)
                weight_sum += _fixed(w.sum())
                inputs = objectives[0].read(part)
                for o, p, t in zip(objectives, shared.value, total):
                    loss, grad = o.loss(p, y, w, *inputs)
                    t[0] += _fixed(loss)
                    if gradient:
                        t[1:] += _whole(np.rint(grad * FIXED))
        for k, t in enumerate([np.array([weight_sum], dtype=object), *total]):
            values = pa.array([Decimal(int(v)) for v in t], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k - 1] * len(t), pa.int32()), pa.array(range(len(t)), pa.int32()), values], ["trial", "cell", "v"]
            )

    cells = _usable(rows, objectives[0]).mapInArrow(add, "trial int, cell int, v decimal(38,0)")
    found = cells.groupBy("trial", "cell").agg(F.sum("v").cast("decimal(38,0)").alias("v")).collect()  # parameters
    shared.unpersist()
    sizes = [1, *[1 + (o.size if gradient else 0) for o in objectives]]
    whole = [np.zeros(n) for n in sizes]
    for r in found:
        whole[r.trial + 1][r.cell] = int(r.v) / FIXED
    weight = whole[0][0]
    out = []
    for o, p, t in zip(objectives, params, whole[1:]):
        extra, extra_grad = o.penalty(p)
        mean = t / weight if weight else np.full(len(t), np.nan)
        out.append((float(mean[0]) + extra, mean[1:] + extra_grad if gradient else None))
    return out


def _whole(values: np.ndarray) -> np.ndarray:
    """Python's integers: no sum overflows."""
    return np.array([int(v) for v in values.tolist()], dtype=object)


def _fixed(value: float) -> int:
    return round(float(value) * FIXED)


def score(rows: DataFrame, objective: Objective, params: np.ndarray, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``y`` and the class probabilities ``p``, in one streaming pass."""
    shared = rows.sparkSession.sparkContext.broadcast(np.asarray(params))
    data = rows.select(*keep, F.col("y").cast("int").alias("y"), *objective.columns).dropna(subset=list(objective.columns))
    names = [*keep, "y"]

    def add(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                p = objective.probabilities(shared.value, *objective.read(part))
                ends = pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32())
                arrays = [part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(ends, pa.array(p.ravel()))], [*names, "p"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data.schema.fields if f.name in names)
    return data.mapInArrow(add, f"{kept}, p array<double>")


# ---------------------------------------------------------------- full-batch steps
@dataclass
class Round:
    round: int
    loss: float
    gradient_norm: float


def lbfgs(
    rows: DataFrame, objective: Objective, max_rounds: int = 100, tol: float = 1e-5, memory: int = 10, seed: int = 0
) -> tuple[np.ndarray, list[Round]]:
    """Minimise the mean loss; stops when the gradient's largest entry is below
    ``tol`` or no step lowers the loss.  Each evaluation is one job."""
    x = objective.start(seed)
    ((loss, g),) = sums(rows, [objective], [x])
    history = [Round(0, loss, float(np.abs(g).max()))]
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    while len(history) <= max_rounds and history[-1].gradient_norm > tol:
        direction = -_two_loop(g, pairs)
        if direction @ g >= 0:  # not downhill: curvature of a loss that is not convex
            pairs, direction = [], -g
        step = 1.0 if pairs else min(1.0, 1.0 / max(np.abs(g).sum(), 1e-12))
        while True:
            new = x + step * direction
            ((new_loss, new_g),) = sums(rows, [objective], [new])
            if new_loss <= loss + 1e-4 * step * (direction @ g):
                break
            step /= 2
            if step < 1e-10:
                return x, history
        s, d = new - x, new_g - g
        if s @ d > 1e-12 * (d @ d):
            pairs = [*pairs, (s, d)][-memory:]
        x, loss, g = new, new_loss, new_g
        history.append(Round(len(history), loss, float(np.abs(g).max())))
    return x, history


def _two_loop(g: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The inverse curvature of the last steps, applied to ``g``."""
    q, shares = g.copy(), []
    for s, d in reversed(pairs):
        a = (s @ q) / (s @ d)
        q = q - a * d
        shares.append(a)
    if pairs:
        s, d = pairs[-1]
        q = q * ((s @ d) / (d @ d))
    for (s, d), a in zip(pairs, reversed(shares)):
        q = q + s * (a - (d @ q) / (s @ d))
    return q


# ---------------------------------------------------------------- epochs of mini-batches
BETA1, BETA2, ADAM_EPSILON = 0.9, 0.999, 1e-8
STATE = (
    "trial int, epoch int, step int, loss double, val_loss double, stale int, best_epoch int, best_loss double, "
    "params array<double>, first array<double>, second array<double>, best array<double>"
)


@dataclass
class Trial:
    """An objective on its way: parameters, moments, and the best state so far."""

    objective: Objective
    rate: float
    params: np.ndarray
    first: np.ndarray
    second: np.ndarray
    best: np.ndarray
    trial: int = 0
    epoch: int = 0
    step: int = 0
    stale: int = 0  # epochs since the best
    best_epoch: int = 0
    best_loss: float = math.inf
    history: list[tuple[int, float, float]] = field(default_factory=list)  # epoch, loss, validation loss

    @classmethod
    def new(cls, objective: Objective, rate: float, seed: int = 0, trial: int = 0) -> Trial:
        x = objective.start(seed)
        return cls(objective, rate, x, np.zeros(len(x)), np.zeros(len(x)), x, trial)

    def adam(self, g: np.ndarray) -> None:
        self.step += 1
        self.first = BETA1 * self.first + (1 - BETA1) * g
        self.second = BETA2 * self.second + (1 - BETA2) * g * g
        m, v = self.first / (1 - BETA1**self.step), self.second / (1 - BETA2**self.step)
        self.params = self.params - self.rate * m / (np.sqrt(v) + ADAM_EPSILON)

    def end_epoch(self, loss: float, val_loss: float) -> None:
        self.epoch += 1
        self.stale += 1
        if val_loss < self.best_loss:
            self.best_loss, self.best, self.best_epoch, self.stale = val_loss, self.params, self.epoch, 0
        self.history.append((self.epoch, loss, val_loss))

    def row(self) -> tuple:
        _, loss, val_loss = self.history[-1]
        vectors = [[float(v) for v in a] for a in (self.params, self.first, self.second, self.best)]
        return (self.trial, self.epoch, self.step, loss, val_loss, self.stale, self.best_epoch, self.best_loss, *vectors)


def with_batches(rows: DataFrame, keys: Sequence[str | Column], n_batches: int, seed: int = 0) -> DataFrame:
    """Add ``batch`` (0 .. n_batches-1) by a seeded hash of the row's key."""
    return rows.withColumn("batch", F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(n_batches)).cast("int"))


def _append(spark: SparkSession, trials: Sequence[Trial], state_dir: str) -> None:
    spark.createDataFrame([t.row() for t in trials], STATE).coalesce(1).write.mode("append").parquet(state_dir)


def restore(spark: SparkSession, trials: Sequence[Trial], state_dir: str) -> None:
    """Bring each trial to the last epoch whose row was committed (two rows of one
    epoch, from runs killed between step and note, are equal)."""
    try:
        saved = spark.read.schema(STATE).parquet(state_dir)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return  # nothing noted yet
    for t in trials:
        own = saved.filter(F.col("trial") == t.trial)
        last = own.orderBy(F.desc("epoch")).limit(1).collect()
        if not last:
            continue
        r = last[0]
        t.epoch, t.step, t.stale, t.best_epoch, t.best_loss = r.epoch, r.step, r.stale, r.best_epoch, r.best_loss
        t.params, t.first, t.second, t.best = (np.array(v) for v in (r.params, r.first, r.second, r.best))
        seen = own.select("epoch", "loss", "val_loss").dropDuplicates(["epoch"]).orderBy("epoch").collect()
        t.history = [tuple(x) for x in seen]


def fit_epochs(
    train: DataFrame,
    val: DataFrame,
    trials: Sequence[Trial],
    max_epochs: int,
    patience: int,
    n_batches: int,
    state_dir: str | None = None,
    seed: int = 0,
) -> Sequence[Trial]:
    """Train every trial until ``max_epochs`` or until its validation loss has not
    fallen for ``patience`` epochs; all trials step through the same jobs.

    ``train`` has a ``batch`` column (``with_batches``), best written with
    ``partitionBy('batch')``, so that a step reads its own rows only.  The
    validation loss has no penalty.  With ``state_dir`` finished epochs are noted
    there and not done again.
    """
    spark = train.sparkSession
    if state_dir:
        restore(spark, trials, state_dir)

    def going() -> list[Trial]:
        return [t for t in trials if t.epoch < max_epochs and t.stale < patience]

    while live := going():
        epoch = min(t.epoch for t in live)
        live = [t for t in live if t.epoch == epoch]
        losses = []
        for b in np.random.default_rng([seed, epoch]).permutation(n_batches).tolist():
            found = sums(train.filter(F.col("batch") == b), [t.objective for t in live], [t.params for t in live])
            losses.append([loss for loss, _ in found])
            for t, (loss, g) in zip(live, found):
                if not math.isnan(loss):  # a batch without rows is no step
                    t.adam(g)
        held = sums(val, [replace(t.objective, l2=0.0) for t in live], [t.params for t in live], gradient=False)
        for t, mean, (val_loss, _) in zip(live, np.nanmean(np.array(losses), axis=0).tolist(), held):
            t.end_epoch(mean, val_loss)
        if state_dir:
            _append(spark, live, state_dir)
    return trials


def history_table(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    """(trial, epoch, loss, val_loss, best): one row per trial and epoch."""
    rows = [(t.trial, e, loss, v, e == t.best_epoch) for t in trials for e, loss, v in t.history]
    return spark.createDataFrame(rows, "trial int, epoch int, loss double, val_loss double, best boolean")


# ---------------------------------------------------------------- brackets of trials
def brackets(max_epochs: int, factor: int = 3) -> list[list[tuple[int, int]]]:
    """Per bracket its rungs (trials, epochs each has had at the end of the rung).

    The first bracket starts many trials with few epochs, the last one few
    trials with all of them; from rung to rung 1 / factor of the trials go on.
    """
    top = 0
    while factor ** (top + 1) <= max_epochs:
        top += 1
    out = []
    for s in range(top, -1, -1):
        n = -(-(top + 1) * factor**s // (s + 1))
        out.append([(n // factor**i, max(1, max_epochs * factor**i // factor**s)) for i in range(s + 1)])
    return out


@dataclass
class Rung:
    bracket: int
    rung: int
    trial: int
    epochs: int
    val_loss: float  # the best so far
    promoted: bool


def successive_halving(
    train: DataFrame,
    val: DataFrame,
    candidates: Sequence[tuple[Objective, float]],
    max_epochs: int,
    n_batches: int,
    factor: int = 3,
    patience: int = 1 << 30,
    state_dir: str | None = None,
    seed: int = 0,
) -> tuple[list[Trial], list[Rung]]:
    """Hyperband over (objective, learning rate) candidates, which are dealt to
    the brackets in turn.  All trials of a rung are evaluated by the same jobs
    (their objectives must read the same columns and have the same gamma and
    alpha); promoted ones go on from their warm states.  Ties go to the smaller
    trial number."""
    trials: list[Trial] = []
    notes: list[Rung] = []
    taken = 0
    for b, rungs in enumerate(brackets(max_epochs, factor)):
        size = rungs[0][0]
        picks = [candidates[(taken + i) % len(candidates)] for i in range(size)]
        taken += size
        own = [Trial.new(o, rate, seed, trial=len(trials) + i) for i, (o, rate) in enumerate(picks)]
        trials += own
        for r, (n, epochs) in enumerate(rungs):
            own = sorted(own, key=lambda t: (t.best_loss, t.trial))[:n] if r else own
            fit_epochs(train, val, own, epochs, patience, n_batches, state_dir, seed)
            go_on = rungs[r + 1][0] if r + 1 < len(rungs) else 0
            ranked = sorted(own, key=lambda t: (t.best_loss, t.trial))
            notes += [Rung(b, r, t.trial, t.epoch, t.best_loss, i < go_on) for i, t in enumerate(ranked)]
    return trials, notes
