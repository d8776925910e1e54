"""Operator 13: PCA whitening from exact variances of dimensions and pair sums.

Entries become integers, x = floor(1024 c) + 100000.  A covariance is read off
variances only: cov(a, b) = (var(a + b) - var(a) - var(b)) / 2.

1. One pass sums every dimension exactly (n, S) and finds its range.
2. A second pass takes y = x - floor(S / n), so values are centred before they
   are multiplied, and sums the squares of every y and of every sum of two
   dimensions, as integers.  The fraction that floor leaves is put right
   exactly: n^2 var = n Q - r^2 with r = S - n floor(S / n).  A task sends
   d (d + 1) / 2 decimals; Spark adds them up.
3. The driver assembles the d x d covariance from exact integers, one rounding
   an entry, and calls eigh.  A third pass projects every row.
4. ``identity_error`` is measured on the written result: Spark's covariances of
   the whitened columns against the identity.

Nothing but d x d numbers reaches the driver, whatever the number of rows, and
no table of rows is shuffled.

Defined cases: a vector that is null or holds a null or non-finite entry is
dropped, and so is one without entries or of another length than the commonest
(ties: the longest); a null id is kept; repeated rows count each time; components
whose eigenvalue is zero to double precision have ``whitened`` null and are
left out of ``identity_error``; with no component left that is null; an empty
table gives no rows; an entry that makes x leave 62 bits raises; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evseq.llm.common import pick, written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
SLICE = 4_096  # vectors multiplied at once
RANK_EPS = 1e-12  # share of the largest eigenvalue below which one counts as zero
WIDE = pa.decimal128(38, 0)


@dataclass
class Whitener:
    n: int
    sums: list[int]  # per dimension
    mean: np.ndarray
    directions: np.ndarray  # d x k, unit eigenvectors
    eigenvalues: np.ndarray  # k, falling
    trace: float

    @property
    def usable(self) -> np.ndarray:
        return self.eigenvalues > RANK_EPS * max(self.trace, 0.0)


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, v) of the vectors that count, and their length."""
    base = pick(df, vec_id=id_col, v=vector_col)
    finite = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    base = base.filter((F.size("v") > 0) & finite).withColumn("v", F.col("v").cast("array<double>"))
    lengths = base.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths.d if lengths else 0
    return base.filter(F.size("v") == d), d


def integers(batch: pa.RecordBatch, d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch (vec_id, v) with their x as int64, rows by dimension."""
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        x = np.floor(part.column(1).flatten().to_numpy(zero_copy_only=False) * SCALE)
        if len(x) and np.abs(x).max() > 2.0**62:
            raise OverflowError("an entry does not fit into a long")
        yield part, x.astype(np.int64).reshape(-1, d) + SHIFT


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], WIDE)


def _total(x: np.ndarray) -> np.ndarray:
    """Exact column sums of integers as Python integers."""
    if len(x) and int(np.abs(x).max()) * len(x) >= 1 << 62:
        x = x.astype(object)
    return x.sum(axis=0).astype(object)


def dimension_sums(vectors: DataFrame, d: int) -> tuple[int, list[int], list[int], list[int]]:
    """Rows, and per dimension the exact sum, least and largest x."""

    def add(batches):
        n, total, low, high = 0, np.zeros(d, object), None, None
        for batch in batches:
            for _, x in integers(batch, d):
                n += len(x)
                total += _total(x)
                low = x.min(0) if low is None else np.minimum(low, x.min(0))
                high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), _decimals(total), pa.array(low), pa.array(high)],
                ["dim", "n", "s", "low", "high"],
            )

    part = vectors.mapInArrow(add, "dim int, n long, s decimal(38,0), low long, high long")
    rows = part.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"), F.min("low").alias("low"), F.max("high").alias("high"))
    got = rows.orderBy("dim").collect()  # d rows
    n = got[0].n if got else 0
    return n, [int(r.s) for r in got], [r.low for r in got], [r.high for r in got]


def squares(y: np.ndarray) -> np.ndarray:
    """Exact sums of squares of every column and of every sum of two columns, in
    the order (0, 0), (0, 1), .. (1, 1), ..; a pair (i, i) is the column itself."""
    d = y.shape[1]
    out = []
    for i in range(d):
        pair = y[:, i:] + y[:, i : i + 1]
        pair[:, 0] = y[:, i]
        out.append((pair * pair).sum(axis=0))
    return np.concatenate(out).astype(object)


def pair_squares(vectors: DataFrame, d: int, center: list[int], reach: int) -> list[int]:
    """Exact sums of squared centred values, over all vectors; ``reach``: the
    largest absolute centred value."""
    cells = d * (d + 1) // 2
    fits = (2 * reach) ** 2 * SLICE < 1 << 62  # else Python's integers
    origin = np.array(center, dtype=np.int64)

    def add(batches):
        total = np.zeros(cells, object)
        some = False
        for batch in batches:
            for _, x in integers(batch, d):
                y = x - origin
                total += squares(y if fits else y.astype(object))
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(range(cells), pa.int32()), _decimals(total)], ["cell", "q"])

    part = vectors.mapInArrow(add, "cell int, q decimal(38,0)")
    rows = part.groupBy("cell").agg(F.sum("q").cast("decimal(38,0)").alias("q")).orderBy("cell")
    return [int(r.q) for r in rows.collect()]  # d (d + 1) / 2 rows


def covariance(n: int, sums: list[int], center: list[int], q: list[int]) -> np.ndarray:
    """d x d covariance (divisor n) from the variances of dimensions and pair sums."""
    d = len(sums)
    rest = [s - n * c for s, c in zip(sums, center)]
    at = {}
    cells = ((i, j) for i in range(d) for j in range(i, d))
    for (i, j), value in zip(cells, q):
        r = rest[i] if i == j else rest[i] + rest[j]
        at[i, j] = n * value - r * r  # n^2 times the variance, an integer
    out = np.empty((d, d))
    for (i, j), value in at.items():
        cov = value / (n * n) if i == j else (value - at[i, i] - at[j, j]) / (2 * n * n)
        out[i, j] = out[j, i] = cov
    return out


def fit(vectors: DataFrame, d: int, components: int = COMPONENTS) -> Whitener | None:
    if not d:  # no vector counts
        return None
    n, sums, low, high = dimension_sums(vectors, d)
    center = [s // n for s in sums]
    reach = max(max(h - c, c - lo) for lo, h, c in zip(low, high, center))
    v = covariance(n, sums, center, pair_squares(vectors, d, center, reach))
    values, directions = np.linalg.eigh(v)
    take = np.argsort(values, kind="stable")[::-1][:components]
    mean = np.array([c + (s - n * c) / n for s, c in zip(sums, center)])
    return Whitener(n, sums, mean, np.ascontiguousarray(directions[:, take]), values[take], float(np.trace(v)))


def project(vectors: DataFrame, model: Whitener) -> DataFrame:
    """Per vector: vec_id, deviation (decimal), z (whitened coordinates)."""
    d = len(model.sums)
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    id_type = vectors.schema["vec_id"].dataType.simpleString()

    def place(batches):
        m = shared.value
        floor = np.array([s // m.n for s in m.sums], dtype=np.int64)
        fraction = np.array([(s % m.n) / m.n for s in m.sums])
        rest = np.array([s % m.n for s in m.sums], dtype=object)
        scale = np.where(m.usable, m.eigenvalues, np.nan)
        for batch in batches:
            for part, x in integers(batch, d):
                y = x - floor
                away = y.astype(object) * m.n - rest
                z = (y - fraction) @ m.directions / np.sqrt(scale)
                flat = pa.array(z.ravel(), mask=np.isnan(z.ravel()))
                ends = pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _decimals((away * away).sum(axis=1)), pa.ListArray.from_arrays(ends, flat)],
                    ["vec_id", "deviation", "z"],
                )

    return vectors.mapInArrow(place, f"vec_id {id_type}, deviation decimal(38,0), z array<double>")


def identity_error(placed: DataFrame, usable: list[int]) -> float | None:
    """Largest absolute entry of cov(z) - I over the usable components."""
    pairs = [(i, j) for i in usable for j in usable if i <= j]
    if not pairs:
        return None
    row = placed.agg(*[F.covar_pop(F.col("z")[i], F.col("z")[j]).alias(f"c{k}") for k, (i, j) in enumerate(pairs)]).first()
    return max(abs(row[f"c{k}"] - (i == j)) for k, (i, j) in enumerate(pairs))


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per vector and component (from 1): vec_id, component, n, deviation
    (decimal), whitened, explained, identity_error."""
    vectors, d = valid_vectors(df, id_col, vector_col)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    model = fit(vectors, d, components)
    if model is None:
        schema = (
            f"vec_id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
            "identity_error double"
        )
        return df.sparkSession.createDataFrame([], schema)
    placed = written(project(vectors, model), "whitened")
    error = identity_error(placed, [i for i, ok in enumerate(model.usable) if ok])
    share = [float(e / model.trace) if model.trace > 0 else None for e in model.eigenvalues]
    explained = F.array(*[F.lit(s).cast("double") for s in share])
    long = placed.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return long.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
