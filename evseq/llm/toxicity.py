"""Operator 5: toxicity severity by cumulative-link ordinal regression.

A text's sparse features are its words and word beginnings of 3 to 7
characters, hashed to ``BUCKETS`` and weighted by the root of their share of
all words, so the length of a text does not matter.  One weight vector serves
all thresholds: P(grade <= k) = sigmoid(theta_k - w.x) with ordered thetas.
The expected severity is the sum over k of P(grade > k).

Fitting uses at most ``MAX_TRAIN`` labelled rows (a bounded sample by the hash
of the id, the rows with crc32(id) mod 5 = 0 held out): document counts per
bucket are aggregated in Spark, the ``MAX_FEATURES`` buckets with the largest
chi-square are kept, and the sample's few kept features go to the driver.  A
label with grades above 1 is used as it is; of a 0/1 label the positives are
graded 1 to ``GRADES`` by how much of the text the positive features fill.
Every document is then scored in one streaming pass.

Defined cases: null and empty texts have no features and get the score of an
empty text; null labels and labels without a document are ignored; without any
positive label every severity is 0; a null id is not held out; repeated rows
are scored alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evseq.llm.common import pick, written
from evseq.llm.quality import held_out

MAX_TRAIN = 20_000
MAX_FEATURES = 4_000
BUCKETS = 1 << 18
GRADES = 3
TOXIC_AT = 0.5  # a text is toxic if P(grade >= 1) is at least this
MIN_SUPPORT = 3  # positive documents a feature needs
CACHE_WORDS = 300_000
PIECE = 1 << 20  # characters of a text split into words at once
WORD = re.compile(r"\w+")


def buckets(word: str) -> set[int]:
    """Buckets of a word and of its beginnings."""
    parts = {word} | {f"^{word[:k]}" for k in range(3, min(7, len(word)) + 1)}
    return {zlib.crc32(p.encode()) % BUCKETS for p in parts}


def word_counts(text: str | None) -> Counter:
    """Lower-cased words of a whole text, read in pieces that end between words."""
    out: Counter = Counter()
    text, at = text or "", 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and (text[end - 1].isalnum() or text[end - 1] == "_"):
            end += 1
        out.update(WORD.findall(text[at:end].lower()))
        at = end
    return out


class Featurizer:
    """Sparse features among a fixed set of buckets, words remembered."""

    def __init__(self, kept: np.ndarray):
        self.index = {int(b): i for i, b in enumerate(kept)}
        self.cache: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> tuple[list[int], list[float]]:
        counts = word_counts(text)
        total = sum(counts.values())
        cache, hits = self.cache, Counter()
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for word, n in counts.items():
            found = cache.get(word)
            if found is None:
                found = cache[word] = tuple(self.index[b] for b in buckets(word) if b in self.index)
            for i in found:
                hits[i] += n
        features = sorted(hits)
        return features, [10.0 * (hits[i] / total) ** 0.5 for i in features]


@dataclass(frozen=True)
class OrdinalModel:
    kept: np.ndarray
    weights: np.ndarray
    theta: np.ndarray

    def above(self, texts: list[str | None], featurizer: Featurizer) -> np.ndarray:
        """(texts, thresholds): P(grade > k)."""
        s = np.zeros(len(texts))
        for i, text in enumerate(texts):
            f, v = featurizer(text)
            if f:
                s[i] = np.dot(self.weights[f], v)
        return 1 / (1 + np.exp(np.clip(self.theta[None, :] - s[:, None], -40, 40)))


def fit_ordinal(rows: list[tuple[list[int], list[float]]], y: np.ndarray, n_features: int, grades: int, l2=0.02, steps=400):
    """Weights and ordered thresholds by full-batch Adam on the likelihood."""
    row = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    col = np.array([i for f, _ in rows for i in f], dtype=np.int64)
    val = np.array([v for _, x in rows for v in x], dtype=float)
    n = len(rows)
    share = [(np.sum(y <= k) + 0.5) / (n + 1) for k in range(grades)]
    logit = [np.log(s / (1 - s)) for s in share]
    gaps = np.log(np.maximum(np.diff(logit), 1e-3))
    params = np.concatenate([np.zeros(n_features), [logit[0]], gaps])
    m, v2 = np.zeros_like(params), np.zeros_like(params)
    step_up = np.arange(grades)
    for t in range(1, steps + 1):
        w, first, gap = params[:n_features], params[n_features], params[n_features + 1 :]
        theta = first + np.concatenate([[0.0], np.cumsum(np.exp(gap))])
        s = np.bincount(row, val * w[col], n)
        cdf = 1 / (1 + np.exp(-np.clip(theta[None, :] - s[:, None], -35, 35)))
        full = np.concatenate([np.zeros((n, 1)), cdf, np.ones((n, 1))], axis=1)
        slope = np.concatenate([np.zeros((n, 1)), cdf * (1 - cdf), np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        prob = np.maximum(full[at, y + 1] - full[at, y], 1e-12)
        upper, lower = slope[at, y + 1] / prob, slope[at, y] / prob
        d_s = (upper - lower) / n  # derivative of the mean negative log likelihood by s
        d_theta = np.array([lower[y == k + 1].sum() - upper[y == k].sum() for k in range(grades)]) / n
        d_gap = np.array([d_theta[step_up >= k].sum() * np.exp(gap[k - 1]) for k in range(1, grades)])
        grad = np.concatenate([np.bincount(col, val * d_s[row], n_features) + l2 * w / n, [d_theta.sum()], d_gap])
        m, v2 = 0.9 * m + 0.1 * grad, 0.99 * v2 + 0.01 * grad**2
        params = params - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v2 / (1 - 0.99**t)) + 1e-8)
    theta = params[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(params[n_features + 1 :]))])
    return params[:n_features], theta


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_train: int = MAX_TRAIN,
) -> OrdinalModel:
    known = (
        pick(labels, id=id_col, label=label_col)
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out("id"))
        .groupBy("id")
        .agg(F.max(F.col("label").cast("int")).alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_train)
    )
    sample = pick(docs, id=id_col, text=text_col).join(F.broadcast(known), "id")  # at most max_train ids
    # one text an id, so that ids that repeat cannot lift the bound
    sample = written(sample.groupBy("id").agg(F.first("label").alias("label"), F.min("text").alias("text")), "toxic-sample")
    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("label") > 0).cast("long")).alias("pos")).first()
    n, pos = totals["n"], totals["pos"] or 0
    empty = OrdinalModel(np.zeros(0, int), np.zeros(0), np.array([40.0]))
    if not pos:
        return empty

    def count(batches):
        for batch in batches:
            tally = np.zeros((2, BUCKETS), dtype=np.int64)
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set().union(*map(buckets, word_counts(text)))
                tally[int(label > 0), list(found)] += 1
            b = np.nonzero(tally.sum(0))[0]
            yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(tally[1, b]), pa.array(tally[0, b])], ["bucket", "p", "c"])

    per = sample.select("text", "label").mapInArrow(count, "bucket long, p long, c long").groupBy("bucket")
    p, c = F.col("p"), F.col("c")
    chi = (p * (n - pos) - c * pos) ** 2 / ((p + c) * (n - p - c + 1))
    kept_rows = (
        per.agg(F.sum("p").alias("p"), F.sum("c").alias("c"))
        .filter(p >= MIN_SUPPORT)
        .select("bucket", chi.alias("chi"), (p * (n - pos) > c * pos).alias("positive"))
        .orderBy(F.desc("chi"), "bucket")
        .limit(MAX_FEATURES)
        .collect()
    )
    kept = np.array([r["bucket"] for r in kept_rows], dtype=np.int64)
    positive = np.array([r["positive"] and i < 200 for i, r in enumerate(kept_rows)], dtype=bool)

    def extract(batches):
        featurizer = Featurizer(kept)
        for batch in batches:
            got = [featurizer(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.float64())), batch.column(2)],
                ["id", "f", "v", "label"],
            )

    id_type = sample.schema["id"].dataType.simpleString()
    got = (
        sample.select("id", "text", "label")
        .mapInArrow(extract, f"id {id_type}, f array<int>, v array<double>, label int")
        .orderBy("id")
        .collect()
    )
    rows = [(r["f"], r["v"]) for r in got]
    y = np.array([max(0, r["label"]) for r in got])
    if y.max() == 1:
        fill = np.array([sum(v for i, v in zip(f, x) if positive[i]) for f, x in rows])
        cuts = np.quantile(fill[y > 0], np.linspace(0, 1, GRADES + 1)[1:-1])
        y = np.where(y > 0, 1 + np.searchsorted(cuts, fill, side="right"), 0)
    grades = int(y.max())
    if not len(kept):
        return OrdinalModel(kept, np.zeros(0), np.array([np.log((n - pos + 0.5) / (pos + 0.5))]))
    weights, theta = fit_ordinal(rows, y, len(kept), grades)
    return OrdinalModel(kept, weights, theta)


def severity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Per document: doc_id, held_out, expected_severity, p_toxic, grade, toxic."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, **kw))
    base = pick(docs, doc_id=id_col, text=text_col)

    def score(batches):
        featurizer = Featurizer(model.value.kept)
        for batch in batches:
            above = model.value.above(batch.column(1).to_pylist(), featurizer)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(above), pa.list_(pa.float64()))], ["doc_id", "above"])

    id_type = base.schema["doc_id"].dataType.simpleString()
    scored = base.mapInArrow(score, f"doc_id {id_type}, above array<double>")
    total = F.aggregate("above", F.lit(0.0), lambda a, x: a + x)
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        total.alias("expected_severity"),
        F.col("above")[0].alias("p_toxic"),
        # the median grade: thresholds that are more likely passed than not
        F.size(F.filter("above", lambda x: x >= 0.5)).alias("grade"),
        (F.col("above")[0] >= TOXIC_AT).alias("toxic"),
    )
