"""Operator 4: quality classifier, gradient-boosted trees over document statistics.

``features`` turns a whole text into fixed statistics of its bytes, words and
lines, which are the same at every length (memory grows with a text's distinct
words, word pairs and lines); nothing else (language, source, id) enters a score.  The trees are
fitted on the driver from at most ``MAX_TRAIN`` labelled rows, a bounded
sample taken by the hash of the id; rows whose crc32(id) mod 5 is 0 are held
out.  The flattened trees (a few ten kB) are broadcast and every document is
scored in one streaming pass without a shuffle.

Defined cases: a null or empty text has all statistics 0 and is scored like
any other; a labelled id without a document or with a null label is ignored;
an id labelled twice is used once per label; without any label every score is
0.5; a null id is not held out; an empty table gives no rows; other columns
are ignored (``keep_good`` keeps them).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evseq.llm import boosting
from evseq.llm.common import pick, positional

MAX_TRAIN = 20_000  # labelled rows fitted at most
THRESHOLD = 0.3
FOLDS = 5
PIECE = 1 << 20  # bytes of a text split into words at once
SPACE, LINE_END = re.compile(rb"\s"), re.compile(rb"\n")
MARKS = b"$#%&*!|.,;:?-\"'()/\\<>=@_+~^{}[]"
N_FEATURES = 21 + len(MARKS)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % FOLDS == 0, F.lit(False))


def pieces(raw: bytes, separator: re.Pattern[bytes]) -> Iterator[bytes]:
    """A text in pieces that end before a separator, so no word or line is cut."""
    at = 0
    while at < len(raw):
        cut = separator.search(raw, at + PIECE)
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end


def features(text: str | None) -> np.ndarray:
    """Statistics of a whole text.  Words, word pairs and lines are counted over
    all of it; ``PIECE`` only bounds the word list held at once."""
    raw = (text or "").encode()
    if not raw:
        return np.zeros(N_FEATURES)
    size = len(raw)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    by_word: Counter[bytes] = Counter()
    by_line: Counter[bytes] = Counter()
    pairs: set[tuple[bytes, bytes]] = set()
    repeats, last = 0, None
    for piece in pieces(raw, SPACE):
        w = piece.split()
        if not w:
            continue
        if last is not None:
            repeats += last == w[0]
            pairs.add((last, w[0]))
        by_word.update(w)
        repeats += sum(map(bytes.__eq__, w, w[1:]))
        pairs.update(zip(w, w[1:]))
        last = w[-1]
    for piece in pieces(raw, LINE_END):
        by_line.update(x for x in piece.split(b"\n") if x)
    words = word_bytes = long_words = marked = capital = upper = 0
    for x, k in by_word.items():
        words += k
        word_bytes += k * len(x)
        long_words += k * (len(x) > 14)
        marked += k * (len(x) > 3 and x[-1] == x[-2] == x[-3])
        capital += k * x[:1].isupper()
        upper += k * (len(x) > 1 and x.isupper())
    unique, top = len(by_word), max(by_word.values(), default=0)
    lines, distinct_lines, top_line = sum(by_line.values()), len(by_line), max(by_line.values(), default=0)
    short_lines = sum(k for x, k in by_line.items() if len(x) < 30)
    nw, nl = max(words, 1), max(lines, 1)
    shares = [
        count[65:91].sum() / size,
        count[97:123].sum() / size,
        count[48:58].sum() / size,
        count[32] / size,
        count[10] / size,
        count[128:].sum() / size,
    ]
    return np.array(
        [
            np.log1p(size), np.log1p(words), np.log1p(lines), word_bytes / nw, unique / nw, repeats / nw, top / nw,
            len(pairs) / nw, long_words / nw, marked / nw, capital / nw, upper / nw, distinct_lines / nl, top_line / nl,
            short_lines / nl, *shares, *(count[list(MARKS)] / size),
        ]
    )


def feature_rows(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(-1, N_FEATURES)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_train: int = MAX_TRAIN,
) -> boosting.Forest:
    """Fit on at most ``max_train`` labelled documents outside the held-out fold."""
    known = (
        pick(labels, id=id_col, label=label_col)
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out("id"))
        .distinct()
        .orderBy(F.xxhash64("id"), "id", "label")
        .limit(max_train)
    )
    # at most max_train ids and numbers, proven by the limit
    rows = pick(docs, id=id_col, text=text_col).join(F.broadcast(known), "id").select("id", "text", "label")

    def measure(batches):
        for batch in batches:
            x = feature_rows(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(x), pa.list_(pa.float64())), batch.column(2).cast(pa.float64())],
                ["id", "x", "y"],
            )

    id_type = known.schema["id"].dataType.simpleString()
    measured = rows.mapInArrow(measure, f"id {id_type}, x array<double>, y double")
    # ids that repeat in docs would lift the bound: one row an id and label
    table = measured.groupBy("id", "y").agg(F.min("x").alias("x")).orderBy("id", "y").collect()
    x = np.array([r["x"] for r in table]).reshape(-1, N_FEATURES)
    return boosting.fit(x, np.array([r["y"] for r in table]))


def add_score(docs: DataFrame, model: boosting.Forest, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` plus the score (0 to 1, higher: better) as the last column."""
    renamed, names = positional(docs, text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("__text")).to_pylist()
            p = shared.value.predict(feature_rows(texts))
            k = batch.schema.get_field_index("__score")
            yield batch.set_column(k, batch.schema.field(k), pa.array(p, pa.float64()))

    df = renamed.withColumn("__score", F.lit(None).cast("double"))
    return df.mapInArrow(score, df.schema).toDF(*names, out_col)


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, id_col, text_col, **kw)
    scored = add_score(pick(docs, doc_id=id_col, text=text_col), model)
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Documents that are not rejected, all columns as they were."""
    names = docs.columns
    scored = add_score(docs, train(docs, labels, id_col, text_col, **kw), text_col)
    return scored.toDF(*[f"__c{i}" for i in range(len(names))], "__score").filter(F.col("__score") >= THRESHOLD).drop(
        "__score"
    ).toDF(*names)
