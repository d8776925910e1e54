"""Operator 11: importance resampling towards a target distribution.

Features are the hashed words and word pairs of a text.  The log ratio of a
bucket's smoothed share in the target and in the corpus is its gain, an array
of ``buckets`` numbers; a document's weight is the floored mean gain of its
features, looked up in that array.  Gumbel noise, drawn from the id's hash,
turns "the highest scores" into a weighted sample without replacement.

1. Both tables are counted by streaming passes that send at most ``buckets``
   sums a task; the gains (``buckets`` numbers) are sent back to the tasks.
2. A second pass over the documents writes a narrow row for each.
3. A distributed quickselect finds the k-th composite key: some random pivot
   keys, one aggregate of exact three-way counts (below, equal, above) for
   them, and the range around k is kept, until a pivot is the k-th key.  Only
   pivots and counts reach the driver.
4. Only the winners are sorted, over many tasks, and ranked.

The composite key is (score downwards, id, text hash, row).  The row number is
fixed in the written rows, so keys are unique and ties of any number are split
exactly.

Defined cases: a null or wordless text has no features and weight 0; a null id
hashes as the empty text and comes after all ids in ties; rows that repeat are
documents of their own (equal ids have equal noise); an empty target is
smoothed like any other; no eligible document or an empty table draws nothing;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from evseq.llm.common import pick, small, written
from evseq.llm.decontaminate import _TO_WORDS
from evseq.operators.ordered import GPOS, with_global_position

BUCKETS = 10_000
SEED = 7
MIN_WORDS = 20
PERCENT = 25
PIVOTS = 16  # pivot keys counted in one pass
PIECE_BYTES = 1 << 20  # text turned into a word list at once
KEY = ["down", "no_id", "doc_id", "tie", "row"]


def word_features(text: str | None) -> Iterator[tuple[int, list[int]]]:
    """(words, crc32 of every word and word pair), in pieces of a whole text."""
    raw = (text or "").encode().translate(_TO_WORDS)
    before: int | None = None  # crc32 of the word ahead of the piece
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE_BYTES) if len(raw) - at > PIECE_BYTES else -1
        end = len(raw) if end < 0 else end
        words = raw[at:end].split()
        at = end
        if not words:
            continue
        single = list(map(crc32, words))
        # crc32 goes on from the crc32 of the word before
        second = [b" " + w for w in words]
        pairs = list(map(crc32, second[1:], single))
        if before is not None:
            pairs.append(crc32(second[0], before))
        before = single[-1]
        yield len(words), single + pairs


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket; empty buckets have no row."""

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in small(batches):
            for text in batch.column(0).to_pylist():
                for _, crcs in word_features(text):
                    total += np.bincount(np.array(crcs, dtype=np.int64) % buckets, minlength=buckets)
        full = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(total[full], pa.int64())], ["bucket", "n"])

    part = pick(docs, text=text_col).mapInArrow(count, "bucket int, n long")
    return part.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str, target_text_col: str, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * log ratio) of the smoothed shares, by bucket."""
    both = []
    for df, col in ((docs, text_col), (target, target_text_col)):
        count = np.zeros(buckets, dtype=object)
        for row in bucket_counts(df, col, buckets).collect():  # at most ``buckets`` rows
            count[row.bucket] = row.n
        both.append(count)
    s, t = both
    all_s, all_t = int(s.sum()), int(t.sum())
    return np.array(
        [
            math.floor(1000 * math.log((int(b) + 1) * (all_s + buckets) / ((int(a) + 1) * (all_t + buckets))))
            for a, b in zip(s, t)
        ],
        dtype=np.int64,
    )


def weighted(
    docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED
) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score and the rest of the composite key."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    base = pick(docs, doc_id=id_col, text=text_col)
    id_type = base.schema["doc_id"].dataType.simpleString()

    def weigh(batches):
        gain = shared.value
        for batch in small(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                n_words = n = total = 0
                for k, crcs in word_features(text):
                    n_words += k
                    n += len(crcs)
                    total += int(gain[np.array(crcs, dtype=np.int64) % len(gain)].sum())
                rows.append((n_words, n, total // n if n else 0))
            numbers = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *numbers], ["doc_id", "tie", "n_words", "n_features", "weight"]
            )

    measured = base.select("doc_id", "text", F.xxhash64("text").alias("tie")).mapInArrow(
        weigh, f"doc_id {id_type}, tie long, n_words long, n_features long, weight long"
    )
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(name, "UTF-8"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    return (
        measured.withColumn("score", F.col("weight") + noise)
        .withColumn("down", -F.col("score"))
        .withColumn("no_id", F.col("doc_id").isNull())
        .withColumn("row", F.monotonically_increasing_id())
    )


def _literal(key: Row, keys: DataFrame) -> Column:
    return F.struct(*[F.lit(key[c]).cast(keys.schema[c].dataType).alias(c) for c in KEY])


def kth_key(keys: DataFrame, k: int, seed: int = SEED, pivots: int = PIVOTS) -> Row:
    """The k-th smallest composite key (1 <= k <= rows), by distributed quickselect.

    Each round picks random pivots between ``low`` and ``high``.  One aggregate
    counts the rows by the number of pivots below them and whether they equal
    the next one, which gives every pivot's exact rank.  The range between the
    two pivots around k goes on.
    """
    key = F.struct(*KEY)  # structs compare field by field, null first
    low = high = None
    below, turn = 0, 0  # rows up to and with ``low``
    while True:
        left = keys
        if low is not None:
            left = left.filter((F.col("down") >= low.down) & (key > _literal(low, keys)))
        if high is not None:
            left = left.filter((F.col("down") <= high.down) & (key < _literal(high, keys)))
        chosen = left.orderBy(F.xxhash64(F.lit(seed), F.lit(turn), "row"), "row").limit(pivots).collect()
        chosen.sort(key=lambda p: (p.down, p.no_id, () if p.no_id else p.doc_id, p.tie, p.row))
        ladder = F.array(*[_literal(p, keys) for p in chosen])
        smaller = F.size(F.filter(ladder, lambda p: p < key))
        equal = F.exists(ladder, lambda p: p == key)
        parts = left.groupBy(smaller.alias("smaller"), equal.alias("equal")).count().collect()
        rank = below
        for i, p in enumerate(chosen):
            rank += sum(x["count"] for x in parts if x.smaller == i and not x.equal) + 1
            if rank == k:
                return p
            if rank > k:
                high = p
                break
            below, low = rank, p
        turn += 1


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight, score, rank.

    Of the N documents with at least ``min_words`` words, the floor(percent *
    N / 100) with the highest scores are drawn and ranked from 1; the rank of
    all others is null.
    """
    gain = gains(docs, target, text_col, target_text_col, buckets)
    rows = written(weighted(docs, gain, id_col, text_col, seed), "importance-scores")
    eligible = rows.filter(F.col("n_words") >= min_words)
    k = percent * eligible.count() // 100
    last = kth_key(eligible.select(*KEY), k, seed, pivots) if k else None
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    within = F.struct(*KEY) <= _literal(last, rows)
    drawn = (F.col("n_words") >= min_words) & (F.col("down") <= last.down) & within
    ranked = with_global_position(rows.filter(drawn), KEY)
    return ranked.select(*out, (F.col(GPOS) + 1).cast("long").alias("rank")).unionByName(
        rows.filter(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    )
