"""Importance resampling, sharding and whitening against plain Python."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evseq.llm import importance, sharding, whitening
from tests.llm import brute
from tests.llm.conftest import COLUMNS, prose

bag = collections.Counter


# ------------------------------------------------------------ 11 importance resampling


@pytest.mark.parametrize("piece", [importance.PIECE_BYTES, 40])
def test_features_of_pieces(monkeypatch, piece):
    monkeypatch.setattr(importance, "PIECE_BYTES", piece)  # 40: pairs reach over the cuts
    text = "  One-two THREE é3\n\n" + prose(9, 300) + " 中文 end "
    got = [c for _, crcs in importance.word_features(text) for c in crcs]
    words = brute.re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(brute.UPPER))
    want = [zlib.crc32(f.encode()) for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]
    assert bag(got) == bag(want) and sum(n for n, _ in importance.word_features(text)) == len(words)
    assert list(importance.word_features(None)) == list(importance.word_features(" .\n")) == []


def test_resample_edges(docs, rows, items):
    got = importance.resample(docs, items[1], percent=60).collect()
    want = brute.importance(rows, items[0], percent=60)
    assert bag(tuple(r)[:1] + tuple(r)[2:5] for r in got) == bag(w[:4] for w in want)
    # rows equal in id share a score; between them the text decides
    assert sorted(r["rank"] for r in got if r["rank"]) == sorted(w[4] for w in want if w[4])
    by_rank = {w[4]: w[:4] for w in want if w[4]}
    assert all((r.doc_id, r.n_features, r.weight, r.score) == by_rank[r["rank"]] for r in got if r["rank"])


@pytest.mark.parametrize("pivots", [1, 2, 16])
def test_quickselect(spark, pivots):
    rng = np.random.default_rng(3)
    keys = [(int(rng.integers(0, 4)), False, int(rng.integers(0, 3)), 0, i) for i in range(90)]
    keys += [(1, True, None, 5, 100 + i) for i in range(40)]  # a group of ties of a third of all rows
    df = spark.createDataFrame(keys, "down long, no_id boolean, doc_id long, tie long, row long").repartition(5).cache()
    order = sorted(keys, key=lambda x: (x[0], x[1], x[2] or 0, x[3], x[4]))
    for k in (1, 2, 64, 77, 129, 130):
        assert tuple(importance.kth_key(df, k, seed=1, pivots=pivots)) == order[k - 1]
    df.unpersist()


def test_ties_of_one_id(spark, items):
    """Equal rows of a third of the table: ranks are gapless and exact in number."""
    text = prose(5, 30)
    found = [(i, prose(100 + i, 30)) for i in range(20)] + [(None, text)] * 10
    got = importance.resample(spark.createDataFrame(found, "doc_id long, text string"), items[1], percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 16))
    want = brute.importance(found, items[0], percent=50)
    assert bag((r.doc_id, r["rank"] is not None) for r in got) == bag((w[0], w[4] is not None) for w in want)


def test_resample_nothing(spark, docs, empty, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(empty, items[1]).count() == 0
    assert importance.resample(docs, none).count() == docs.count()  # gains are smoothed, none is infinite
    few = importance.resample(docs, items[1], min_words=10**9)
    assert few.filter("rank is not null").count() == 0 and few.count() == docs.count()


# ------------------------------------------------------------ 12 sharding


def brute_shards(rows, seed, n_shards):
    """Positions by shard, all of one bucket: rows are (hash, row)."""
    ordered = [r for _, r in sorted(rows, key=lambda x: x[0])]
    shuffled = [ordered[i] for i in sharding.fisher_yates(len(rows), np.random.default_rng([seed, 0]))]
    q, more = divmod(len(rows), n_shards)
    out, at = [], 0
    for shard in range(n_shards):
        size = q + (shard < more)
        out += [(r, shard, slot) for slot, r in enumerate(shuffled[at : at + size])]
        at += size
    return out


def test_fisher_yates():
    seen = bag(tuple(sharding.fisher_yates(3, np.random.default_rng([1, i]))) for i in range(6000))
    assert len(seen) == 6 and all(800 < n < 1200 for n in seen.values())
    assert sharding.fisher_yates(0, np.random.default_rng(1)) == [] and sharding.fisher_yates(1, np.random.default_rng(1)) == [0]


def test_shuffle_in_one_bucket(spark):
    found = [(i, prose(i, 5 + i % 7)) for i in range(50)]
    df = spark.createDataFrame(found, "doc_id long, text string")
    h = df.select("doc_id", F.xxhash64(F.lit(3), "doc_id", "text", F.col("text").isNull()).alias("h")).collect()
    want = brute_shards([(r.h, r.doc_id) for r in h], 3, 8)
    got = sharding.shuffle_into_shards(df, seed=3)
    assert sorted((r.doc_id, r.shard, r.slot) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("bucket_bytes, n_shards", [(300, 8), (5_000, 3), (1 << 30, 40)])
def test_shards_hold_every_row(docs, bucket_bytes, n_shards):
    got = sharding.shuffle_into_shards(docs, n_shards=n_shards, bucket_bytes=bucket_bytes)
    assert got.columns == [*docs.columns, "shard", "slot"]
    rows = got.collect()
    assert bag(tuple(r)[:-2] for r in rows) == bag(map(tuple, docs.collect()))
    by_shard = collections.defaultdict(list)
    for r in rows:
        by_shard[r[-2]].append(r[-1])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    n = len(rows)
    assert [len(by_shard[i]) for i in range(n_shards)] == [n // n_shards + (i < n % n_shards) for i in range(n_shards)]


def test_shuffle_depends_on_seed_and_rows_only(spark):
    found = [(i, prose(i, 20)) for i in range(200)]
    df = spark.createDataFrame(found, "doc_id long, text string")

    def order(df, seed):
        got = sharding.shuffle_into_shards(df, seed=seed, bucket_bytes=2_000).collect()
        return [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]

    first = order(df.repartition(3), 1)
    assert first == order(df.repartition(7, "text"), 1) != order(df, 2)
    assert first != sorted(first)


def test_repeated_rows_spread_over_buckets(spark):
    df = spark.createDataFrame([(1, "same text")] * 400 + [(i, prose(i, 3)) for i in range(2, 102)], "doc_id long, text string")
    scattered = sharding.scatter(df, "doc_id", "text", 5, 2_000)
    most = scattered.groupBy("__bucket").count().agg(F.max("count"), F.count("*")).first()
    assert most[1] > 10 and most[0] < 100


def test_sharding_nothing(empty):
    got = sharding.shuffle_into_shards(empty)
    assert got.count() == 0 and got.columns == [*empty.columns, "shard", "slot"]


def test_order_of_levels(docs, monkeypatch):
    whole = sharding.shuffle_into_shards(docs, bucket_bytes=300)
    monkeypatch.setattr(sharding, "LEVEL", 3)
    monkeypatch.setattr(sharding, "BROADCAST_BUCKETS", 0)
    parts = sharding.shuffle_into_shards(docs, bucket_bytes=300)
    assert bag(map(tuple, whole.collect())) == bag(map(tuple, parts.collect()))


# ------------------------------------------------------------ 13 whitening

VECTORS = "vec_id long, embedding array<float>, EMBEDDING string, component int, n string"


def vector_rows(n, d, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((n, d)) @ rng.standard_normal((d, d)) * spread).astype(np.float32)
    return [(i, [float(c) for c in v], "clash", 5, "n") for i, v in enumerate(x)]


@pytest.mark.parametrize("n, d, spread", [(300, 12, 0.3), (300, 5, 1.0), (40, 3, 1e9)])
def test_whitening(spark, n, d, spread):
    rows = vector_rows(n, d, spread=spread)
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(4)).collect()
    n, deviation, z, values, trace = brute.whitening([r[1] for r in rows])
    k = min(d, 8)
    assert len(got) == n * k and {r.component for r in got} == set(range(1, k + 1))
    assert all(int(r.deviation) == deviation[r.vec_id] and r.n == n for r in got)
    for c in range(k):
        own = np.array([r.whitened for r in sorted((r for r in got if r.component == c + 1), key=lambda r: r.vec_id)])
        sign = np.sign(own @ z[:, c])
        np.testing.assert_allclose(own * sign, z[:, c], rtol=1e-6, atol=1e-7)
        share = {r.explained for r in got if r.component == c + 1}
        assert len(share) == 1 and math.isclose(share.pop(), values[c] / trace, rel_tol=1e-9)
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() < 1e-9


def test_pair_squares_are_exact():
    rng = np.random.default_rng(2)
    y = rng.integers(-9, 9, (50, 4))
    big = y * 10**12
    want = [sum(int(r[i] + (r[j] if j != i else 0)) ** 2 for r in y) for i in range(4) for j in range(i, 4)]
    assert whitening.squares(y).tolist() == want
    assert whitening.squares(big.astype(object)).tolist() == [w * 10**24 for w in want]


def test_vectors_that_do_not_count(spark):
    rows = vector_rows(60, 4)
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [1.0, float("nan"), 0.0, 0.0]), (103, [float("-inf")] * 4), (104, []), (105, [1.0])]
    more = [(None, rows[0][1], "x", 1, "n"), rows[1]]  # without an id, repeated
    df = spark.createDataFrame(rows + [(i, v, "x", 1, "n") for i, v in bad] + more, VECTORS)
    got = whitening.whiten(df).collect()
    n, deviation, *_ = brute.whitening([r[1] for r in rows] + [r[1] for r in more])
    assert len(got) == 62 * 4 and {r.n for r in got} == {62}
    assert bag(int(r.deviation) for r in got if r.component == 1) == bag(deviation)
    assert sum(r.vec_id is None for r in got) == 4 and sum(r.vec_id == 1 for r in got) == 8


def test_components_without_variance(spark):
    rows = [(i, [float(i), 1.0, float(i)], "x", 1, "n") for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert [r.whitened is None for r in sorted(got, key=lambda r: (r.vec_id, r.component))[:3]] == [False, True, True]
    assert all(r.identity_error < 1e-9 for r in got)
    one = whitening.whiten(spark.createDataFrame(rows[:1], VECTORS)).collect()
    assert all(r.whitened is None and r.identity_error is None and r.deviation == 0 for r in one) and len(one) == 3


def test_whitening_nothing(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, "x", 1, "n"), (2, [], "x", 1, "n")], VECTORS)).count() == 0
    with pytest.raises(Exception, match="does not fit"):
        list(whitening.integers(pa.RecordBatch.from_arrays([pa.array([1]), pa.array([[1e30]])], ["vec_id", "v"]), 1))


def test_no_table_named_like_the_columns(spark):
    """All names the operators use inside may be columns of the table."""
    names = COLUMNS + ", down long, row long, rank long, n long, shard int"
    rows = [(i, prose(i, 25), "x", 0.1, 3, True, "s", 1, 2, 3, 4, 5) for i in range(12)]
    df = spark.createDataFrame(rows, names)
    items = spark.createDataFrame([(1, prose(3, 20))], "item_id long, text string")
    assert importance.resample(df, items).count() == 12
    assert sharding.shuffle_into_shards(df).columns == [*df.columns, "shard", "slot"]
