"""Candidates of the n-gram join: what is found, what is shipped, what stays on disk."""

import collections
import os

import numpy as np
import pytest

import corpus_pipeline
from evseq.llm import common, ngram_join
from tests.llm import brute
from tests.llm.conftest import prose


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    tops = [str(d) for d in env.blockManager().diskBlockManager().localDirs()]
    return {x for top in tops for _, _, names in os.walk(top) for x in names if x.startswith("shuffle_")}


def test_written_stage_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000).selectExpr("id % 7 as k", "id").groupBy("k").count()
    out = common.written(rows.join(rows.withColumnRenamed("count", "n"), "k"), "freed")
    assert not shuffle_files(spark) - before
    assert out.count() == 7
    assert spark.conf.get(common.FREE_SHUFFLES) == "false"


@pytest.fixture
def passages(spark, monkeypatch):
    """Documents of five passages, each passage in five documents; no two
    documents link.  With them the stages that a run writes."""
    texts = [prose(1000 + i, 24) for i in range(61)]
    rows = [(d, " ".join(texts[(d + k) % 61] for k in (0, 1, 5, 11, 27))) for d in range(61)]
    stages = {}

    def kept(df, name, write=common.written):
        stages[name] = write(df, name)
        return stages[name]

    monkeypatch.setattr(ngram_join, "written", kept)
    return rows, spark.createDataFrame(rows, "doc_id long, text string"), stages


def test_shared_passages_ship_few_texts(passages):
    rows, docs, stages = passages
    got = ngram_join.near_duplicates(docs)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(brute.components(rows))
    assert stages["ngram-texts"].count() <= 30  # all shingles are shared


def test_shared_passages_in_the_pipelines_stage(spark, passages):
    rows, docs, stages = passages
    assert sorted(map(tuple, corpus_pipeline.ngram_stage(spark, docs, "").collect())) == rows
    assert stages["ngram-texts"].count() <= 30


@pytest.mark.parametrize("threshold", [70, 85, 95])
def test_sets_at_the_threshold_have_a_signature_in_common(threshold):
    rng = np.random.default_rng(threshold)
    sets = []
    for n in [*range(1, 50), 150, 333, 767, 768, 2500]:
        for _ in range(10):
            gone = int(rng.integers(0, n * (100 - threshold) // 100 + 1))  # the rest may still link
            more = 100 * (n - gone) // threshold - n
            s = rng.integers(0, 1 << 64, n, dtype=np.uint64)
            sets += [np.unique(s), np.unique(np.concatenate([s[gone:], rng.integers(0, 1 << 64, more, dtype=np.uint64)]))]
    sig, of = ngram_join.signatures(sets, threshold)
    sent = collections.defaultdict(set)
    for x, i in zip(sig.tolist(), of.tolist()):
        sent[i].add(x)
    assert all(sent[i] & sent[i + 1] for i in range(0, len(sets), 2))


def test_tied_rows_keep_their_groups_together():
    sig = np.array([5, 5, 5, 9, 9, 7], np.uint64)
    key = np.array([3, 1, 1, 1, 2, 4], np.int64)
    sig, key = ngram_join.tied(sig, key)
    holders = collections.defaultdict(set)
    for s, k in zip(sig.tolist(), key.tolist()):
        holders[s].add(k)
    assert sorted(map(sorted, holders.values())) == [[1], [1], [1, 2], [1, 3], [4]]
