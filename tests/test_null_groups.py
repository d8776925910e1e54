"""A null group key is a group like any other, whatever the block size, the
partition count or the path."""

import pytest
from pyspark.sql import functions as F

from evseq.operators import encode as E
from evseq.operators import features as W
from evseq.operators import model as L
from evseq.operators import sequences as Q

FORMS = [("direct", {}), ("halo", {"block_rows": 1_000_000}), ("halo", {"block_rows": 3, "n_partitions": 1}), ("halo", {"block_rows": 5, "n_partitions": 4}), ("halo", {"block_rows": 1, "n_partitions": 7})]


@pytest.fixture(scope="module")
def df(spark):
    data = [(g, i, f"v{i % 5}" if i % 4 else None, float(i)) for g in ("a", None, "b") for i in range(12)]
    return spark.createDataFrame(data, "g string, o int, v string, x double").repartition(3)


def bag(out, *cols):
    return sorted((tuple(r[c] for c in cols) for r in out.collect()), key=repr)


@pytest.mark.parametrize("strategy,kw", FORMS)
def test_windows_and_fills(df, strategy, kw):
    per_group = {i: (f"v{i % 5}" if i % 4 else None) for i in range(12)}
    back = bag(W.fill_backward(df, "v", "f", ["o"], ["g"], strategy=strategy, **kw), "g", "o", "f")
    before = bag(W.last_value_before(df, "v", "f", ["o"], ["g"], strategy=strategy, **kw), "g", "o", "f")
    ahead = bag(W.lead(df, "x", "n", ["o"], ["g"], strategy=strategy, **kw), "g", "o", "n")
    means = bag(W.rolling_mean(df, ["x"], 3, ["o"], ["g"], strategy=strategy, **kw), "g", "o", "x_rolling_mean")
    for g in ("a", None, "b"):
        assert [f for k, o, f in sorted(back, key=lambda t: t[1]) if k == g] == [
            next((per_group[j] for j in range(i, 12) if per_group[j]), None) for i in range(12)
        ]
        assert [f for k, o, f in sorted(before, key=lambda t: t[1]) if k == g] == [
            next((per_group[j] for j in range(i - 1, -1, -1) if per_group[j]), None) for i in range(12)
        ]
        assert [n for k, o, n in sorted(ahead, key=lambda t: t[1]) if k == g] == [*map(float, range(1, 12)), None]
        assert [m for k, o, m in sorted(means, key=lambda t: t[1]) if k == g] == [
            sum(range(max(0, i - 2), i + 1)) / min(3, i + 1) for i in range(12)
        ]


@pytest.mark.parametrize("strategy", ["direct", "halo"])
def test_splits(df, strategy):
    out = bag(Q.chronological_split(df, ["o"], ["g"], strategy=strategy), "g", "o", "split")
    games = df.withColumn("game", F.col("o"))
    table = bag(Q.game_split_table(games, "game", ["o"], ["g"], strategy=strategy), "g", "game", "split")
    rows = Q.rows_with_split(games, Q.game_split_table(games, "game", ["o"], ["g"], strategy=strategy), "game", ["g"])
    assert rows.count() == 36
    for g in ("a", None, "b"):
        assert [s for k, _, s in sorted(out, key=lambda t: t[1]) if k == g] == ["train"] * 8 + ["val"] * 2 + ["test"] * 2
        assert [s for k, _, s in sorted(table, key=lambda t: t[1]) if k == g] == ["train"] * 9 + ["val"] + ["test"] * 2


@pytest.mark.parametrize("strategy", ["direct", "halo"])
def test_code_maps(df, strategy):
    codes = bag(E.sorted_code_map(df, "v", ["g"], "c", strategy=strategy), "g", "v", "c")
    seen = bag(E.first_seen_code_map(df, "v", ["o"], ["g"], "c", strategy=strategy), "g", "v", "c")
    for g in ("a", None, "b"):
        assert [(v, c) for k, v, c in codes if k == g] == [(f"v{i}", i) for i in range(5)]
        assert sorted((c, v) for k, v, c in seen if k == g) == [(0, "v1"), (1, "v2"), (2, "v3"), (3, "v0"), (4, "v4")]


def test_rows_get_codes_weights_and_merges(spark, df):
    assert E.sorted_code(df, "v", "c", ["g"]).filter("v is not null and c is null").count() == 0
    assert E.first_seen_code(df, "v", ["o"], "c", ["g"]).filter("v is not null and c is null").count() == 0
    coded, mapping = E.label_codes(df, "v", ["g"], "c")
    assert coded.filter("v is not null and c is null").count() == 0 and mapping.filter("g is null").count() == 5
    rare = spark.createDataFrame([(g, "z" if i == 0 else "w") for g in ("a", None) for i in range(41)], "g string, v string")
    merged = E.merge_rare(rare, "v", 0.03, "<", ["g"])
    assert bag(merged.groupBy("g", "v").count(), "g", "v", "count") == bag(
        spark.createDataFrame([(g, v, n) for g in ("a", None) for v, n in (("other", 1), ("w", 40))], "g string, v string, count long"), "g", "v", "count"
    )
    weighted = L.sample_weights(df, df, "v", ["g"])
    assert weighted.filter("v is not null and weight is null").count() == 0


def test_lookups(spark):
    """Strict and inverse lookups find the map of the null group."""
    from evseq.operators import joins as J

    rows = spark.createDataFrame([(1, "a", "x"), (2, None, "x"), (3, None, None)], "id int, g string, v string")
    codes = spark.createDataFrame([("a", "x", 5), (None, "x", 7)], "g string, v string, code int")
    got = J.strict_lookup(rows, codes, ["g", "v"], "code", "out", "v")
    assert bag(got, "id", "out") == [(1, 5), (2, 7), (3, None)]
    asked = spark.createDataFrame([("a", 5), (None, 7), (None, 8)], "g string, code int")
    names = J.inverse_lookup(asked, codes, ["g", "code"], "v", "name", "code")
    assert bag(names, "g", "code", "name") == sorted([("a", 5, "x"), (None, 7, "x"), (None, 8, "Unknown-8")], key=repr)
