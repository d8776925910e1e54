"""Hand tables for the edge rules (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from evseq.functions import exprs as X
from evseq.operators import aggregates as A
from evseq.operators import columns as P
from evseq.operators import encode as E
from evseq.operators import evaluate as EV
from evseq.operators import features as W
from evseq.operators import filters as FL
from evseq.operators import model as L
from evseq.operators import sequences as Q


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_m1_vs_m2(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, 7)], "id int, on_1b long")
    out = df.select("id", X.flag_nonzero("on_1b").alias("m1"), X.flag_not_null("on_1b").alias("m2")).orderBy("id")
    assert rows(out, "m1") == [(0,), (0,), (1,)]
    assert rows(out, "m2") == [(0,), (1,), (1,)]


def test_m5_boundaries(spark):
    # 'R' is exactly 3 of 100 rows (3 %): kept by '< 0.03'; 'Q' 1 of 100 (1 %): merged by '> 0.01'
    data = [("e", "A")] * 96 + [("e", "R")] * 3 + [("e", "Q")]
    df = spark.createDataFrame(data, "ent string, c string")
    lt = E.merge_rare(df, "c", 0.03, "<", by=["ent"])
    assert sorted(set(r[0] for r in rows(lt, "c"))) == ["A", "R", "other"]
    gt = E.merge_rare(df, "c", 0.01, ">")
    assert sorted(set(r[0] for r in rows(gt, "c"))) == ["A", "R", "other"]
    assert rows(gt.filter(F.col("c") == "other"), "c") == [("other",)]


def test_m5_nulls(spark):
    df = spark.createDataFrame([("A",), ("A",), (None,)], "c string")
    lt = E.merge_rare(df, "c", 0.5, "<")  # null share 1/3 < 0.5 but null stays null
    assert sorted(rows(lt, "c"), key=str) == [("A",), ("A",), (None,)]
    gt = E.merge_rare(df, "c", 0.5, ">")  # null never 'kept': becomes other
    assert sorted(rows(gt, "c")) == [("A",), ("A",), ("other",)]


def test_recent_years_inclusive(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.datetime(y, 6, 1),) for y in range(2014, 2026)], "d timestamp_ntz")
    out = FL.recent_years(df, "d", 10, year_col="y")
    assert sorted(r[0] for r in rows(out, "y")) == list(range(2015, 2026))


def test_strict_literal_map(spark):
    df = spark.createDataFrame([("R",), ("L",), (None,)], "h string")
    out = df.select(X.strict_map("h", {"R": 0, "L": 1}).alias("c"))
    assert sorted(rows(out, "c"), key=str) == [(0,), (1,), (None,)]
    bad = spark.createDataFrame([("Z",)], "h string").select(X.strict_map("h", {"R": 0, "L": 1}).alias("c"))
    with pytest.raises(Exception):
        bad.collect()


def test_byte_order_codes(spark):
    df = spark.createDataFrame([("SL",), ("FF",), ("other",)], "p string")
    out = E.sorted_code(df, "p", "code")
    assert dict(rows(out, "p", "code")) == {"FF": 0, "SL": 1, "other": 2}


def test_sorted_and_first_seen_codes(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "c")], "o int, v string")
    assert dict(rows(E.sorted_code(df, "v", "code"), "v", "code")) == {"a": 0, "b": 1, "c": 2}
    assert dict(rows(E.first_seen_code(df, "v", ["o"], "code"), "v", "code")) == {"b": 0, "a": 1, "c": 2}


@pytest.mark.parametrize("strategy,block", [("direct", 1_000_000), ("halo", 4), ("halo", 2)])
def test_rolling_mean(spark, strategy, block):
    vals = [1.0, None, 3.0, 4.0, 5.0, 6.0]
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(vals)] + [("h", i, None) for i in range(3)], "g string, o int, x double")
    out = W.rolling_mean(df, ["x"], 5, ["o"], ["g"], strategy=strategy, block_rows=block)
    got = dict(((g, o), m) for g, o, m in rows(out, "g", "o", "x_rolling_mean"))
    exp = [1, 1, 2, 8 / 3, 13 / 4, 18 / 4]
    for i, e in enumerate(exp):
        assert math.isclose(got[("g", i)], e)
    assert all(got[("h", i)] is None for i in range(3))


@pytest.mark.parametrize("strategy,block", [("direct", 1_000_000), ("halo", 1), ("halo", 2), ("halo", 3)])
def test_fills(spark, strategy, block):
    df = spark.createDataFrame([(0, None), (1, "B"), (2, None), (3, "S")], "o int, v string").withColumn("g", F.lit(1))
    bf = W.fill_backward(df, "v", "f", ["o"], ["g"], strategy=strategy, block_rows=block)
    assert [r[0] for r in bf.orderBy("o").select("f").collect()] == ["B", "B", "S", "S"]
    lb = W.last_value_before(df, "v", "f", ["o"], ["g"], strategy=strategy, block_rows=block)
    assert [r[0] for r in lb.orderBy("o").select("f").collect()] == [None, None, "B", "B"]


def test_scalers_constant_column(spark):
    df = spark.createDataFrame([(1.0, "train"), (1.0, "train")], "x double, split string")
    assert rows(W.min_max_scale(df, ["x"]), "x") == [(0.0,), (0.0,)]
    assert rows(W.standard_scale(df, ["x"], F.col("split") == "train"), "x") == [(0.0,), (0.0,)]


def test_min_max_nan_and_null(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in W.min_max_scale(df, ["x"]).collect()]
    assert got[0] == 0.0 and got[1] == 1.0 and math.isnan(got[2]) and got[3] is None


def test_standard_scale_train_only(spark):
    df = spark.createDataFrame([(1.0, "train"), (3.0, "train"), (5.0, "test")], "x double, split string")
    got = dict(rows(W.standard_scale(df, ["x"], F.col("split") == "train", suffix="_z"), "x", "x_z"))
    assert got == {1.0: -1.0, 3.0: 1.0, 5.0: 3.0}  # population std of (1, 3) is 1


def test_null_nan_apart(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 2.0)], "id int, x double")
    x2 = P.fill_null_numeric(df, -1, exclude=["id"]).orderBy("id")
    v = [r[0] for r in x2.select("x").collect()]
    assert v[0] == -1.0 and math.isnan(v[1]) and v[2] == 2.0
    x3 = P.fill_nan_float(df, -1.0).orderBy("id")
    assert [r[0] for r in x3.select("x").collect()] == [None, -1.0, 2.0]
    f2 = FL.drop_nulls(df, ["x"])
    assert sorted(r[0] for r in f2.select("id").collect()) == [2, 3]


def test_weighted_state(spark):
    df = spark.createDataFrame([(1, 1, 0), (0, 0, 1)], "a int, b int, c int")
    out = df.select(X.weighted_sum(["a", "b", "c"], (1, 2, 3)).alias("s3"), X.weighted_sum(["a", "b", "c"], (1, 2, 4)).alias("s4"))
    assert rows(out, "s3", "s4") == [(3, 3), (3, 4)]


@pytest.mark.parametrize("strategy,block", [("direct", 1_000_000), ("halo", 9), ("halo", 16)])
def test_window_counts(spark, strategy, block):
    data = []
    for g, n in (("a", 9), ("b", 10), ("c", 12)):
        data += [(g, i, i * 1.0, i % 3) for i in range(n)]
    df = spark.createDataFrame(data, "g string, o int, x double, y int")
    out = Q.sliding_windows(df, ["x"], "y", 10, ["o"], ["g"], strategy=strategy, block_rows=block)
    counts = dict(out.groupBy("g").count().collect())
    assert counts.get("a", 0) == 0 and counts["b"] == 1 and counts["c"] == 3
    first = out.filter(F.col("g") == "c").orderBy("o").first()
    assert [s["x"] for s in first["x"]] == [float(i) for i in range(10)] and first["y"] == 9 % 3
    dl = Q.sliding_windows(df, ["x"], "y", 10, ["o"], ["g"], drop_last=True, strategy=strategy, block_rows=block)
    counts = dict(dl.groupBy("g").count().collect())
    assert counts.get("a", 0) == 0 and counts.get("b", 0) == 0 and counts["c"] == 2


def test_chronological_split(spark):
    for n, exp in ((10, (7, 1, 2)), (11, (7, 2, 2))):
        df = spark.createDataFrame([(i,) for i in range(n)], "o int")
        for strategy in ("direct", "halo"):
            out = Q.chronological_split(df, ["o"], strategy=strategy)
            c = dict(out.groupBy("split").count().collect())
            assert (c.get("train", 0), c.get("val", 0), c.get("test", 0)) == exp
            # train rows come first
            assert max(r[0] for r in out.filter("split = 'train'").select("o").collect()) == exp[0] - 1


def test_game_split(spark):
    df = spark.createDataFrame([(g, g * 10 + j) for g in range(10) for j in range(3)], "game int, o int")
    s = Q.game_split_table(df, "game", ["o"])
    c = dict(s.groupBy("split").count().collect())
    assert (c["train"], c["val"], c["test"]) == (8, 1, 1)
    assert sorted(r[0] for r in s.filter("split = 'test'").select("game").collect()) == [9]


def test_argmax_and_top2(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.2, 0.4, 0.4, 0.4],)], "p array<double>")
    out = df.select(X.argmax("p").alias("a"), X.top_k_indices("p", 2).alias("t"))
    r = out.collect()
    assert r[0]["a"] == 0 and set(r[0]["t"]) == {0, 1}
    assert r[1]["a"] == 1 and set(r[1]["t"]) == {2, 3}


def test_report_never_predicted(spark):
    scored = spark.createDataFrame([("e", 0, 0), ("e", 1, 0), ("e", 0, 0)], "e string, y int, pred int")
    classes = spark.createDataFrame([("e", 2)], "e string, n_classes int")
    rep = {r["class"]: r for r in EV.per_class_report(scored, classes, ["e"]).collect()}
    assert rep[1]["precision"] == 0.0 and rep[1]["recall"] == 0.0 and rep[1]["f1"] == 0.0 and rep[1]["support"] == 1
    assert math.isclose(rep[0]["precision"], 2 / 3) and rep[0]["recall"] == 1.0
    cm = {(r["true"], r["predicted"]): r["n"] for r in EV.confusion_matrix(scored, classes, ["e"]).collect()}
    assert cm == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    w = dict(rows(A.balanced_class_weights(df, "y"), "y", "weight"))
    assert math.isclose(w[0], 4 / (2 * 3)) and math.isclose(w[1], 4 / (2 * 1))


def test_focal_and_log_loss(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5])], "y int, p array<double>")
    f = L.focal_loss(df).collect()[0][0]
    assert math.isclose(f, 0.25 * 0.25 * math.log(2), rel_tol=1e-6)
    ll = L.log_loss(df).collect()[0][0]
    assert math.isclose(ll, math.log(2), rel_tol=1e-6)


def test_transition_backoff(spark):
    # entity e, classes 0..2; train sequence 0 1 0 1 (next of each row given)
    data = [("e", 1, i, c, n, "train") for i, (c, n) in enumerate([(0, 1), (1, 0), (0, 1), (1, 2)])]
    data += [("e", 2, 0, 2, 0, "test")]  # context "2" never seen in training -> order 0
    df = spark.createDataFrame(data, "e string, g int, o int, code int, nxt int, split string")
    ctx = L.with_contexts(df, "code", 1, ["o"], ["e", "g"], strategy="direct")
    classes = spark.createDataFrame([("e", 3)], "e string, n_classes int")
    counts = L.fit_transition_counts(ctx, ["e"], "nxt", 1, F.col("split") == "train")
    model = L.transition_table(counts, classes, ["e"], 1.0)
    sc = {(r["g"], r["o"]): r for r in L.score_transitions(ctx, model, classes, ["e"], 1, 1.0).collect()}
    # context "0" seen twice, both followed by 1: (0+1, 2+1, 0+1) / (2+3)
    assert sc[(1, 0)]["order_used"] == 1 and [round(x, 6) for x in sc[(1, 0)]["p"]] == [0.2, 0.6, 0.2]
    # unseen context "2": order 0 = all train next codes (1, 0, 1, 2) -> (1+1, 2+1, 1+1) / (4+3)
    assert sc[(2, 0)]["order_used"] == 0 and [round(x, 6) for x in sc[(2, 0)]["p"]] == [round(2 / 7, 6), round(3 / 7, 6), round(2 / 7, 6)]
    assert sc[(2, 0)]["pred"] == 1


def test_flatten_round_trip(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0], [3.0, None]])], "id int, x_num array<array<double>>")
    flat = Q.flatten_windows(df, ["id"], "x_num", ["a", "b"])
    assert sorted(rows(flat, "step", "a", "b")) == [(0, 1.0, 2.0), (1, 3.0, None)]
    back = Q.unflatten_windows(flat, ["id"], ["a", "b"])
    assert back.collect()[0]["x_num"] == [[1.0, 2.0], [3.0, None]]


def test_drop_duplicates_keeps_first(spark):
    df = spark.createDataFrame([("a", 3, "z"), ("a", 1, "x"), ("b", 2, "y")], "k string, o int, v string")
    out = FL.drop_duplicates(df, ["k"], keep_first_by=["o"])
    assert sorted(rows(out, "k", "o", "v")) == [("a", 1, "x"), ("b", 2, "y")]


def test_describe_percentiles(spark):
    df = spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4)] + [(None,)], "x double")
    d = A.describe(df, ["x"]).collect()[0]
    assert d["count"] == 4 and d["null_count"] == 1 and d["q25"] == 1.75 and d["q50"] == 2.5 and d["max"] == 4.0


def test_halo_independent_of_blocks_and_partitions(spark):
    data = [(i % 3, i, float((i * 7) % 11)) for i in range(200)]
    df = spark.createDataFrame(data, "g int, o int, x double")
    ref = sorted(rows(W.rolling_mean(df, ["x"], 5, ["o"], ["g"], strategy="direct"), "g", "o", "x_rolling_mean"))
    for b, n in ((7, 3), (50, 8), (1000, 1)):
        got = sorted(rows(W.rolling_mean(df, ["x"], 5, ["o"], ["g"], strategy="halo", block_rows=b, n_partitions=n), "g", "o", "x_rolling_mean"))
        assert [(g, o) for g, o, _ in got] == [(g, o) for g, o, _ in ref]
        assert all(math.isclose(a[2], b_[2]) for a, b_ in zip(got, ref))
    gl = sorted(rows(W.lead(df, "x", "nx", ["o"], strategy="halo", block_rows=13, n_partitions=5), "o", "nx"))
    assert gl[:-1] == [(i, float(((i + 1) * 7) % 11)) for i in range(199)] and gl[-1] == (199, None)


@pytest.mark.parametrize("n_parts", [1, 3, 11])
def test_distributed_quantiles_equal_builtin(spark, n_parts):
    from evseq.operators.quantiles import exact_quantiles

    # one hot group (2/3 of rows), a small group, a null group, repeated values
    data = [("hot", float((i * 37) % 101)) for i in range(400)] + [("small", float(i % 7)) for i in range(150)]
    data += [(None, float(i)) for i in range(50)] + [("hot", None), ("single", 5.0)]
    df = spark.createDataFrame(data, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, "x", probs, ["g"], n_partitions=n_parts).collect()}
    ref = df.groupBy("g").agg(F.percentile("x", probs).alias("p")).collect()
    for r in ref:
        for q, v in zip(probs, r["p"]):
            assert math.isclose(got[(r["g"], q)], v, rel_tol=1e-12, abs_tol=1e-12), (r["g"], q)


def test_game_split_halo_equals_direct(spark):
    data = [("e" if g % 4 else "f", g, g * 10 + j) for g in range(41) for j in range(2)]
    df = spark.createDataFrame(data, "ent string, game int, o int")
    for by in (["ent"], []):
        a = sorted(rows(Q.game_split_table(df, "game", ["o"], by, strategy="direct"), "game", "split"))
        b = sorted(rows(Q.game_split_table(df, "game", ["o"], by, strategy="halo"), "game", "split"))
        assert a == b


def test_hot_group_spreads_over_partitions(spark):
    from evseq.operators.ordered import GPOS, with_global_position

    # one group holds 90 % of the rows: range partitioning still spreads it
    data = [("hot", i) for i in range(900)] + [(f"g{i % 10}", i) for i in range(100)]
    df = spark.createDataFrame(data, "g string, o int")
    pos = with_global_position(df, ["o"], ["g"], n_partitions=8)
    parts = pos.filter("g = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 4
    got = sorted(rows(pos, "g", "o", GPOS))
    exp = sorted((g, o) for g, o in data)
    assert [(g, o) for g, o, _ in got] == exp and sorted(p for _, _, p in got) == list(range(1000))


@pytest.mark.parametrize("by", [["g"], []])
def test_code_maps_halo_equal_direct(spark, by):
    data = [(f"g{i % 3}", i, f"v{(i * 7) % 23:02d}") for i in range(300)]
    df = spark.createDataFrame(data, "g string, o int, v string")
    for build in (
        lambda s: E.sorted_code_map(df, "v", by, "code", strategy=s),
        lambda s: E.first_seen_code_map(df, "v", ["o"], by, "code", strategy=s),
    ):
        cols = [*by, "v", "code"]
        assert sorted(rows(build("direct"), *cols)) == sorted(rows(build("halo"), *cols))
