"""Context tree, block shuffle, padded batches and the incremental store."""

import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from evseq.operators import context_tree as CT
from evseq.operators import model as L
from evseq.operators import sequences as Q
from evseq.sources import store


# ---------------------------------------------------------------- context tree
def planted_codes():
    """Entity a: the next code follows the last two; b: codes are independent."""
    rng = random.Random(0)
    rows = []
    for g in range(30):
        a, b = [0, 1], []
        for i in range(60):
            a.append((a[-1] + a[-2]) % 3 if rng.random() < 0.9 else rng.randrange(3))
            b.append(rng.randrange(3))
        rows += [("a", g, i, c) for i, c in enumerate(a)] + [(None, g, i, c) for i, c in enumerate(b)]
    return rows


@pytest.fixture(scope="module")
def contexts(spark):
    df = spark.createDataFrame(planted_codes(), "e string, g int, o int, code int")
    led = L.with_contexts(df, "code", 4, ["o"], ["e", "g"], strategy="direct")
    from pyspark.sql import Window

    led = led.withColumn("next", F.lead("code").over(Window.partitionBy("e", "g").orderBy("o")))
    led = led.withColumn("split", F.when(F.col("g") < 24, "train").otherwise("val")).filter("next is not null").cache()
    yield led, spark.createDataFrame([("a", 3), (None, 3)], "e string, n_classes int")
    led.unpersist()


def plain_tree(rows, k, min_gain, min_count, kappa=1.0, n_classes=3):
    """{entity: {context: (total, p, gain)}} grown and pruned by the definition."""
    out = {}
    for e in {r["e"] for r in rows}:
        own = [r for r in rows if r["e"] == e and r["split"] == "train"]
        counts = collections.defaultdict(collections.Counter)
        for r in own:
            for j in range(k + 1):
                if r[f"ctx_{j}"] is not None:
                    counts[r[f"ctx_{j}"]][r["next"]] += 1
        tree = {}
        for ctx in sorted(counts, key=lambda c: (c.count(",") + 1 if c else 0)):
            total = sum(counts[ctx].values())
            parent = None if ctx == "" else ctx.rpartition(",")[0]
            if parent is not None and (parent not in tree or total < min_count):
                continue
            above = [1 / n_classes] * n_classes if parent is None else tree[parent][1]
            p = [(counts[ctx][c] + kappa * above[c]) / (total + kappa) for c in range(n_classes)]
            gain = None if parent is None else sum(n * math.log(p[c] / above[c]) for c, n in counts[ctx].items())
            tree[ctx] = (total, p, gain)
        good = {c for c, (_, _, gain) in tree.items() if gain is None or gain >= min_gain}
        stays = {c for c in tree if c in good or any(d.startswith(c + ",") for d in good if c)}
        out[e] = {c: tree[c] for c in stays}
    return out


@pytest.mark.parametrize("k, min_gain, min_count", [(2, 1.0, 1), (4, 4.0, 8)])
def test_tree_by_definition(contexts, k, min_gain, min_count):
    led, classes = contexts
    got = CT.fit_context_tree(led, classes, ["e"], "next", k, min_gain, min_count=min_count, train=F.col("split") == "train").collect()
    want = plain_tree(led.collect(), k, min_gain, min_count)
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        total, p, gain = want[r.e][r.context]
        assert r.total == total and r.order == (r.context.count(",") + 1 if r.context else 0)
        assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(r.p, p))
        assert (r.gain is None and gain is None) or math.isclose(r.gain, gain, rel_tol=1e-9)


def test_tree_is_smaller_and_no_worse_than_the_full_model(contexts):
    led, classes = contexts
    train = F.col("split") == "train"
    tree = CT.fit_context_tree(led, classes, ["e"], "next", 4, 4.0, min_count=8, train=train)
    counts = L.fit_transition_counts(led, ["e"], "next", 4, train)
    full = L.transition_table(counts, classes, ["e"], 1.0)
    assert tree.count() < full.count() / 4
    val = led.filter("split = 'val'")

    def loss(model):
        scored = L.score_transitions(val, model, classes, ["e"], 4, 1.0).withColumn("y", F.col("next"))
        return L.log_loss(scored).first()[0]

    assert loss(tree.drop("gain")) <= loss(full)


def test_tree_of_nothing(contexts):
    led, classes = contexts
    assert CT.fit_context_tree(led.limit(0), classes, ["e"], "next", 2, 1.0).count() == 0


# ---------------------------------------------------------------- block shuffle
@pytest.mark.parametrize("block_rows, parts", [(7, 1), (50, 4), (1000, 3)])
def test_block_shuffle_is_a_permutation(spark, block_rows, parts):
    df = spark.range(200).withColumnRenamed("id", "k").repartition(parts)
    seen = []
    for seed, epoch in ((1, 0), (1, 1), (2, 0)):
        got = [(r.block, r.slot, r.k) for r in Q.block_shuffle(df, ["k"], epoch, seed, block_rows).collect()]
        assert sorted(k for _, _, k in got) == list(range(200))
        sizes = collections.Counter(b for b, _, _ in got)
        assert {(b, s) for b, s, _ in got} == {(b, s) for b, n in sizes.items() for s in range(n)}
        assert max(sizes.values()) <= 3 * block_rows + 10
        seen.append([k for *_, k in sorted(got)])
    assert len({tuple(s) for s in seen}) == 3 and all(s != sorted(s) for s in seen)
    again = Q.block_shuffle(df.repartition(parts + 2, "k"), ["k"], 0, 1, block_rows).collect()
    assert [r.k for r in sorted(again, key=lambda r: (r.block, r.slot))] == seen[0]


def test_block_shuffle_has_no_range_exchange(spark):
    plan = Q.block_shuffle(spark.range(50), ["id"], block_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and len(re.findall(r"hashpartitioning\(block", plan)) == 1


# ---------------------------------------------------------------- padded windows and batches
def test_padded_windows(spark):
    rows = [(g, i, float(10 * i), i if i != 2 else None) for g, n in (("a", 7), (None, 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, o int, v double, y int").repartition(3)
    got = Q.padded_windows(df, ["v"], "y", 5, ["o"], ["g"], buckets=(2, 9, 0), block_rows=3)
    found = {(r.g, r.o): (tuple(s and s.v for s in r.x), tuple(r["mask"]), r.bucket, r.y) for r in got.collect()}
    assert set(found) == {(g, o) for g, o, _, y in rows if y is not None}
    assert found["a", 0] == ((None, 0.0), (0, 1), 2, 0) and found[None, 1] == ((0.0, 10.0), (1, 1), 2, 1)
    assert found["a", 3] == ((None, 0.0, 10.0, 20.0, 30.0), (0, 1, 1, 1, 1), 5, 3)
    assert found["a", 6] == ((20.0, 30.0, 40.0, 50.0, 60.0), (1,) * 5, 5, 6)


@pytest.mark.parametrize("batch_rows", [1, 4, 100])
def test_batches_do_not_cross_groups(spark, batch_rows):
    rows = [(s, i) for s, n in (("train", 21), ("val", 8), (None, 5)) for i in range(n)]
    got = Q.mini_batches(spark.createDataFrame(rows, "s string, o int").repartition(4), ["s"], ["o"], batch_rows).collect()
    assert {(r.s, r.o): (r.batch, r.slot) for r in got} == {(s, o): divmod(o, batch_rows) for s, o in rows}


# ---------------------------------------------------------------- incremental store
@pytest.fixture
def days(spark):
    rows = [(f"e{i % 3}", i % 4, i, f"2024-01-0{1 + i % 5}") for i in range(200)]
    return spark.createDataFrame(rows, "e string, game int, o int, day string")


def bag(df):
    return sorted((r.e, r.game, r.o, r.day) for r in df.select("e", "game", "o", "day").collect())


def test_store_replaces_the_days_it_is_given(spark, days, tmp_path):
    store.create_store(days, "store_days", str(tmp_path / "s"), "day", ["e", "game"], ["o"], n_buckets=4)
    try:
        assert store.read_store(spark, "store_days").count() == 0
        store.load_days(days.filter("day < '2024-01-04'"), "store_days")
        store.load_days(days.filter("day >= '2024-01-04'"), "store_days")
        assert bag(store.read_store(spark, "store_days")) == bag(days)
        store.load_days(days.filter("day = '2024-01-02'"), "store_days")  # once more
        assert bag(store.read_store(spark, "store_days")) == bag(days)
        late = days.filter("day = '2024-01-02' and o > 100")  # a corrected day
        store.load_days(late, "store_days")
        assert bag(store.read_store(spark, "store_days")) == bag(days.filter("day <> '2024-01-02' or o > 100"))
        assert spark.conf.get(store.OVERWRITE).lower() == "static"
    finally:
        spark.sql("drop table store_days")


def test_windows_on_the_store_need_no_exchange(spark, days, tmp_path):
    store.create_store(days, "store_windows", str(tmp_path / "s"), "day", ["e", "game"], ["o"], n_buckets=4)
    try:
        store.load_days(days, "store_windows")
        kept = store.read_store(spark, "store_windows")
        w = Q.sliding_windows(kept, ["o"], "o", 3, ["o"], ["e", "game"], strategy="direct")
        plan = w._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        want = Q.sliding_windows(days, ["o"], "o", 3, ["o"], ["e", "game"], strategy="direct")
        assert sorted((r.e, r.game, r.y) for r in w.collect()) == sorted((r.e, r.game, r.y) for r in want.collect())
    finally:
        spark.sql("drop table store_windows")
