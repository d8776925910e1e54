"""Properties of the workflow on the driver's tables (test strategy of SURVEY section 5)."""

import math
import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def test_game_splits_disjoint_and_complete(spark):
    from evseq.plans import catalog as C

    t, _ = C._target(spark, SF)
    games = t.select("player_name", "game_pk").distinct()
    splits = C.QUERIES["Q6_game_split"](spark, SF)
    assert splits.count() == games.count()  # every game once
    assert splits.select("player_name", "game_pk").distinct().count() == splits.count()
    assert games.join(splits, ["player_name", "game_pk"], "left_anti").count() == 0
    rows = C._split(spark, SF)[0]
    assert rows.count() == t.count()  # no row lost or duplicated by the split join


def test_chronological_split_complete_and_ordered(spark):
    from evseq.plans import catalog as C

    out = C.QUERIES["Q5_chronological_split"](spark, SF)
    t, _ = C._target(spark, SF)
    assert out.count() == t.count()
    # per entity: every train row comes before every val row, val before test
    ordered = out.join(t.select("event_id", "game_date", "at_bat_number", "pitch_number"), "event_id")
    rank = F.when(F.col("split") == "train", 0).when(F.col("split") == "val", 1).otherwise(2)
    bounds = ordered.groupBy("player_name", rank.alias("r")).agg(
        F.min(F.struct("game_date", "at_bat_number", "pitch_number")).alias("lo"),
        F.max(F.struct("game_date", "at_bat_number", "pitch_number")).alias("hi"),
    ).collect()
    by = {}
    for b in bounds:
        by.setdefault(b["player_name"], {})[b["r"]] = (tuple(b["lo"]), tuple(b["hi"]))
    for parts in by.values():
        keys = sorted(parts)
        for a, b in zip(keys, keys[1:]):
            assert parts[a][1] < parts[b][0]


def test_class_weights_sum_to_rows(spark):
    from evseq.operators import model as L
    from evseq.plans import catalog as C

    s, _ = C._split(spark, SF)
    tr = s.filter(F.col("split") == "train")
    w = L.sample_weights(tr, tr, "next_pitch_type_code", ["player_name"])
    per = w.groupBy("player_name").agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n")).collect()
    for r in per:
        assert math.isclose(r["w"], r["n"], rel_tol=1e-9)


def test_label_codes_invertible(spark):
    from evseq.plans import catalog as C

    coded, mapping = C._coded(spark, SF)
    m = mapping.collect()
    by_code = {(r["player_name"], r["pitch_type_code"]): r["name"] for r in m}
    by_name = {(r["player_name"], r["name"]): r["pitch_type_code"] for r in m}
    assert len(by_code) == len(by_name) == len(m)
    # codes are 0..C-1 per entity
    for ent in {k[0] for k in by_code}:
        codes = sorted(c for e, c in by_code if e == ent)
        assert codes == list(range(len(codes)))
    # every coded row decodes to its own label
    pairs = coded.select("player_name", "pitch_type", "pitch_type_code").distinct().collect()
    assert all(by_code[(r["player_name"], r["pitch_type_code"])] == r["pitch_type"] for r in pairs)
