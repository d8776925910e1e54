"""Cross-checks of the rows-only model queries against other operators."""

import math
import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def test_grid_search_matches_direct_log_loss(spark):
    from evseq.operators import model as L
    from evseq.plans import catalog as C

    grid = {(r["k"], r["alpha"]): r for r in C.QUERIES["L7_grid_search"](spark, SF).collect()}
    assert set(grid) == {(1, 0.5), (1, 1.0), (2, 0.5), (2, 1.0)}
    assert sum(1 for r in grid.values() if r["best"]) == 1
    best = min(grid.values(), key=lambda r: (r["val_log_loss"], r["k"], r["alpha"]))
    assert best["best"]
    sc, _ = C._scored(spark, SF, reused=False)  # order 2, alpha 1
    direct = L.log_loss(sc.filter(F.col("split") == "val")).collect()[0][0]
    assert math.isclose(grid[(2, 1.0)]["val_log_loss"], round(direct, 6), abs_tol=1e-6)


def test_logistic_regression_scores_every_test_window(spark):
    from evseq.plans import catalog as C

    out = C.QUERIES["L2_logistic_regression"](spark, SF)
    rows = out.collect()
    windows = C._lr_inputs(spark, SF).filter(F.col("split") == "test").count()
    assert len(rows) == windows > 0
    n_labels = C._lr_inputs(spark, SF).select("y").distinct().count()
    assert all(0 <= r["pred"] < n_labels for r in rows)


def test_logistic_regression_has_converged(spark):
    from evseq.operators import model as L
    from evseq.plans import catalog as C

    data = C._lr_inputs(spark, SF)
    model = C._lr_fit(data)
    history = list(model.summary.objectiveHistory)
    assert history == sorted(history, reverse=True) and history[-2] - history[-1] < 1e-4 * history[0]
    scored = L.score_logistic(model, data.filter(F.col("split") == "train"), "features")
    train = data.filter(F.col("split") == "train")
    scored = L.sample_weights(scored, train, "y", [], "weight")
    n = data.select("y").distinct().count()
    row = scored.select(
        F.max(F.abs(F.aggregate("p", F.lit(0.0), lambda a, x: a + x) - 1)).alias("sum_error"),
        (F.sum(F.col("weight") * -F.log(F.element_at("p", F.col("y").cast("int") + 1))) / F.sum("weight")).alias("loss"),
    ).first()
    # the classes weigh the same, so a constant predictor's best loss is log(n)
    assert row["sum_error"] < 1e-6 and row["loss"] < math.log(n)
    stored = [r["loss"] for r in C.QUERIES["S8_training_history"](spark, SF).orderBy("epoch").collect()]
    assert len(stored) > 2 and stored == sorted(stored, reverse=True)
