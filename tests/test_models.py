"""Model training: summaries, early stopping, passes, extra trees, isotonic calibration, random search."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tessera.operators import calibrate, extra_trees, models

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def xy():
    rng = np.random.RandomState(4)
    x = np.round(rng.randn(300, 5), 2)
    x[:, 3] = 1.0                                             # a constant feature
    x[:120, 4] = 0.0
    y = ((x[:, 0] + 0.5 * x[:, 1] + 0.8 * rng.randn(300)) > 0.3).astype(float)
    return x, y


@pytest.fixture(scope="module")
def frame(spark, xy):
    x, y = xy
    return spark.createDataFrame([(k, Vectors.dense(a), float(b), k % 5) for k, (a, b) in enumerate(zip(x.tolist(), y))], ["id", "features", "label", "fold"]).repartition(3)


@pytest.mark.parametrize("kind", ["logistic", "linear_svc", "random_forest", "bagging", "mlp", "bernoulli_nb", "extra_trees"])
def test_models_score_after_an_observation(spark, frame, kind):
    seen = Observation()
    frame.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 300                                # the session now holds what cannot be written
    small = {"numTrees": 5} if kind in ("random_forest", "bagging", "extra_trees") else {}
    scored = models.fit_and_score(kind, frame, frame, n_features=5, **small)
    assert scored.where("p between 0 and 1").count() == 300


def test_registered_models_do_not_fail(spark):
    import __spark_entry__ as e
    spark.range(3).observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    rows = e.queries()["m10_model_comparison"](spark, SF).collect()
    assert len(rows) == 4 and all(r["error"] is None and r["f1"] is not None for r in rows)
    assert e.queries()["m11_cross_validation"](spark, SF).count() == 4
    assert e.queries()["m16_calibrated_threshold"](spark, SF).count() == 1


def test_comparison_does_not_hide_crashes_of_spark(spark, frame):
    broken = frame.withColumn("features", F.udf(lambda v: 1 // 0, "int")("id").cast("string"))
    with pytest.raises(Exception, match="(?i)zero|type"):
        models.compare_models(["dummy", "logistic"], frame, broken.withColumn("label", F.udf(lambda v: 1 // 0, "int")("id")), n_features=5).collect()


def test_random_search_and_cross_validation(frame):
    got = models.random_search("decision_tree", frame, 3, n_folds=3, grid={"maxDepth": [2, 3], "minInstancesPerNode": [1, 5]}).collect()
    assert len(got) == 3 and sum(r.best for r in got) == 1 and len({r.params for r in got}) == 3
    assert max(got, key=lambda r: r.mean_f1).best
    again = models.random_search("decision_tree", frame, 3, n_folds=3, grid={"maxDepth": [2, 3], "minInstancesPerNode": [1, 5]}).collect()
    assert again == got and "maxDepth" in json.loads(got[0].params)


def test_boosting_stops_when_held_out_loss_stops_falling(frame):
    train, held = frame.where("id % 3 <> 0"), frame.where("id % 3 = 0")
    model, history = models.boosted_with_early_stop(train, held, maxIter=40, maxDepth=4, tol=0.001)
    rows = history.orderBy("trees").collect()
    assert len(rows) == model.getNumTrees < 40 and [r.trees for r in rows] == list(range(1, len(rows) + 1))
    trees, weights = model.trees, model.treeWeights
    x = [r for r in held.select("features", "label").collect()]
    for k, r in enumerate(rows, 1):                            # log loss of margins, from the trees themselves
        margin = np.array([sum(w * t.predict(p.features) for t, w in zip(trees[:k], weights)) for p in x])
        sign = np.array([2 * p.label - 1 for p in x])
        assert np.isclose(r.held_loss, np.mean(2 * np.log1p(np.exp(-2 * sign * margin))))


def test_passes_keep_the_best_and_stop(spark, frame, tmp_path):
    train, held = frame.where("id % 3 <> 0"), frame.where("id % 3 = 0")
    model, history = models.train_in_passes(train, held, str(tmp_path / "passes"), 5, (4,), passes=12, patience=2, steps=3)
    rows = history.orderBy("pass").collect()
    best = [r for r in rows if r.best]
    assert len(best) == 1 and best[0].f1 == max(r.f1 for r in rows)
    assert len(rows) == 12 or len(rows) == best[0]["pass"] + 2
    for r in rows:                                             # F1 of the written scores, by hand
        s = spark.read.parquet(str(tmp_path / f"passes/scores/pass={r['pass']}")).toPandas()
        def f1(t):
            hit = s.p >= t
            return 2 * (hit & (s.label == 1)).sum() / max(1, hit.sum() + (s.label == 1).sum())
        grid = [0.1 + 0.05 * k for k in range(17)]
        assert np.isclose(r.f1, max(f1(t) for t in grid)) and np.isclose(r.f1, f1(r.threshold))
    kept = models.positive_probability(model.transform(held)).select("p").toPandas()["p"].sort_values().to_numpy()
    written = spark.read.parquet(str(tmp_path / f"passes/scores/pass={best[0]['pass']}")).toPandas()["p"].sort_values().to_numpy()
    assert np.allclose(kept, written)


def test_extra_trees_against_brute_force(frame, xy):
    x, y = xy
    est = extra_trees.ExtraTrees(numTrees=4, maxDepth=5, maxFeatures=2, seed=7)
    forest = est.fit(frame).forest
    for t in range(4):
        def grow(node, rows, depth):
            assert np.isclose(forest.p[t, node], y[rows].mean()) and forest.weight[t, node] == len(rows)
            if depth == 5 or len(rows) < 2 or y[rows].min() == y[rows].max():
                assert forest.feature[t, node] == -1
                return
            varied = [f for f in extra_trees.looked_at(7, t, node, 5) if x[rows, f].min() < x[rows, f].max()][:2]
            falls = []
            for f in varied:
                low, high = x[rows, f].min(), x[rows, f].max()
                cut = low + (high - low) * float(extra_trees.unit_draw(8, np.int64(t), np.int64(node), np.array([f]))[0])
                left = x[rows, f] <= cut
                gini = lambda v: len(v) * 2 * v.mean() * (1 - v.mean()) if len(v) else 0.0
                falls.append((round(gini(y[rows]) - gini(y[rows][left]) - gini(y[rows][~left]), 9), f, cut))
            top = max(falls, key=lambda r: r[0])
            assert forest.feature[t, node] in [f for g, f, _ in falls if abs(g - top[0]) < 1e-9]
            f = forest.feature[t, node]
            cut = next(c for _, g, c in falls if g == f)
            assert np.isclose(forest.cut[t, node], cut)
            grow(2 * node + 1, rows[x[rows, f] <= cut], depth + 1)
            grow(2 * node + 2, rows[x[rows, f] > cut], depth + 1)
        grow(0, np.arange(len(y)), 0)
    again = extra_trees.ExtraTrees(numTrees=4, maxDepth=5, maxFeatures=2, seed=7).fit(frame.repartition(7)).forest
    assert (again.feature == forest.feature).all() and np.allclose(again.cut, forest.cut)
    assert len({tuple(f) for f in forest.feature.tolist()}) == 4     # trees differ
    scored = models.positive_probability(extra_trees.ExtraTreesModel(forest, "features").transform(frame)).toPandas().sort_values("id")
    assert np.allclose(scored["p"], forest.score(x)) and ((scored["p"] > 0.5) == (scored["prediction"] > 0)).all()


def test_extra_trees_of_weights_and_nothing(spark, frame, xy):
    doubled = frame.withColumn("w", F.when(F.col("label") == 1, 2.0).otherwise(1.0))
    p = extra_trees.ExtraTrees(weightCol="w", numTrees=1, maxDepth=0).fit(doubled).forest.p[0, 0]
    y = xy[1]
    assert np.isclose(p, 2 * y.sum() / (2 * y.sum() + (1 - y).sum()))
    model = extra_trees.ExtraTrees(numTrees=2).fit(frame.limit(0))
    assert model.forest.p.sum() == 0


def one_list(x, y, w):
    """Pool-adjacent-violators over one list."""
    points = pd.DataFrame({"x": x, "y": np.array(y) * w, "w": w}).groupby("x").sum().reset_index()
    blocks = []
    for r in points.itertuples():
        blocks.append([r.x, r.x, r.w, r.y / r.w])
        while len(blocks) > 1 and blocks[-2][3] >= blocks[-1][3]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([a[0], b[1], a[2] + b[2], (a[2] * a[3] + b[2] * b[3]) / (a[2] + b[2])])
    return blocks


@pytest.mark.parametrize("seed,merge", [(0, 2), (1, 16), (2, 3)])
def test_isotonic_equals_one_list(spark, monkeypatch, seed, merge):
    monkeypatch.setattr(calibrate, "MERGE", merge)
    rng = np.random.RandomState(seed)
    x = np.round(rng.rand(800), 2 if seed else 6)
    y = (rng.rand(800) < x ** 2).astype(float)
    w = rng.randint(1, 4, 800).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y, "w": w})).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = calibrate.fit_isotonic(df, weight="w")
        got = [list(r) for r in blocks.orderBy("low").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert np.allclose(got, one_list(x, y, w))
    probe = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.31, 0.5, 2.0, None)], "x double")
    values = [r.c for r in calibrate.apply_isotonic(probe, blocks, "x", "c").collect()]
    ends = [b[k] for b in got for k in (0, 1)]
    assert values[-1] is None and np.allclose(values[:-1], np.interp([-1.0, 0.0, 0.31, 0.5, 2.0], ends, [b[3] for b in got for _ in (0, 1)]))
    few = calibrate.fit_isotonic(df, weight="w", bins=50).toPandas().sort_values("low")
    assert few["mean"].is_monotonic_increasing and np.isclose(few["weight"].sum(), w.sum())
    assert calibrate.fit_isotonic(df.limit(0)).count() == 0
