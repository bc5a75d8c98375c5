import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import neighbours, resample, schema, vectors


def test_duplicate_columns_greedy(spark):
    rows = [(i, float(i), float(i), float(i) + 1e-9, float(i) * 2, float(i) + 0.5) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double")
    out = sorted((r["column"], r["duplicate_of"]) for r in schema.duplicate_columns(df, ["a", "b", "c", "d", "e"]).collect())
    assert out == [("b", "a"), ("c", "a")]


def test_binary_and_align(spark):
    df = spark.createDataFrame([(1, 0, 1.0, None), (2, 1, 0.5, 3)], "id long, b int, x double, z int")
    assert [r[0] for r in schema.binary_columns(df, ["b", "x"]).collect()] == ["b"]
    ref = spark.createDataFrame([], "id long, x double, y int")
    a = schema.align_to(df, ref)
    assert a.columns == ["id", "x", "y"] and a.first()["y"] == 0
    u = schema.union_aligned([df.select("id", "z"), spark.createDataFrame([(3, 9.0)], "id long, w double")])
    assert u.columns == ["id", "w", "z"] and u.where(F.col("id") == 1).first()["w"] == 0.0
    assert u.where(F.col("id") == 1).first()["z"] is None          # existing nulls stay null


def test_complement_and_downcast(spark):
    df = spark.createDataFrame([(1, 1, None)], "id long, is_oa int, v double")
    out = schema.downcast_fill(schema.complement(df, "is_oa"))
    r = out.first()
    assert "is_oa" not in out.columns and r["is_not_oa"] == 0 and r["v"] == 0.0
    assert dict(out.dtypes)["v"] == "float"


def _brute(x, base, k, itself):
    """The k nearest by (distance, index) of each row of ``x``."""
    d = np.sqrt(((x[:, None, :] - base[None, :, :]) ** 2).sum(2))
    if itself:
        np.fill_diagonal(d, np.inf)
    at = np.argsort(d, axis=1, kind="stable")[:, :k]
    return at, np.take_along_axis(d, at, axis=1)


def test_nearest_is_exact():
    rng = np.random.RandomState(0)
    x, base = rng.randn(300, 5), np.round(rng.randn(200, 5), 1)
    at, distance = neighbours.nearest(x, base, 4, block=64)
    want, far = _brute(x, base, 4, False)
    assert (at == want).all() and np.allclose(distance, far)
    assert neighbours.nearest(x, base[:2], 4)[0].shape == (300, 2) and neighbours.nearest(x, base[:0], 4)[0].shape == (300, 0)


def _points(spark, x, y):
    return spark.createDataFrame([(str(i), int(c), [float(v) for v in p]) for i, (p, c) in enumerate(zip(x, y))],
                                 "id string, label int, features array<double>")


def test_tomek_and_enn(spark):
    x = [[0.0], [0.1], [5.0], [5.2], [10.0], [10.05]]
    kept = resample.tomek(_points(spark, x, [0, 1, 0, 0, 1, 1]))
    assert {r["id"] for r in kept.collect()} == {"2", "3", "4", "5"}      # one link: rows 0 and 1
    x2 = [[0.0], [0.1], [0.2], [0.3], [0.15], [9.0], [9.1], [9.2], [9.3]]
    kept2 = {r["id"] for r in resample.enn(_points(spark, x2, [0, 0, 0, 0, 1, 1, 1, 1, 1])).collect()}
    assert "4" not in kept2 and {"5", "6", "7", "8"} <= kept2             # the outlier of class 1 goes


def _clusters(seed, n=900, dims=6):
    """Tight clusters, a third of the rows in one of them, a third of those one vector, and some noise."""
    rng = np.random.RandomState(seed)
    centres = rng.randn(15, dims) * 8
    x = centres[rng.randint(0, 15, n)] + rng.randn(n, dims) * 0.2
    x[: n // 3] = centres[0] + rng.randn(n // 3, dims) * 1e-3
    x[: n // 9] = x[0]
    x[-n // 10:] = rng.randn(n // 10, dims) * 10
    return x


@pytest.mark.parametrize("seed,pivots", [(3, 1024), (4, 7), (5, 1)])
def test_neighbours_are_exact_over_many_cells(spark, seed, pivots):
    x = _clusters(seed)
    df = spark.createDataFrame([(i, 0, True, [float(v) for v in p]) for i, p in enumerate(x)] + [(900, 0, True, None), (901, 0, True, [float("nan")] * 6)],
                               "id long, label int, asks boolean, f array<double>").repartition(5)
    got = neighbours.exact_neighbours(df, 5, True, pivots=pivots, chunk=32).toPandas().sort_values(["id", "rank"], ignore_index=True)
    want, far = _brute(x, x, 5, True)
    assert (got["id"].to_numpy() == np.repeat(np.arange(900), 5)).all() and (got["rank"].to_numpy() == np.tile(np.arange(1, 6), 900)).all()
    assert np.allclose(got["distance"], far.ravel(), atol=1e-12)
    # ties by id: equal except where brute force rounds equal distances apart
    assert (got["neighbor_id"].to_numpy() == want.ravel()).mean() > 0.999
    again = neighbours.exact_neighbours(df.repartition(3), 5, True, pivots=pivots, chunk=200).toPandas().sort_values(["id", "rank"], ignore_index=True)
    assert got.equals(again)


def test_neighbours_of_other_rows_are_exact(spark):
    x, q = _clusters(6), _clusters(7)[::3]
    rows = [(f"b{i:04d}", i % 3, False, [float(v) for v in p]) for i, p in enumerate(x)] + [(f"q{i:04d}", 0, True, [float(v) for v in p]) for i, p in enumerate(q)]
    df = spark.createDataFrame(rows, "id string, label int, asks boolean, f array<double>")
    got = neighbours.exact_neighbours(df, 4, False, chunk=50).toPandas().sort_values(["id", "rank"], ignore_index=True)
    want, far = _brute(q, x, 4, False)
    assert np.allclose(got["distance"], far.ravel(), atol=1e-12) and (got["neighbor_label"].to_numpy() == np.array([int(n[1:]) % 3 for n in got["neighbor_id"]])).all()
    few = df.where("asks or id < 'b0002'")                      # fewer rows than asked for
    assert neighbours.exact_neighbours(few, 4, False).groupBy("id").count().select("count").distinct().collect()[0][0] == 2
    assert neighbours.exact_neighbours(df.limit(0), 4, True).count() == 0
    assert neighbours.exact_neighbours(df.where("asks"), 4, False).count() == 0


def test_clustered_points_meet_few_cells(spark, monkeypatch):
    """What the second round ships on clustered vectors: a few cells a point, not all of them."""
    visits = []
    real = neighbours._meet
    monkeypatch.setattr(neighbours, "_meet", lambda asks, *a: visits.append(asks.count()) or real(asks, *a))
    rng = np.random.RandomState(2)
    centres = rng.randn(40, 12) * 20
    for n in (1000, 4000):
        x = centres[rng.randint(0, 40, n)] + rng.randn(n, 12)
        df = spark.createDataFrame([(i, 0, True, [float(v) for v in p]) for i, p in enumerate(x)], "id long, label int, asks boolean, f array<double>")
        neighbours.exact_neighbours(df, 5, True, chunk=64).count()
    first, second = visits[1] / visits[0], visits[3] / visits[2]
    assert visits[0] == 1000 and first < 16 and second < 16 * 4 and second < 4000 * 2 / 64 * 0.6


def test_points_without_structure_meet_blocks_not_cells(spark, monkeypatch):
    """Vectors that meet nearly every cell are shipped once a block of cells."""
    visits = []
    real = neighbours._meet
    monkeypatch.setattr(neighbours, "_meet", lambda asks, *a: visits.append(asks.count()) or real(asks, *a))
    monkeypatch.setattr(neighbours, "CELL", 32, raising=False)
    x = np.random.RandomState(8).randn(1500, 24)
    df = spark.createDataFrame([(i, 0, True, [float(v) for v in p]) for i, p in enumerate(x)], "id long, label int, asks boolean, f array<double>")
    got = neighbours.exact_neighbours(df, 3, True, chunk=64).toPandas().sort_values(["id", "rank"], ignore_index=True)
    few = visits[:]
    got2 = neighbours.exact_neighbours(df, 3, True, chunk=1024).toPandas().sort_values(["id", "rank"], ignore_index=True)
    want, far = _brute(x, x, 3, True)
    assert (got["neighbor_id"].to_numpy() == want.ravel()).all() and got.equals(got2) and np.allclose(got["distance"], far.ravel(), atol=1e-12)
    assert few[0] == visits[2] == 1500 and visits[3] < few[1] / 2 and visits[3] <= 1500 * 16      # 94 cells


def test_smote_counts_and_place(spark):
    rng = np.random.RandomState(1)
    x = rng.randn(100, 3)
    y = np.array([1] * 10 + [0] * 90)
    new = resample.smote(_points(spark, x, y), 0.5).toPandas()
    assert len(new) == 45 - 10 and new["id"].is_unique and (new["label"] == 1).all()
    # synthetic rows lie on segments between minority rows: inside their bounding box
    p, xm = np.stack(new["features"]), x[y == 1]
    assert (p >= xm.min(0) - 1e-12).all() and (p <= xm.max(0) + 1e-12).all()
    three = np.array([1, 1, 1] + [0] * 97)
    assert resample.smote(_points(spark, x, three), 0.2).count() == 19 - 3     # k shrinks to 2


def test_resample_whole_table(spark):
    rng = np.random.RandomState(2)
    df = _points(spark, rng.randn(400, 4), (rng.rand(400) < 0.1).astype(int))
    out = resample.resample(df, method="tomek", chunk=64).toPandas()
    assert out["synthetic"].sum() > 0 and out["id"].is_unique and (~out["synthetic"]).sum() <= 400
    single = _points(spark, [[0.0]] * 5, [0] * 5)
    assert resample.resample(single).count() == 5
    assert resample.resample(single.limit(0)).count() == 0
    assert [resample.adaptive_ratio(n) for n in (10, 60_000, 200_000)] == [0.35, 0.25, 0.15]


def test_knn_join_and_classifier(spark):
    base = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 0), (3, [10.0], 1), (4, [11.0], 1)],
                                 "id long, features array<double>, label int")
    q = spark.createDataFrame([(9, [10.4])], "id long, features array<double>")
    nb = resample.knn_join(q, base, 2).orderBy("rank").collect()
    assert [r["neighbor_id"] for r in nb] == [3, 4]
    r = resample.knn_classify(q, base, 3).first()
    assert math.isclose(r["p"], 2 / 3) and r["prediction"] == 1.0


def test_vector_scaler_population_std(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "v array<double>")
    sc = vectors.fit_array_scaler(df, "v")
    assert sc.mean == [2.0, 5.0] and sc.std == [1.0, 0.0]
    out = [r[0] for r in sc.transform(df, "v").collect()]
    assert out == [[-1.0, 0.0], [1.0, 0.0]]


def test_pca_components_orthonormal(spark):
    rng = np.random.RandomState(0)
    df = spark.createDataFrame([([float(v) for v in rng.randn(6)],) for _ in range(200)], "v array<double>")
    m = vectors.fit_pca(df, "v", 3)
    pc = m.stages[-1].pc.toArray()
    assert np.allclose(pc.T @ pc, np.eye(3), atol=1e-9)
    ev = vectors.explained_variance(m)
    assert len(ev) == 3 and ev[0] >= ev[1] >= ev[2]
    proj = np.array([r[0] for r in vectors.apply_pca(m, df, "v", "p").select("p").collect()])
    assert np.allclose(proj.mean(0), 0, atol=1e-5)                    # centred before projecting


def test_user_model_embedding_and_mean_pool(spark):
    def make_fn():
        def predict(texts):
            return np.stack([[len(t), t.count(" "), 1.0] for t in texts]).astype(np.float32)
        return predict
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "id long, t string")
    out = {r["id"]: r["embedding"] for r in vectors.embed_text(df, "t", model_fn=make_fn, dim=3).collect()}
    assert out[1] == [5.0, 2.0, 1.0] and out[2] == [0.0, 0.0, 1.0]
    tok = np.array([[[1.0, 2.0], [3.0, 4.0], [100.0, 100.0]]])
    assert np.allclose(vectors.mean_pool(tok, np.array([[1, 1, 0]])), [[2.0, 3.0]])


def test_synthetic_ids_consecutive(spark):
    from tessera.operators import folds
    df = spark.range(0, 50, numPartitions=4).withColumnRenamed("id", "x")
    ids = sorted(r["id"] for r in folds.synthetic_ids(df, width=4).collect())
    assert ids == sorted(f"W{i:04d}" for i in range(50))
    fb = [r["embedding"] for r in vectors.embed_text(spark.createDataFrame([(1, "x y")], "id long, t string"),
                                                     "t", dim=8).collect()]
    assert len(fb[0]) == 8


def test_column_classification_and_selection(spark):
    df = spark.createDataFrame([(1, "a", 2.0, [0.1], 3, True)],
                               "id long, type string, x double, specter2_embedding array<float>, n int, b boolean")
    groups = schema.classify_columns(df, embedding_prefixes=["specter2_"])
    assert groups == {"id": ["id"], "embedding": ["specter2_embedding"], "numeric": ["x", "n", "b"],
                      "categorical": ["type"]}
    sel = schema.select_available(df, ["x", "missing", "id", "x"])
    assert sel.columns == ["x", "id"]
    fs = schema.feature_set(df, {"regular": ["x", "n"], "specter2": ["specter2_embedding"]}, ["regular", "specter2"])
    assert fs.columns == ["x", "n", "specter2_embedding"]


def test_size_shuffles_only_raises(spark):
    from tessera.session import size_shuffles
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    advisory = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        assert size_shuffles(spark, 10 << 30, min_partitions=1) >= 40
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 40
        assert size_shuffles(spark, 1, min_partitions=1) == 40          # never lowered
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(before))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)


def test_model_comparison_keeps_failures_and_feature_counts(spark):
    from pyspark.ml.linalg import Vectors

    from tessera.operators import models
    rows = [(Vectors.dense([float(i % 7), float(i % 2)]), float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, ["features", "label"])
    out = models.compare_models(["logistic", "no_such_model"], df, df, n_features=2)
    got = {r["model"]: r for r in out.collect()}
    assert got["logistic"]["error"] is None and got["logistic"]["f1"] == 1.0
    assert got["no_such_model"]["f1"] is None and got["no_such_model"]["error"]
    assert models.best_model(out).first()["model"] == "logistic"
    odd = df.unionByName(spark.createDataFrame([(Vectors.dense([1.0]), 0.0)], ["features", "label"]))
    models.check_feature_count(df, "features", 2)
    with pytest.raises(ValueError):
        models.check_feature_count(odd, "features", 2)
