import math

from pyspark.sql import functions as F

from tessera.operators import ensemble, folds


def _scores(spark):
    rows = [(1, "a", 0.9), (1, "b", 0.1), (2, "a", 0.5), (2, "b", 0.5), (3, "a", 0.2), (3, "b", 0.7)]
    return spark.createDataFrame(rows, "id long, model string, p double")


def test_weights(spark):
    m = spark.createDataFrame([("a", 0.5, None), ("b", None, 0.4), ("c", None, None), ("d", -1.0, 0.9)],
                              "model string, best_f1 double, best_cv_score double")
    w = {r["model"]: r["w"] for r in m.select("model", ensemble.model_weight().alias("w")).collect()}
    assert w == {"a": 0.25, "b": 0.16000000000000003, "c": 1.0, "d": 1.0}


def test_combinations(spark):
    s = _scores(spark)
    models = spark.createDataFrame([("a", 1.0, None), ("b", 0.5, None)], "model string, best_f1 double, best_cv_score double")
    mean = {r["id"]: r["p"] for r in ensemble.combine(s, "mean").collect()}
    wm = {r["id"]: r["p"] for r in ensemble.combine(s, "weighted_mean", models).collect()}
    gm = {r["id"]: r["p"] for r in ensemble.combine(s, "geometric_mean").collect()}
    rk = {r["id"]: r["p"] for r in ensemble.combine(s, "rank_mean").collect()}
    assert math.isclose(mean[1], 0.5) and math.isclose(wm[1], (0.9 * 1 + 0.1 * 0.25) / 1.25)
    assert math.isclose(gm[2], 0.5, rel_tol=1e-9)
    # model a: 0.2 < 0.5 < 0.9 → ranks 0, .5, 1; model b: 0.1 < 0.5 < 0.7 → 0, .5, 1
    assert rk == {1: 0.5, 2: 0.5, 3: 0.5}


def test_rank_single_row_is_zero(spark):
    s = spark.createDataFrame([(1, "a", 0.3)], "id long, model string, p double")
    assert ensemble.rank_transform(s).first()["rank_p"] == 0.0


def test_vote_and_ties(spark):
    s = _scores(spark)
    for tb, want2 in (("conservative", 0), ("aggressive", 1), ("prob_mean", 1)):
        v = {r["id"]: r for r in ensemble.combine(s, "vote", tie_breaker=tb).collect()}
        assert v[2]["p"] == 0.0 and v[1]["p"] == 0.5
        assert v[1]["vote_label"] == (0 if tb == "conservative" else 1)
        del want2
    df = spark.createDataFrame([(0.5,), (0.49,), (0.7,)], "p double")
    out = [r[0] for r in df.select(ensemble.break_ties("p", 0.5, "conservative")).collect()]
    assert out == [0, 0, 1]
    out = [r[0] for r in df.select(ensemble.break_ties("p", 0.5, "round_up")).collect()]
    assert out == [1, 0, 1]


def test_final_threshold(spark):
    m = spark.createDataFrame([("a", 0.2), ("b", None), ("c", 0.4)], "model string, best_threshold double")
    assert math.isclose(m.agg(ensemble.final_threshold()).first()[0], 0.3)
    none = spark.createDataFrame([("a", None)], "model string, best_threshold double")
    assert none.agg(ensemble.final_threshold()).first()[0] == 0.5


def test_fold_sizes_remainder_to_last(spark):
    rows = [(i, 0) for i in range(11)] + [(100 + i, 1) for i in range(23)]
    df = spark.createDataFrame(rows, "id long, label int")
    f = folds.stratified_folds(df, "label", 5)
    sizes = {(r["label"], r["fold"]): r["count"] for r in f.groupBy("label", "fold").count().collect()}
    assert [sizes[(0, k)] for k in range(5)] == [2, 2, 2, 2, 3]
    assert [sizes[(1, k)] for k in range(5)] == [4, 4, 4, 4, 7]
    assert f.select("id").distinct().count() == 34
    tiny = spark.createDataFrame([(1, 0), (2, 0)], "id long, label int")
    assert {r["fold"] for r in folds.stratified_folds(tiny, "label", 5).collect()} == {4}


def test_split_undersample_sample(spark):
    rows = [(i, 0) for i in range(70)] + [(100 + i, 1) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, label int")
    s = folds.stratified_split(df, "label", test_fraction=0.2)
    c = {(r["label"], r["is_test"]): r["count"] for r in s.groupBy("label", "is_test").count().collect()}
    assert c[(0, True)] == 14 and c[(1, True)] == 6
    u = folds.undersample(df, "label")
    assert {r["label"]: r["count"] for r in u.groupBy("label").count().collect()} == {0: 30, 1: 30}
    assert folds.exact_sample(df, 0.25).count() == 25
    w = folds.weighted_resample(df, "label", n=100)
    counts = {r["label"]: r["count"] for r in w.groupBy("label").count().collect()}
    assert abs(counts[0] - 50) <= 12 and abs(counts[1] - 50) <= 12
    assert df.where(F.col("label") == 1).count() == 30
