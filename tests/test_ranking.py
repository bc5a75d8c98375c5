import numpy as np
import pandas as pd
import pytest

from tessera.operators import ranking


@pytest.mark.parametrize("seed,slices", [(0, 4), (1, 64), (2, None)])
def test_prefix_sums_match_brute_force(spark, seed, slices):
    rng = np.random.RandomState(seed)
    n = 400
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]),
                        "x": np.round(rng.randn(n), 1),          # many ties
                        "w": rng.randint(1, 4, n)})
    pdf.loc[:150, "x"] = 0.0                                       # one hot value with a third of the rows
    df = spark.createDataFrame(pdf)
    got = ranking.value_prefix_sums(df, ["k"], "x", {"s": "w"}, slices).toPandas()
    for _, r in got.iterrows():
        sub = pdf[pdf.k == r.k]
        assert r.s == sub[sub.x == r.x].w.sum()
        assert r.s_le == sub[sub.x <= r.x].w.sum()
        assert r.s_lt == sub[sub.x < r.x].w.sum()
        assert r.s_total == sub.w.sum()
    assert len(got) == pdf.groupby(["k", "x"]).ngroups


def test_average_ranks_and_median(spark):
    pdf = pd.DataFrame({"k": ["a"] * 6 + ["b"] * 3, "x": [3.0, 1.0, 3.0, 2.0, 5.0, 3.0, 1.0, 2.0, 9.0]})
    df = spark.createDataFrame(pdf)
    r = ranking.average_ranks(df, ["k"], "x").toPandas()
    want = pdf.assign(rank=pdf.groupby("k").x.rank()).drop_duplicates(["k", "x"])
    merged = r.merge(want, on=["k", "x"], suffixes=("", "_want"))
    assert (merged["rank"] == merged["rank_want"]).all()
    med = {row["k"]: row["median"] for row in ranking.exact_median(df, "k", "x").collect()}
    assert med == {"a": 3.0, "b": 2.0}
    even = spark.createDataFrame(pd.DataFrame({"k": ["a"] * 4, "x": [1.0, 2.0, 3.0, 10.0]}))
    assert ranking.exact_median(even, "k", "x").first()["median"] == 2.5


def test_no_keys(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": [2.0, 1.0, 2.0], "w": [1, 1, 1]}))
    got = {r["x"]: r["w_lt"] for r in ranking.value_prefix_sums(df, [], "x", {"w": "w"}).collect()}
    assert got == {1.0: 0, 2.0: 1}


def _spread(spark, on):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(not on).lower())


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_rows_carry_their_numbers_and_ranks(spark, seed):
    from tessera.operators.ensemble import rank_transform
    rng = np.random.RandomState(seed)
    n = 600
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]), "p": np.round(rng.rand(n), 1), "id": np.arange(n)})
    pdf.loc[100:350, "p"] = 0.5                                    # a tie with a third of the rows, over several slices
    rows = [(None if i % 7 == 0 else r.k, None if i % 11 == 0 else float(r.p), int(r.id)) for i, r in enumerate(pdf.itertuples())]
    df = spark.createDataFrame(rows, "k string, p double, id long").repartition(5)
    _spread(spark, True)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        got = ranking.numbered(df, ["k"], ["p"], "pos", "n").toPandas()
        assert got.groupby("k", dropna=False)["pos"].apply(lambda s: sorted(s) == list(range(len(s)))).all()
        assert len(got) == n
        for _, part in got.groupby("k", dropna=False):
            values = part.sort_values("pos")["p"].fillna(-1.0)
            assert values.is_monotonic_increasing and (part["n"] == len(part)).all()
        ranked = ranking.tie_ranked(df, ["k"], "p").collect()
        known = [(k, p) for k, p, _ in rows if k is not None and p is not None]
        assert len(ranked) == len(known)
        for r in ranked:
            assert r.n_below == sum(a == r.k and b < r.p for a, b in known) and r.n == sum(a == r.k for a, _ in known)
        whole = ranking.tie_ranked(df, [], "p").collect()
        every = [p for _, p, _ in rows if p is not None]
        assert all(r.n_below == sum(b < r.p for b in every) and r.n == len(every) for r in whole)
        share = {(r.k, r.p): r.rank_p for r in rank_transform(df, ["k"]).collect()}
        for (k, p), v in share.items():
            same = [b for a, b in known if a == k]
            assert abs(v - sum(b < p for b in same) / (len(same) - 1)) < 1e-12
        assert ranking.tie_ranked(df.limit(0), ["k"], "p").count() == 0 and ranking.numbered(df.limit(0), ["k"], ["p"]).count() == 0
    finally:
        _spread(spark, False)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_numbering_moves_the_rows_once(spark):
    from tessera.operators import folds
    df = spark.range(0, 1000, numPartitions=4).selectExpr("id", "id % 3 as label", "cast(id as string) as wide")
    plan = folds.class_positions(df, "label")._jdf.queryExecution().executedPlan().toString()
    body = plan[plan.index("wide"):]
    assert "hashpartitioning" not in plan.split("BroadcastExchange")[0] and "SortMergeJoin" not in plan and body


def test_null_ids_and_labels_are_kept(spark):
    from tessera.operators import folds
    rows = [(None if k % 2 else k, k % 3 if k % 5 else None, f"row {k}") for k in range(60)]
    df = spark.createDataFrame(rows, "id long, label long, t string").repartition(4)
    assert folds.exact_sample(df, 1.0).count() == 60 and folds.exact_sample(df, 0.25).count() == 15
    kept = folds.stratified_folds(df, "label", 3).toPandas()
    assert len(kept) == 60 and set(kept["fold"]) == {0, 1, 2}
    assert folds.stratified_split(df, "label", 0.5).count() == 60
    assert folds.undersample(df, "label").groupBy("label").count().select("count").distinct().count() == 1
    again = {r.t: r.fold for r in folds.stratified_folds(df.repartition(7), "label", 3).collect()}
    assert again == dict(zip(kept["t"], kept["fold"]))
