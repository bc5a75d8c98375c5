"""Model-ready flow, source fields, sparse one-hot, draws with replacement, PCA in folds."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import encode
from tessera.operators import folds, model_ready, source_fields, vectors
from tessera.sources import files


def test_model_ready_tables(spark, tmp_path):
    root = str(tmp_path)
    base = {s: spark.createDataFrame([(k, None if k % 4 == 0 else float(k), "de" if k % 3 else None, None) for k in range(lo, lo + 30)], "id long, x double, lang string, empty double")
            for s, lo in (("train", 0), ("val", 100), ("test", 200))}
    base["val"] = base["val"].withColumn("empty", F.lit(1.0))      # judged on train only
    for family, have in (("a", base), ("b", base), ("lost", ["train", "val"])):
        for s in have:
            files.write_parquet(base[s].where("id % 5 <> 0").select("id", F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("embedding")), f"{root}/{family}_X_{s}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        used, plans = model_ready.build(spark, base, root, f"{root}/out", buckets=4)
        plan = plans["train"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert used == ["a", "b"] and "Exchange" not in plan and plan.count("SortMergeJoin") == 2
    spec = files.read_spec(spark, f"{root}/out/spec")
    known = [float(k) for k in range(30) if k % 4]
    assert spec["numeric_impute_values"] == {"x": float(np.median(known))} and spec["categorical_impute_values"] == {"lang": "de"}
    for s, lo in (("train", 0), ("val", 100), ("test", 200)):
        out = files.load_split(spark, f"{root}/out", s)
        assert out.columns == ["id", "a_embedding", "b_embedding", "x", "lang"] and dict(out.dtypes)["x"] == "float"
        rows = {r.id: r for r in out.collect()}
        assert len(rows) == 30 and all(r.x == (np.median(known) if k % 4 == 0 else k) and r.lang == "de" for k, r in rows.items())
        assert all((r.a_embedding is None) == (k % 5 == 0) for k, r in rows.items())
    with pytest.raises(ValueError, match="duplicate"):
        model_ready.build(spark, {s: d.union(d) for s, d in base.items()}, root, f"{root}/twice", buckets=2)


def test_source_fields_of_all_rows(spark):
    rows = [(k, '{"source": {"n": %d, "id": "x"}, "pdf_url": "p"}' % k, "cc") for k in range(200)]
    rows += [(200, '{"source": {"n": 2.5, "mixed": 1, "flag": true, "list": [1, 2], "we\'ird": "q"}}', None), (201, '{"source": {"mixed": "a", "flag": false, "last": "z"}}', None),
             (202, None, None), (203, "broken {", None), (204, '{"source": null}', None), (205, '{"source": [1]}', None), (206, '{"source": {"n": null}}', None)]
    df = spark.createDataFrame(rows, "id long, place string, license string").repartition(4)
    out = source_fields.extract_fields(df, "place")
    assert out.columns == ["id", "source_flag", "source_last", "source_list", "source_mixed", "source_n", "source_we'ird"]
    assert dict(out.dtypes)["source_n"] == "double" and dict(out.dtypes)["source_flag"] == "double" and dict(out.dtypes)["source_mixed"] == "string"
    got = {r.id: r for r in out.collect()}
    assert got[7].source_n == 7.0 and got[200].source_n == 2.5 and got[200]["source_we'ird"] == "q" and got[200].source_list == "[1,2]"
    assert (got[200].source_mixed, got[201].source_mixed) == ("1", "a") and (got[200].source_flag, got[201].source_flag) == (1.0, 0.0)
    assert got[201].source_last == "z" and all(got[k].source_n is None for k in range(201, 207))
    assert source_fields.extract_fields(df.limit(0), "place").columns == ["id"]
    with pytest.raises(ValueError, match="source_n"):
        source_fields.extract_fields(df.withColumn("source_n", F.lit(1)), "place")


def test_sparse_one_hot_of_many_levels(spark):
    train = spark.createDataFrame([(k, f"v{k % 1500:05d}" if k % 10 else None) for k in range(3000)], "id long, c string")
    model = encode.sparse_one_hot(train, "c", "at")
    other = spark.createDataFrame([(1, "v00001"), (2, None), (3, "never seen")], "id long, c string")
    got = {r.id: r for r in encode.sparse_pairs(encode.encode_sparse(model, other, "c", "at"), "at").collect()}
    levels = sorted({f"v{k % 1500:05d}" if k % 10 else "unknown" for k in range(3000)})
    assert len(levels) > 1001 and all(r["size"] == len(levels) + 1 and r["value"] == 1.0 for r in got.values())
    assert got[1]["index"] == levels.index("v00001") and got[2]["index"] == levels.index("unknown") and got[3]["index"] == len(levels)


def test_draws_of_ranges_agree_and_add_up():
    n, rows = 50_000, 20_000
    whole = folds.draws_of_range(3, 1, n, rows, 0, rows)
    assert whole.sum() == n and (whole >= 0).all()
    for lo, hi in ((0, 10), (4000, 4200), (19_990, 20_000), (5, 19_000)):
        assert (folds.draws_of_range(3, 1, n, rows, lo, hi) == whole[lo:hi]).all()
    assert (folds.draws_of_range(3, 2, n, rows, 0, rows) != whole).any()
    # Poisson-like counts with mean 2.5: mean, variance and the share of rows never drawn
    assert abs(whole.var() - 2.5) < 0.15 and abs((whole == 0).mean() - np.exp(-2.5)) < 0.01
    quarters = whole.reshape(20, -1).sum(axis=1)
    assert ((quarters - 2500) ** 2 / 2500).sum() < 45              # chi-square with 19 degrees of freedom


def test_draw_with_replacement(spark):
    rows = [(None if k % 9 == 0 else k, 0 if k < 9500 else 1) for k in range(10_000)]
    df = spark.createDataFrame(rows, "id long, label long").repartition(5)
    got = folds.draw_with_replacement(df, "label").toPandas()
    assert len(got) == 10_000
    by = got["label"].value_counts()
    assert abs(by[0] - 5000) < 4 * 50 and abs(by[1] - 5000) < 4 * 50        # binomial(10,000, 1/2)
    counts = got[got["label"] == 1].groupby("id").size()
    assert counts.max() > 14 and abs(counts.mean() - by[1] / 500) < 1.0
    again = folds.draw_with_replacement(df.repartition(3), "label").toPandas()
    key = lambda d: collections.Counter(zip(d["id"].fillna(-1), d["label"]))
    assert key(got) == key(again) and key(got) != key(folds.draw_with_replacement(df, "label", seed=1).toPandas())
    assert folds.draw_with_replacement(df, "label", n=7).count() == 7
    assert folds.draw_with_replacement(df.where("id = 1"), "label", n=30_001).count() == 30_001      # one row, several blocks of copies
    assert folds.draw_with_replacement(df.limit(0), "label").count() == 0


def test_pca_inside_folds_equals_separate_fits(spark):
    rng = np.random.RandomState(5)
    x = rng.randn(400, 6) @ np.diag([5, 3, 1, 1, 0.5, 0.1]) + 1000.0
    rows = [(k, int(k % 4), [float(v) for v in r], [float(v) for v in r[:3]]) for k, r in enumerate(x)] + [(400, 1, None, None)]
    df = spark.createDataFrame(rows, "id long, fold int, a array<double>, b array<double>").repartition(3)
    model = vectors.fold_pca(df, {"a": 3, "b": 2})
    for col, data, k in (("a", x, 3), ("b", x[:, :3], 2)):
        got = {r.id: r for r in model[col].transform(df, "p").collect()}
        assert got[400].p is None
        for fold in range(4):
            train = data[np.arange(400) % 4 != fold]
            centre = train.mean(axis=0)
            value, vector = np.linalg.eigh(np.cov(train.T))
            axes = vector[:, ::-1][:, :k].T
            axes = axes * np.sign(axes[np.arange(k), np.abs(axes).argmax(axis=1)])[:, None]
            assert np.allclose(model[col].explained[fold], value[::-1][:k] / value.sum())
            for i in range(fold, 400, 80):
                assert np.allclose(got[i - i % 4 + fold].p, (data[i - i % 4 + fold] - centre) @ axes.T, atol=1e-4)
    whole = model["a"].transform(df, "p", fold_col=None).where("id < 400").collect()
    assert np.allclose(np.mean([r.p for r in whole], axis=0), 0, atol=1e-4)
