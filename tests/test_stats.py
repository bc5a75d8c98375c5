import math

import numpy as np
import pandas as pd
import pytest

from tessera import jvmstats
from tessera.operators import stats


def _frame(spark, n=60, seed=1):
    rng = np.random.RandomState(seed)
    y = (rng.rand(n) < 0.4).astype(int)
    x1 = rng.randn(n) + y
    x2 = np.round(rng.rand(n) * 3)                       # heavy ties
    x3 = np.where(rng.rand(n) < 0.2, np.nan, rng.randn(n))
    pdf = pd.DataFrame({"id": np.arange(n), "x1": x1, "x2": x2, "x3": x3, "label": y})
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    return df, pdf


def test_pearson_spearman_match_pandas(spark):
    df, pdf = _frame(spark)
    got = {r["feature"]: r for r in stats.correlation_stats(df, ["x1", "x2", "x3"], "label").collect()}
    for c in ("x1", "x2", "x3"):
        sub = pdf[[c, "label"]].dropna()
        assert got[c]["n"] == len(sub)
        assert math.isclose(got[c]["pearson_r"], sub[c].corr(sub["label"]), abs_tol=1e-12)
        sp = sub[c].rank().corr(sub["label"].rank())
        assert math.isclose(got[c]["spearman_r"], sp, abs_tol=1e-12)


def test_constant_feature_and_small_n_skipped(spark):
    df = spark.createDataFrame([(1, 1.0, 0), (2, 1.0, 1)] * 10 + [(3, 2.0, None)], "id long, c double, label int")
    assert stats.correlation_stats(df, ["c"], "label").count() == 0
    small = spark.createDataFrame([(i, float(i), i % 2) for i in range(9)], "id long, c double, label int")
    assert stats.correlation_stats(small, ["c"], "label").count() == 0


def _t_two_sided(t, nu):
    """Two-sided tail of Student's t by numerical integration of the density."""
    x = np.linspace(abs(t), abs(t) + 200, 2_000_001)
    c = math.exp(math.lgamma((nu + 1) / 2) - math.lgamma(nu / 2)) / math.sqrt(nu * math.pi)
    pdf = c * (1 + x * x / nu) ** (-(nu + 1) / 2)
    return 2 * np.trapezoid(pdf, x)


def test_pearson_p_value(spark):
    r, n = 0.5, 30
    t = r * math.sqrt((n - 2) / (1 - r * r))
    assert math.isclose(jvmstats.pearson_p(spark, r, n), _t_two_sided(t, n - 2), rel_tol=1e-6)


def test_medians_and_modes(spark):
    df = spark.createDataFrame([(1, 1.0, "b"), (2, 4.0, "a"), (3, None, "b"), (4, 2.0, "a"), (5, 3.0, None)],
                               "id long, x double, s string")
    med = {r["column"]: r["median"] for r in stats.column_medians(df, ["x"]).collect()}
    assert med["x"] == 2.5                                  # even count → interpolated
    modes = {r["column"]: r["mode"] for r in stats.column_modes(df, ["s"]).collect()}
    assert modes["s"] == "a"                                # tie a/b → smallest
    empty = spark.createDataFrame([(1, None)], "id long, s string")
    assert stats.column_modes(empty, ["s"]).first()["mode"] == "__missing__"


def test_imputation_fit_on_train_apply_everywhere(spark):
    train = spark.createDataFrame([(1, 1.0, "a", None), (2, 3.0, None, None), (3, None, "a", None)],
                                  "id long, x double, s string, dead double")
    test = spark.createDataFrame([(9, None, None, 1.0)], "id long, x double, s string, dead double")
    spec = stats.fit_imputation(train, ["id"])
    assert spec["dropped_all_missing_cols"] == ["dead"]
    out = stats.apply_imputation(test, spec).first().asDict()
    assert out == {"id": 9, "x": 2.0, "s": "a"}


def test_missingness_report(spark):
    a = spark.createDataFrame([(1, None), (2, 1.0)], "id long, x double")
    b = spark.createDataFrame([(1, None)], "id long, x double")
    rep = {r["column"]: r for r in stats.missingness_report({"train": a, "val": b}).collect()}
    assert rep["x"]["train_missing"] == 1 and rep["x"]["val_pct"] == 1.0


def test_chi_square_matches_hand_formula(spark):
    # 3x2 table without Yates
    rows = [("u", 0)] * 10 + [("u", 1)] * 20 + [("v", 0)] * 30 + [("v", 1)] * 5 + [("w", 1)] * 7
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "id long, f string, label int")
    r = stats.chi_square_stats(df, ["f"], "label").first()
    obs = np.array([[10, 20], [30, 5], [0, 7]], float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    assert math.isclose(r["chi2"], ((obs - exp) ** 2 / exp).sum(), rel_tol=1e-12)
    assert r["dof"] == 2 and r["n"] == 72
    # 2x2 with Yates: chi2 = n (|ad-bc| - n/2)^2 / (r1 r2 c1 c2)
    rows = [("u", 0)] * 10 + [("u", 1)] * 20 + [("v", 0)] * 30 + [("v", 1)] * 5
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "id long, f string, label int")
    r = stats.chi_square_stats(df, ["f"], "label").first()
    n, a, b, c, d = 65, 10, 20, 30, 5
    want = n * (abs(a * d - b * c) - n / 2) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    assert math.isclose(r["chi2"], want, rel_tol=1e-12) and r["dof"] == 1


def test_cramers_v_golden_rows():
    assert math.isclose(stats.cramers_v(47319.05051446376, 960000, 20, 2), 0.2220150391735503, rel_tol=1e-12)
    assert math.isclose(stats.cramers_v(20000.140598474987, 960000, 55, 2), 0.14433807463756093, rel_tol=1e-12)


def test_anova_matches_formula(spark):
    g = {0: [1.0, 2.0, 3.0, 4.0], 1: [2.0, 4.0, 6.0], 2: [5.0, 5.0, 5.0]}     # group 2 has zero variance → dropped
    rows = [(i, v, k) for i, (k, vs) in enumerate(g.items()) for v in vs]
    df = spark.createDataFrame([(j, v, k) for j, (_, v, k) in enumerate(rows)], "id long, x double, label int")
    r = stats.anova_stats(df, ["x"], "label").first()
    a, b = np.array(g[0]), np.array(g[1])
    allv = np.concatenate([a, b])
    ssb = len(a) * (a.mean() - allv.mean()) ** 2 + len(b) * (b.mean() - allv.mean()) ** 2
    ssw = ((a - a.mean()) ** 2).sum() + ((b - b.mean()) ** 2).sum()
    assert math.isclose(r["F"], (ssb / 1) / (ssw / (len(allv) - 2)), rel_tol=1e-12)
    assert (r["df_between"], r["df_within"]) == (1, 5)
    rep = stats.anova_report(df, ["x"], "label").first()
    assert 0 < rep["p_value"] < 1


def test_tukey_two_groups_equals_t_test(spark):
    rng = np.random.RandomState(3)
    vals = [(i, float(v), 0) for i, v in enumerate(rng.randn(30))] + \
           [(100 + i, float(v) + 1.0, 1) for i, v in enumerate(rng.randn(25))]
    df = spark.createDataFrame(vals, "id long, x double, label int")
    r = stats.tukey_hsd(df, ["x"], "label").first()
    a = np.array([v for _, v, g in vals if g == 0])
    b = np.array([v for _, v, g in vals if g == 1])
    sp2 = (((a - a.mean()) ** 2).sum() + ((b - b.mean()) ** 2).sum()) / (len(a) + len(b) - 2)
    t = (b.mean() - a.mean()) / math.sqrt(sp2 * (1 / len(a) + 1 / len(b)))
    assert math.isclose(r["meandiff"], b.mean() - a.mean(), rel_tol=1e-12)
    assert math.isclose(r["p-adj"], jvmstats.t_two_sided_p(spark, t, len(a) + len(b) - 2), rel_tol=1e-9)
    assert r["lower"] < r["meandiff"] < r["upper"] and r["reject"]


def test_studentized_range_known_quantile():
    # q(0.95; k=3, df=10) = 3.877 (published tables)
    assert math.isclose(jvmstats.studentized_range_quantile(0.95, 3, 10), 3.877, abs_tol=2e-3)


@pytest.mark.parametrize("label_values", [[0, 1], [0, 1, 2]])
def test_class_counts_and_weights(spark, label_values):
    rows = [(i, label_values[i % len(label_values)] if i % 5 else 0) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, label int")
    w = {r["label"]: r for r in stats.class_weights(df, "label").collect()}
    n = 50
    for k, r in w.items():
        assert math.isclose(r["balanced_weight"], n / (len(w) * r["count"]))
    assert stats.label_diagnostics(df, "label").first()["is_categorical"]


def _tail(pdf, lo, hi=None, n=2_000_001):
    x = np.linspace(lo, hi if hi is not None else lo + 400, n)
    return np.trapezoid(pdf(x), x)


def test_chi2_and_f_tails_match_integrated_densities(spark):
    k, xv = 3.0, 7.5
    c = 1 / (2 ** (k / 2) * math.gamma(k / 2))
    want = _tail(lambda x: c * x ** (k / 2 - 1) * np.exp(-x / 2), xv)
    assert math.isclose(jvmstats.chi2_sf(spark, xv, k), want, rel_tol=1e-6)
    d1, d2, f = 3.0, 20.0, 2.5
    b = math.exp(math.lgamma(d1 / 2) + math.lgamma(d2 / 2) - math.lgamma((d1 + d2) / 2))
    dens = lambda x: np.sqrt((d1 * x) ** d1 * d2 ** d2 / (d1 * x + d2) ** (d1 + d2)) / (x * b)
    assert math.isclose(jvmstats.f_sf(spark, f, d1, d2), _tail(dens, f, f + 2000, 4_000_001), rel_tol=1e-5)


def test_tail_p_values_do_not_underflow(spark):
    from tessera import jvmstats

    assert 0 < jvmstats.f_sf(spark, 200.0, 1, 959_998) < 1e-40
    assert 0 < jvmstats.chi2_sf(spark, 100.0, 1) < 1e-20
    assert abs(jvmstats.chi2_sf(spark, 3.841459, 1) - 0.05) < 1e-6
    assert jvmstats.f_sf(spark, 0.0, 3, 10) == 1.0


def test_studentized_range_mass_at_many_degrees_of_freedom():
    from tessera import jvmstats

    # critical values of the 5 % table: k = 10 at 120 and infinitely many degrees of freedom, k = 3 at 10
    assert abs(jvmstats.studentized_range_quantile(0.95, 10, 120) - 4.56) < 0.02
    assert abs(jvmstats.studentized_range_quantile(0.95, 3, 10) - 3.88) < 0.02
    for df in (100, 500, 5000, 100_000):
        assert abs(jvmstats.studentized_range_cdf(60.0, 10, df) - 1.0) < 1e-6
        assert 4.46 < jvmstats.studentized_range_quantile(0.95, 10, df) < 4.62


def test_chi_square_leaves_null_categories_out(spark):
    from tessera.operators import stats

    rows = [(x, y) for x in ("a", "b", "c") for y in (0, 1) for _ in range(20)]
    df = spark.createDataFrame(rows + [(None, k % 2) for k in range(40)], "f string, y int")
    r = stats.chi_square_stats(df, ["f"], "y").first()
    assert abs(r.chi2) < 1e-9 and r.n == 120 and abs(r.cramers_v) < 1e-9
