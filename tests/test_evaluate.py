import math

import numpy as np

from tessera.operators import evaluate


def _scores(spark, n=300, seed=5):
    rng = np.random.RandomState(seed)
    y = (rng.rand(n) < 0.3).astype(int)
    p = np.round(np.clip(rng.rand(n) * 0.7 + 0.3 * y, 0, 1), 2)       # rounding → ties
    rows = [(int(i), "m", int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "id long, model string, label int, p double"), y, p


def _brute_curve(y, p):
    out = {}
    for t in np.unique(p):
        pred = p >= t
        tp, fp = (pred & (y == 1)).sum(), (pred & (y == 0)).sum()
        out[t] = (tp / (tp + fp), tp / y.sum(), fp / (y == 0).sum(), tp / y.sum())
    return out


def test_pr_and_roc_curves(spark):
    df, y, p = _scores(spark)
    want = _brute_curve(y, p)
    pr = {r["threshold"]: r for r in evaluate.pr_curve(df).collect()}
    roc = {r["threshold"]: r for r in evaluate.roc_curve(df).collect()}
    assert set(pr) == set(want)
    for t, (prec, rec, fpr, tpr) in want.items():
        assert math.isclose(pr[t]["precision"], prec) and math.isclose(pr[t]["recall"], rec)
        assert math.isclose(roc[t]["fpr"], fpr) and math.isclose(roc[t]["tpr"], tpr)


def test_auc_ap_prauc(spark):
    df, y, p = _scores(spark)
    r = evaluate.curve_areas(df).first()
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert math.isclose(r["roc_auc"], auc, rel_tol=1e-12)
    ts = np.unique(p)[::-1]
    ap, area, prev_r, prev_p = 0.0, 0.0, 0.0, 1.0
    for t in ts:
        pred = p >= t
        tp = (pred & (y == 1)).sum()
        prec, rec = tp / pred.sum(), tp / y.sum()
        ap += (rec - prev_r) * prec
        area += (rec - prev_r) * (prec + prev_p) / 2
        prev_r, prev_p = rec, prec
    assert math.isclose(r["average_precision"], ap, rel_tol=1e-12)
    assert math.isclose(r["pr_auc"], area, rel_tol=1e-12)


def _f1(y, pred):
    tp = (pred & (y == 1)).sum()
    fp = (pred & (y == 0)).sum()
    fn = (~pred & (y == 1)).sum()
    return 0.0 if 2 * tp + fp + fn == 0 else 2 * tp / (2 * tp + fp + fn)


def test_threshold_metrics_and_searches(spark):
    df, y, p = _scores(spark)
    tm = {r["t_index"]: r for r in evaluate.threshold_metrics(df, evaluate.COARSE_GRID).collect()}
    for i, t in enumerate(evaluate.COARSE_GRID):
        assert math.isclose(tm[i]["f1"], _f1(y, p >= t))
    best_t, best_f = 0.5, 0.0
    for t in evaluate.COARSE_GRID:
        f = _f1(y, p >= t)
        if f > best_f:
            best_t, best_f = t, f
    r = evaluate.coarse_threshold_search(df).first()
    assert (r["best_threshold"], r["best_f1"]) == (best_t, best_f)
    # PR argmax then strict improvement on the fine grid
    ts = np.unique(p)
    f1pr = []
    for t in ts:
        pred = p >= t
        tp = (pred & (y == 1)).sum()
        pr, rc = tp / pred.sum(), tp / y.sum()
        f1pr.append(2 * pr * rc / (pr + rc + 1e-10))
    bt, bf = ts[int(np.argmax(f1pr))], max(f1pr)
    for t in evaluate.FINE_GRID:
        f = _f1(y, p >= t)
        if f > bf:
            bt, bf = t, f
    r = evaluate.threshold_search(df).first()
    assert math.isclose(r["best_threshold"], bt) and math.isclose(r["best_f1"], bf)


def test_f1_zero_division_and_no_keys(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, p double")
    assert evaluate.f1_at_threshold(df, 0.5, []).first()["f1"] == 0.0


def test_classification_report(spark):
    df = spark.createDataFrame([("m", 1, 1), ("m", 1, 0), ("m", 0, 0), ("m", 0, 0)], "model string, label int, pred int")
    rep = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert math.isclose(rep["1"]["precision"], 1.0) and math.isclose(rep["1"]["recall"], 0.5)
    assert math.isclose(rep["0"]["precision"], 2 / 3) and rep["accuracy"]["precision"] == 0.75
    assert rep["weighted avg"]["support"] == 4


def test_histogram_density_integrates_to_one(spark):
    df, _, _ = _scores(spark)
    h = evaluate.score_histogram(df).collect()
    for cls in (0, 1):
        area = sum(r["density"] * (r["bin_end"] - r["bin_start"]) for r in h if r["label"] == cls)
        assert math.isclose(area, 1.0, rel_tol=1e-9)
        assert max(r["bin"] for r in h if r["label"] == cls) <= 50
