"""Evaluation against brute-force definitions on small fixtures."""

import itertools

import numpy as np
import pandas as pd

from panelkit.operators import metrics as M


def _long(spark, y, p, targets=("t1", "t2")):
    rows = []
    n = len(y[0])
    for j, t in enumerate(targets):
        for i in range(n):
            rows.append((i, t, int(y[j][i]), float(p[j][i]), int(p[j][i] >= 0.5)))
    return spark.createDataFrame(rows, "row_id long, target string, y int, proba double, yhat int")


def _auc_pairs(y, p):
    pos = [s for s, t in zip(p, y) if t == 1]
    neg = [s for s, t in zip(p, y) if t == 0]
    tot = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


Y = [[1, 0, 1, 0, 0, 1, 0, 0], [0, 0, 1, 1, 0, 0, 0, 1]]
PR = [[0.9, 0.1, 0.6, 0.6, 0.2, 0.6, 0.3, 0.05], [0.2, 0.2, 0.8, 0.4, 0.4, 0.1, 0.7, 0.9]]


def test_auc_matches_pairwise_with_ties(spark):
    per = {r.target: r.auc for r in M.roc_auc_per_target(_long(spark, Y, PR)).collect()}
    assert abs(per["t1"] - _auc_pairs(Y[0], PR[0])) < 1e-12
    assert abs(per["t2"] - _auc_pairs(Y[1], PR[1])) < 1e-12
    tab = {r.average: r.roc_auc for r in M.roc_auc(_long(spark, Y, PR)).collect()}
    pooled = _auc_pairs(Y[0] + Y[1], PR[0] + PR[1])
    assert abs(tab["micro"] - pooled) < 1e-12
    assert abs(tab["macro"] - (per["t1"] + per["t2"]) / 2) < 1e-12


def test_auc_invariant_to_monotone_map(spark):
    a = {r.average: r.roc_auc for r in M.roc_auc(_long(spark, Y, PR)).collect()}
    sq = [[v ** 3 for v in row] for row in PR]
    b = {r.average: r.roc_auc for r in M.roc_auc(_long(spark, Y, sq)).collect()}
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_label_with_one_class_left_out(spark):
    y = [Y[0], [0] * 8]
    per = M.roc_auc_per_target(_long(spark, y, PR)).collect()
    assert [r.target for r in per] == ["t1"]


def test_micro_recall_is_pooled(spark):
    lg = _long(spark, Y, PR)
    conf = M.confusion(lg)
    tab = {(r.metric, r.average): r.value for r in M.averaged_scores(conf).collect()}
    pdf = lg.toPandas()
    tp = ((pdf.y == 1) & (pdf.yhat == 1)).sum()
    assert abs(tab[("recall", "micro")] - tp / pdf.y.sum()) < 1e-12


def test_average_precision_brute_force(spark):
    ap = {r.target: r.average_precision for r in M.average_precision(_long(spark, Y, PR)).collect()}
    for j, t in enumerate(["t1", "t2"]):
        y, p = np.array(Y[j]), np.array(PR[j])
        exp, prev_r = 0.0, 0.0
        for thr in sorted(set(p), reverse=True):
            pred = p >= thr
            tp = (pred & (y == 1)).sum()
            r, prec = tp / y.sum(), tp / pred.sum()
            exp += (r - prev_r) * prec
            prev_r = r
        assert abs(ap[t] - exp) < 1e-12


def test_tuned_threshold_ties_take_lowest(spark):
    # Two thresholds give the same best F1; the lower one is returned.
    y = [[1, 1, 0, 0]]
    p = [[0.9, 0.8, 0.7, 0.1]]
    th = M.tune_thresholds(_long(spark, y, p, ("t",))).first()
    assert th.threshold == 0.8


def test_hits_at_k_grows_with_k(spark):
    lg = _long(spark, Y, PR)
    h1 = M.hits_at_k(lg, ["row_id"], 1).first()[0]
    h2 = M.hits_at_k(lg, ["row_id"], 2).first()[0]
    assert h1 <= h2


def test_pr_curve_ends_at_precision_one(spark):
    c = M.pr_curve(_long(spark, Y, PR)).toPandas()
    ends = c[c.threshold.isna()]
    assert set(ends.target) == {"t1", "t2"} and (ends.precision == 1.0).all()
    assert c.groupby("target").recall.max().eq(1.0).all()


def test_random_positives_count(spark):
    from panelkit.operators.ranking import random_positives
    lg = _long(spark, Y, PR).drop("yhat")
    rates = spark.createDataFrame(pd.DataFrame({"target": ["t1", "t2"], "rate": [0.25, 0.5]}))
    out = random_positives(lg, rates, ["row_id"], 42).toPandas()
    assert out.groupby("target").yhat.sum().to_dict() == {"t1": 2, "t2": 4}
