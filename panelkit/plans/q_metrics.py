"""Evaluation queries M01-M14 on the two scored stand-ins.

``scored``        2 labels, continuous scores, rows = documents
``scored_panel``  5 labels, tied scores (train rate by product and state)
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import panel as P
from ..operators import profile as A
from ..operators import ranking as R
from ..operators.running import md5_sql
from ..sources import standins as S
from .catalog import query, r6
from .sql_standins import with_ctes

EP = S.EVENT_PRODUCTS


def _rounded(df, keep=()):
    return df.select(*[r6(c).alias(c) if t == "double" and c not in keep else F.col(c)
                       for c, t in df.dtypes])


# --- SQL building blocks ----------------------------------------------------------

def _conf(src):
    def cnt(cond):
        return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"
    return (f"SELECT target, {cnt('y = 1 AND yhat = 1')} AS tp, {cnt('y = 0 AND yhat = 1')} AS fp, "
            f"{cnt('y = 1 AND yhat = 0')} AS fn, {cnt('y = 0 AND yhat = 0')} AS tn "
            f"FROM {src} GROUP BY target")


def _div(a, b):
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / ({b}) END"


def _per_target(src):
    return (f"SELECT target, {_div('tp', 'tp + fp')} AS precision, {_div('tp', 'tp + fn')} AS recall, "
            f"{_div('2 * tp', '2 * tp + fp + fn')} AS f1, tp + fn AS n_true, tp + fp AS n_pred, "
            f"tp, fp, fn FROM ({_conf(src)})")


def _averaged(src):
    a = (f"SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, avg(precision) AS p_macro, "
         f"avg(recall) AS r_macro, avg(f1) AS f_macro, sum(n_true * precision) AS p_w, "
         f"sum(n_true * recall) AS r_w, sum(n_true * f1) AS f_w, sum(n_true) AS w "
         f"FROM ({_per_target(src)})")
    rows = [("precision", "micro", _div("tp", "tp + fp")), ("recall", "micro", _div("tp", "tp + fn")),
            ("f1", "micro", _div("2 * tp", "2 * tp + fp + fn")),
            ("precision", "macro", "p_macro"), ("recall", "macro", "r_macro"),
            ("f1", "macro", "f_macro"), ("precision", "weighted", _div("p_w", "w")),
            ("recall", "weighted", _div("r_w", "w")), ("f1", "weighted", _div("f_w", "w"))]
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, '{av}' AS average, round(CAST({v} AS DOUBLE), 6) AS value FROM ({a})"
        for m, av, v in rows)


def _cum(src, keyed=True):
    part = "PARTITION BY target " if keyed else ""
    k = "target, " if keyed else ""
    return (f"SELECT *, sum(pos) OVER ({part}ORDER BY proba DESC) AS cum_pos, "
            f"sum(neg) OVER ({part}ORDER BY proba DESC) AS cum_neg, "
            f"sum(pos) OVER ({part.strip() and 'PARTITION BY target'}) AS P, "
            f"sum(neg) OVER ({part.strip() and 'PARTITION BY target'}) AS N FROM ("
            f"SELECT {k}proba, sum(y) AS pos, sum(1 - y) AS neg FROM {src} GROUP BY {k}proba)")


def _auc_table(src):
    per = (f"SELECT target, sum(neg * (cum_pos - pos / 2.0)) / (max(P) * max(N)) AS auc, max(P) AS P "
           f"FROM ({_cum(src)}) WHERE P > 0 AND N > 0 GROUP BY target")
    valid = f"(SELECT s.* FROM {src} s WHERE s.target IN (SELECT target FROM ({per})))"
    micro = f"SELECT sum(neg * (cum_pos - pos / 2.0)) / (max(P) * max(N)) AS v FROM ({_cum(valid, False)})"
    return (f"SELECT 'micro' AS average, round(v, 6) AS roc_auc FROM ({micro}) UNION ALL "
            f"SELECT 'macro', round(avg(auc), 6) FROM ({per}) UNION ALL "
            f"SELECT 'weighted', round(sum(auc * P) / sum(P), 6) FROM ({per})")


def _pr_points(src):
    return (f"SELECT target, proba AS threshold, cum_pos / (cum_pos + cum_neg) AS precision, "
            f"cum_pos / P AS recall FROM ({_cum(src)}) WHERE P > 0")


# --- queries ------------------------------------------------------------------------

@query("m01_confusion_counts", with_ctes(_conf("scored"), "scored"))
def m01_confusion_counts(spark, sf):
    """Tp / fp / fn / tn per target."""
    return M.confusion(S.scored(spark, sf))


@query("m02_averaged_scores", with_ctes(_averaged("scored_panel"), "scored_panel"))
def m02_averaged_scores(spark, sf):
    """Precision / recall / F1, micro / macro / weighted (zero division 0)."""
    return _rounded(M.averaged_scores(M.confusion(S.scored_panel(spark, sf))))


@query("m03_subset_accuracy", with_ctes(
    "SELECT round(avg(ok), 6) AS accuracy FROM (SELECT id, fetch_date, "
    "min(CAST(y = yhat AS INTEGER)) AS ok FROM scored_panel GROUP BY id, fetch_date)",
    "scored_panel"))
def m03_subset_accuracy(spark, sf):
    """Share of rows with every label right."""
    return _rounded(M.subset_accuracy(S.scored_panel(spark, sf), ["id", "fetch_date"]))


@query("m04_roc_auc", with_ctes(_auc_table("scored"), "scored"))
def m04_roc_auc(spark, sf):
    """ROC AUC micro / macro / weighted (continuous scores)."""
    return _rounded(M.roc_auc(S.scored(spark, sf)))


@query("m04_roc_auc_tied_scores", with_ctes(_auc_table("scored_panel"), "scored_panel"))
def m04_roc_auc_tied_scores(spark, sf):
    """ROC AUC with heavily tied scores (five labels)."""
    return _rounded(M.roc_auc(S.scored_panel(spark, sf)))


@query("m05_roc_curve_pooled", with_ctes(
    f"SELECT round(proba, 6) AS threshold, round({_div('cum_neg', 'N')}, 6) AS fpr, "
    f"round({_div('cum_pos', 'P')}, 6) AS tpr FROM ({_cum('scored', False)}) "
    "UNION ALL SELECT CAST(NULL AS DOUBLE), 0.0, 0.0", "scored"))
def m05_roc_curve_pooled(spark, sf):
    """ROC points of all labels pooled, with the (0, 0) start."""
    return _rounded(M.roc_curve_pooled(S.scored(spark, sf)))


@query("m05_roc_area_pooled", with_ctes(
    "SELECT round(sum(neg * (2 * cum_pos - pos) / 2.0) / (max(P) * max(N)), 6) AS area "
    f"FROM ({_cum('scored_panel', False)})", "scored_panel"))
def m05_roc_area_pooled(spark, sf):
    """Trapezoid area under the pooled ROC curve."""
    return _rounded(M.roc_area(S.scored_panel(spark, sf)))


@query("m06_pr_curve", with_ctes(
    f"SELECT target, round(threshold, 6) AS threshold, round(precision, 6) AS precision, "
    f"round(recall, 6) AS recall FROM ({_pr_points('scored')}) UNION ALL "
    "SELECT DISTINCT target, CAST(NULL AS DOUBLE), 1.0, 0.0 FROM scored "
    "WHERE target IN (SELECT target FROM scored GROUP BY target HAVING sum(y) > 0)", "scored"))
def m06_pr_curve(spark, sf):
    """Precision-recall curve per target (every threshold, plus the end point)."""
    return _rounded(M.pr_curve(S.scored(spark, sf)))


@query("m07_average_precision", with_ctes(
    f"SELECT target, round(sum(pos / P * cum_pos / (cum_pos + cum_neg)), 6) AS average_precision "
    f"FROM ({_cum('scored_panel')}) WHERE P > 0 GROUP BY target", "scored_panel"))
def m07_average_precision(spark, sf):
    """Average precision per target."""
    return _rounded(M.average_precision(S.scored_panel(spark, sf)))


def _tuned_sql(src):
    f1 = "2 * precision * recall / (precision + recall + 1e-9)"
    return (f"SELECT target, threshold, f1 FROM (SELECT target, threshold, {f1} AS f1, "
            f"row_number() OVER (PARTITION BY target ORDER BY {f1} DESC, threshold) AS rn "
            f"FROM ({_pr_points(src)})) WHERE rn = 1")


@query("m08_tuned_thresholds", with_ctes(
    f"SELECT target, round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM ({_tuned_sql('scored')})",
    "scored"))
def m08_tuned_thresholds(spark, sf):
    """F1-optimal threshold per target (ties to the lowest threshold)."""
    return _rounded(M.tune_thresholds(S.scored(spark, sf)))


@query("m09_tuned_scores", with_ctes(
    _averaged("tuned").replace("FROM tuned", "FROM tuned"), "scored",
    extra=[f"th AS ({_tuned_sql('scored')})",
           "tuned AS (SELECT s.row_id, s.target, s.y, s.proba, "
           "CAST(s.proba >= th.threshold AS INTEGER) AS yhat FROM scored s "
           "JOIN th ON s.target = th.target)"]))
def m09_tuned_scores(spark, sf):
    """Tuned thresholds applied, precision / recall / F1 recomputed."""
    s = S.scored(spark, sf)
    th = M.tune_thresholds(s)
    return _rounded(M.averaged_scores(M.confusion(M.apply_thresholds(s, th))))


@query("m10_per_target_table", with_ctes(
    "SELECT target, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1, n_true, n_pred FROM (" + _per_target("scored_panel") + ")",
    "scored_panel"))
def m10_per_target_table(spark, sf):
    """F1, precision, recall, true and predicted counts per target."""
    return _rounded(M.per_target(M.confusion(S.scored_panel(spark, sf))))


@query("m11_hits_at_k", with_ctes(
    """SELECT round(avg(CAST(coalesce(hit, 0) AS DOUBLE)), 6) AS hits_at_2 FROM
       (SELECT DISTINCT id, fetch_date FROM scored_panel) r LEFT JOIN
       (SELECT id, fetch_date, max(y) AS hit FROM (SELECT *, row_number() OVER (
          PARTITION BY id, fetch_date ORDER BY proba DESC, target) AS rk FROM scored_panel)
        WHERE rk <= 2 GROUP BY id, fetch_date) h USING (id, fetch_date)""", "scored_panel"))
def m11_hits_at_k(spark, sf):
    """Hits@2 over rows (any true label among the top-2 scores)."""
    return _rounded(M.hits_at_k(S.scored_panel(spark, sf), ["id", "fetch_date"], 2))


def _event_long(spark, sf):
    lab = P.build_labels(S.event_panel(spark, sf), EP)
    return A.labels_long(lab, ["target__" + p for p in EP], ["id", "fetch_date"])


def _event_long_sql():
    tgt = ", ".join(
        f"coalesce(CAST(({p} = 0 AND lead({p}) OVER w = 1) AS INTEGER), 0) AS target__{p}"
        for p in EP)
    lab = (f"SELECT * FROM (SELECT *, {tgt}, lead(id) OVER w AS _nid FROM event_panel "
           "WINDOW w AS (PARTITION BY id ORDER BY fetch_date)) WHERE _nid IS NOT NULL")
    return "ev_long AS (" + " UNION ALL ".join(
        f"SELECT id, fetch_date, 'target__{p}' AS target, target__{p} AS y FROM ({lab})"
        for p in EP) + ")"


_SPLIT = f"DATE '{S.EVENT_SPLIT_DATE}'"
# Fixed value: the reference's constant-baseline decision threshold.
BASELINE_THRESHOLD = 0.02


def _baseline_input(spark, sf):
    long = _event_long(spark, sf)
    train, test = P.split_by_date(long, S.EVENT_SPLIT_DATE)
    return train.groupBy("target").agg(F.avg("y").alias("rate")), test


_BASE_CTES = [
    _event_long_sql(),
    f"ev_rates AS (SELECT target, avg(y) AS rate FROM ev_long WHERE fetch_date <= {_SPLIT} "
    "GROUP BY target)",
    f"ev_const AS (SELECT l.id, l.fetch_date, l.target, l.y, r.rate AS proba, "
    f"CAST(r.rate > {BASELINE_THRESHOLD} AS INTEGER) AS yhat FROM ev_long l JOIN ev_rates r "
    f"ON l.target = r.target WHERE l.fetch_date > {_SPLIT})",
]


@query("m12_constant_mean_baseline", with_ctes(_averaged("ev_const"), "event_panel",
                                               extra=_BASE_CTES))
def m12_constant_mean_baseline(spark, sf):
    """Train acquisition rate as the score; 1 where rate > threshold."""
    rates, test = _baseline_input(spark, sf)
    base = M.constant_mean_baseline(test, rates, BASELINE_THRESHOLD)
    return _rounded(M.averaged_scores(M.confusion(base)))


@query("m13_frequency_baseline", with_ctes(
    _averaged("ev_freq"), "event_panel", extra=_BASE_CTES + [
        f"""ev_freq AS (SELECT id, fetch_date, target, y, CAST(rn <= k AS INTEGER) AS yhat FROM (
          SELECT t.*, row_number() OVER (PARTITION BY t.target ORDER BY
            {md5_sql(['t.id', 't.fetch_date', 't.target'], 42)}) AS rn,
            floor(r.rate * count(*) OVER (PARTITION BY t.target)) AS k
          FROM (SELECT * FROM ev_long WHERE fetch_date > {_SPLIT}) t
          JOIN ev_rates r ON t.target = r.target))"""]))
def m13_frequency_baseline(spark, sf):
    """Per label, train-rate share of seeded-random test rows set to 1."""
    rates, test = _baseline_input(spark, sf)
    rnd = R.random_positives(test, rates, ["id", "fetch_date"], 42)
    return _rounded(M.averaged_scores(M.confusion(rnd)))


@query("m14_constant_score_auc", with_ctes(
    _auc_table("(SELECT id, fetch_date, target, y, 0.5 AS proba FROM ev_long "
               f"WHERE fetch_date > {_SPLIT})"), "event_panel", extra=_BASE_CTES))
def m14_constant_score_auc(spark, sf):
    """ROC AUC of a constant 0.5 score."""
    _, test = _baseline_input(spark, sf)
    return _rounded(M.roc_auc(M.constant_score(test, 0.5)))


@query("m14_label_frequency_auc", with_ctes(
    _auc_table("(SELECT id, fetch_date, target, y, proba FROM ev_const)"), "event_panel",
    extra=_BASE_CTES))
def m14_label_frequency_auc(spark, sf):
    """ROC AUC of the label-frequency score (constant per label)."""
    rates, test = _baseline_input(spark, sf)
    return _rounded(M.roc_auc(M.constant_mean_baseline(test, rates, BASELINE_THRESHOLD)))


@query("f18_flat_metric_names", with_ctes(
    "SELECT metric || '_' || average AS name, value FROM (" + _averaged("scored_panel") + ")",
    "scored_panel"))
def f18_flat_metric_names(spark, sf):
    """the metric table flattened to one (name, value) pair per cell."""
    t = _rounded(M.averaged_scores(M.confusion(S.scored_panel(spark, sf))))
    return t.select(F.concat_ws("_", "metric", "average").alias("name"), "value")


def _metric_table_sql(src, rows):
    return f"""SELECT metric, round(max(CASE WHEN average = 'micro' THEN value END), 6) AS micro,
        round(max(CASE WHEN average = 'macro' THEN value END), 6) AS macro,
        round(max(CASE WHEN average = 'weighted' THEN value END), 6) AS average
      FROM ({_averaged(src)}
        UNION ALL SELECT 'roc_auc', average, roc_auc FROM ({_auc_table(src)})
        UNION ALL SELECT 'accuracy', 'micro', -1.0 UNION ALL SELECT 'accuracy', 'macro', -1.0
        UNION ALL SELECT 'accuracy', 'weighted', avg(ok) FROM (SELECT {rows},
          min(CAST(y = yhat AS INTEGER)) AS ok FROM {src} GROUP BY {rows}))
      GROUP BY metric"""


@query("m02_m04_metric_table", with_ctes(_metric_table_sql("scored_panel", "id, fetch_date"),
                                         "scored_panel"))
def m02_m04_metric_table(spark, sf):
    """M02 + M03 + M04: the full metric table (Accuracy, Precision, Recall, F1,
    ROC AUC x micro / macro / average)."""
    return _rounded(M.metric_table(S.scored_panel(spark, sf), ["id", "fetch_date"]))
