"""Multi-label evaluation (M01-M14) on the long form (row..., target, y, yhat, proba).

Confusion counts and averages are grouped aggregations over targets. Curves
and AUC group rows by (target, score) first -- a hot score collapses to one
row -- and take running totals with ``running.running_sums``, so a target
with most of the rows is still spread over many tasks.

Conventions follow the reference's library calls: zero division gives 0;
ROC AUC leaves out labels with one class; the PR curve keeps every distinct
threshold and ends with (precision 1, recall 0); the
ROC curve keeps every distinct threshold (the area is the same as with
collinear points dropped).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import running_sums


def _div0(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


# --- M01-M03, M09, M10 --------------------------------------------------------

def confusion(long: DataFrame, target: str = "target") -> DataFrame:
    """Tp, fp, fn, tn per target."""
    y, p = F.col("y"), F.col("yhat")

    def cnt(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    return long.groupBy(target).agg(cnt((y == 1) & (p == 1)).alias("tp"),
                                    cnt((y == 0) & (p == 1)).alias("fp"),
                                    cnt((y == 1) & (p == 0)).alias("fn"),
                                    cnt((y == 0) & (p == 0)).alias("tn"))


def per_target(conf: DataFrame, target: str = "target", keep: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1, true and predicted counts per target (and ``keep``)."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return conf.select(target, _div0(tp, tp + fp).alias("precision"),
                       _div0(tp, tp + fn).alias("recall"),
                       _div0(2 * tp, 2 * tp + fp + fn).alias("f1"),
                       (tp + fn).alias("n_true"), (tp + fp).alias("n_pred"), *keep)


def averaged_scores(conf: DataFrame) -> DataFrame:
    """Precision / recall / F1 with micro, macro and weighted averages.

    Output is long: (metric, average, value). Targets are few, so this is a
    small second-level aggregation.
    """
    t = per_target(conf, keep=("tp", "fp", "fn"))
    w = F.col("n_true").cast("double")
    agg = t.agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
        F.avg("precision").alias("p_macro"), F.avg("recall").alias("r_macro"),
        F.avg("f1").alias("f_macro"),
        F.sum(w * F.col("precision")).alias("p_w"), F.sum(w * F.col("recall")).alias("r_w"),
        F.sum(w * F.col("f1")).alias("f_w"), F.sum(w).alias("w"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rows = [
        ("precision", "micro", _div0(tp, tp + fp)), ("recall", "micro", _div0(tp, tp + fn)),
        ("f1", "micro", _div0(2 * tp, 2 * tp + fp + fn)),
        ("precision", "macro", F.col("p_macro")), ("recall", "macro", F.col("r_macro")),
        ("f1", "macro", F.col("f_macro")),
        ("precision", "weighted", _div0(F.col("p_w"), F.col("w"))),
        ("recall", "weighted", _div0(F.col("r_w"), F.col("w"))),
        ("f1", "weighted", _div0(F.col("f_w"), F.col("w"))),
    ]
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit(a).alias("average"),
                 v.cast("double").alias("value")) for m, a, v in rows])).alias("r")).select("r.*")


def subset_accuracy(long: DataFrame, row_cols: Sequence[str]) -> DataFrame:
    """Share of rows whose labels are all predicted right."""
    per = long.groupBy(*row_cols).agg(F.min((F.col("y") == F.col("yhat")).cast("int")).alias("ok"))
    return per.agg(F.avg("ok").alias("accuracy"))


def apply_thresholds(long: DataFrame, thresholds: DataFrame, target: str = "target") -> DataFrame:
    """yhat = proba >= the target's threshold (a per-target table,
    one row per target, hence broadcast)."""
    j = long.drop("yhat").join(F.broadcast(thresholds.select(target, "threshold")), target)
    return j.withColumn("yhat", (F.col("proba") >= F.col("threshold")).cast("int")).drop("threshold")


# --- M04-M08: curves ------------------------------------------------------------

def score_groups(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., proba, pos, neg): rows per distinct score."""
    return long.groupBy(*keys, "proba").agg(
        F.sum(F.col("y")).cast("long").alias("pos"),
        F.sum(1 - F.col("y")).cast("long").alias("neg"))


def _cumulative(long: DataFrame, keys: Sequence[str], grouped: bool = False) -> DataFrame:
    """Per distinct score (descending): pos, neg, cum_pos, cum_neg (scores >= s),
    and the key totals P, N. ``grouped`` = the input is already score groups.

    The score groups are read three times (bounds, window, totals), so they are
    persisted; they are at most (keys x distinct scores) rows.
    """
    from pyspark import StorageLevel
    g = long if grouped else score_groups(long, keys)
    g = g.persist(StorageLevel.MEMORY_AND_DISK)
    c = running_sums(g, list(keys), "proba", True, ["pos", "neg"])
    if keys:
        tot = g.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
        return c.join(F.broadcast(tot), list(keys))
    tot = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).withColumn("_k", F.lit(0))
    return c.withColumn("_k", F.lit(0)).join(F.broadcast(tot), "_k").drop("_k")


def roc_auc_per_target(long: DataFrame, target: str = "target",
                       grouped: bool = False) -> DataFrame:
    """AUC of each target with both classes present: (target, auc, P, N)."""
    c = _cumulative(long, [target], grouped)
    part = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0)
    return (c.where((F.col("P") > 0) & (F.col("N") > 0))
             .groupBy(target, "P", "N")
             .agg((F.sum(part) / (F.first("P") * F.first("N"))).alias("auc")))


def roc_auc(long: DataFrame, target: str = "target") -> DataFrame:
    """ROC AUC micro / macro / weighted over labels with both classes.

    Micro pools all valid labels' (y, score) pairs into one ranking.
    """
    from pyspark import StorageLevel
    g = score_groups(long, [target]).persist(StorageLevel.MEMORY_AND_DISK)
    # One row per label; read twice (averages, valid-label filter): keep it.
    per = roc_auc_per_target(g, target, grouped=True).persist(StorageLevel.MEMORY_AND_DISK)
    macro = per.agg(F.avg("auc").alias("macro"),
                    (F.sum(F.col("auc") * F.col("P")) / F.sum("P")).alias("weighted"))
    # Pool the valid labels' score groups (not the rows) for the micro average.
    valid = (g.join(F.broadcast(per.select(target)), target)
              .groupBy("proba").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    c = _cumulative(valid, [], grouped=True)
    part = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0)
    micro = c.agg((F.sum(part) / (F.first("P") * F.first("N"))).alias("micro"))
    both = micro.withColumn("_k", F.lit(0)).join(F.broadcast(macro.withColumn("_k", F.lit(0))), "_k")
    return both.select(F.explode(F.array(
        F.struct(F.lit("micro").alias("average"), F.col("micro").alias("roc_auc")),
        F.struct(F.lit("macro").alias("average"), F.col("macro").alias("roc_auc")),
        F.struct(F.lit("weighted").alias("average"), F.col("weighted").alias("roc_auc")))
    ).alias("r")).select("r.*")


def roc_curve_pooled(long: DataFrame) -> DataFrame:
    """Pooled ROC points (threshold, fpr, tpr), with the (0, 0) start."""
    c = _cumulative(long, [])
    pts = c.select(F.col("proba").alias("threshold"),
                   _div0(F.col("cum_neg"), F.col("N")).alias("fpr"),
                   _div0(F.col("cum_pos"), F.col("P")).alias("tpr"))
    start = long.agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def roc_area(long: DataFrame) -> DataFrame:
    """Trapezoid area under the pooled ROC curve (all labels pooled).

    Each distinct score adds a trapezoid of width neg/N between heights
    (cum_pos - pos)/P and cum_pos/P, summed straight from the score groups.
    """
    c = _cumulative(long, [])
    part = F.col("neg") * (2 * F.col("cum_pos") - F.col("pos")) / 2.0
    return c.agg(_div0(F.sum(part), F.first("P") * F.first("N")).alias("area"))


def pr_curve(long: DataFrame, target: str = "target") -> DataFrame:
    """Per target (threshold, precision, recall) at every threshold, plus
    the end point (precision 1, recall 0, threshold NULL). Targets without
    positives are left out."""
    c = _cumulative(long, [target]).where(F.col("P") > 0)
    pts = c.select(target, F.col("proba").alias("threshold"),
                      (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                      (F.col("cum_pos") / F.col("P")).alias("recall"))
    ends = c.select(target).distinct().select(
        target, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"))
    return pts.unionByName(ends)


def average_precision(long: DataFrame, target: str = "target") -> DataFrame:
    """Sum over thresholds of (recall gain) x precision, per target."""
    c = _cumulative(long, [target]).where(F.col("P") > 0)
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return c.groupBy(target).agg(F.sum(F.col("pos") / F.col("P") * prec).alias("average_precision"))


def tune_thresholds(long: DataFrame, target: str = "target", eps: float = 1e-9) -> DataFrame:
    """Per target the threshold with the highest F1 on the PR curve
    (F1 = 2PR / (P + R + eps)); ties take the lowest threshold."""
    c = pr_curve(long, target).where(F.col("threshold").isNotNull())
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + eps)
    c = c.withColumn("f1", f1)
    key = F.struct(F.col("f1"), (-F.col("threshold")).alias("neg_t"))
    return c.groupBy(target).agg(F.max_by("threshold", key).alias("threshold"),
                                 F.max("f1").alias("f1"))


def hits_at_k(long: DataFrame, row_cols: Sequence[str], k: int = 5,
              target: str = "target") -> DataFrame:
    """Share of rows with a true label among their top-k scored targets
    (ties by target name); rows without any hit count in the denominator."""
    from .ranking import top_k_per_row
    top = top_k_per_row(long, row_cols, k, "proba", target)
    hit = top.groupBy(*row_cols).agg(F.max("y").alias("hit"))
    rows = long.select(*row_cols).distinct()
    j = rows.join(hit, list(row_cols), "left")
    return j.agg(F.avg(F.coalesce(F.col("hit"), F.lit(0)).cast("double")).alias(f"hits_at_{k}"))


# --- M12-M14: baselines -----------------------------------------------------------

def constant_mean_baseline(test: DataFrame, train_rates: DataFrame, threshold: float,
                           target: str = "target") -> DataFrame:
    """Score every test row by its target's train rate; yhat = rate > threshold.
    ``train_rates`` (target, rate) has one row per target (bounded)."""
    j = test.drop("proba", "yhat").join(F.broadcast(train_rates), target)
    return j.select(*[c for c in test.columns if c not in ("proba", "yhat")],
                    F.col("rate").alias("proba"),
                    (F.col("rate") > threshold).cast("int").alias("yhat"))


def constant_score(long: DataFrame, value: float = 0.5) -> DataFrame:
    """A constant score for every row (AUC 0.5 per label)."""
    return long.withColumn("proba", F.lit(float(value)))


def metric_table(long: DataFrame, row_cols: Sequence[str], target: str = "target") -> DataFrame:
    """M02 + M03 + M04 as the reference's table: one row per metric (Accuracy,
    Precision, Recall, F1, ROC AUC) with micro / macro / average columns;
    'average' is the support-weighted average (subset accuracy for Accuracy,
    whose micro and macro cells are -1)."""
    scores = averaged_scores(confusion(long, target))
    auc = roc_auc(long, target).select(F.lit("roc_auc").alias("metric"), "average",
                                       F.col("roc_auc").alias("value"))
    acc = subset_accuracy(long, row_cols)
    acc_rows = acc.select(F.explode(F.array(
        F.struct(F.lit("micro").alias("average"), F.lit(-1.0).alias("value")),
        F.struct(F.lit("macro").alias("average"), F.lit(-1.0).alias("value")),
        F.struct(F.lit("weighted").alias("average"), F.col("accuracy").alias("value")))
    ).alias("r")).select(F.lit("accuracy").alias("metric"), "r.average", "r.value")
    allr = scores.unionByName(auc).unionByName(acc_rows)
    # At most 5 x 3 cells: the pivot is a tiny aggregation.
    return (allr.groupBy("metric").pivot("average", ["micro", "macro", "weighted"])
                .agg(F.first("value")).withColumnRenamed("weighted", "average"))
