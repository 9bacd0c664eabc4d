"""Model queries E06-E14, S08, S09 on the client snapshot.

Training rows: snapshot -> labels (W01, W03, W04) -> split (P09) -> cleaning
(P08) -> train window (P10). ML outputs have no SQL twin; the weight and
parameter tables do.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..functions.rows import json_to_rows
from ..operators import metrics as M
from ..operators import model as MD
from ..operators import panel as P
from ..operators import pipeline as PL
from ..operators.lookup import name_predictions
from ..schema import TARGET_PREFIX
from ..session import scratch_dir
from ..sources import standins as S
from .catalog import query, r6
from .sql_standins import with_ctes

OP = S.ORDER_PRODUCTS
TARGETS = [TARGET_PREFIX + p for p in OP]
_CACHE: dict = {}


def labelled_split(spark, sf):
    lab = P.build_labels(S.snapshot(spark, sf), OP)
    train, test = P.split_by_date(lab, S.ORDER_SPLIT_DATE)
    return P.since(P.clean(train), S.ORDER_START_DATE), P.clean(test)


def fitted_model(spark, sf) -> MD.ProductModel:
    """E08 (fit part), memoised per session and input folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        train, _ = labelled_split(spark, sf)
        _CACHE[key] = MD.fit_product_model(train, OP, TARGETS)
    return _CACHE[key]


def target_names(spark):
    return spark.createDataFrame([(TARGET_PREFIX + c, n) for c, n in S.ORDER_PRODUCT_NAMES],
                                 "target string, name string")


@query("e06_e10_fit_and_score")
def e06_e10_fit_and_score(spark, sf):
    """E06 + E09 + E10: one GBT per label (weights 1:4); test rows scored to
    probabilities and 0/1 labels (long form)."""
    _, test = labelled_split(spark, sf)
    s = fitted_model(spark, sf).score(test)
    return s.select("id", "fetch_date", "target", "y", r6("proba").alias("proba"), "yhat")


def _train_sql():
    from .q_aggs import SNAPSHOT_DTYPES
    nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c, _ in SNAPSHOT_DTYPES)
    tg = ", ".join(
        f"coalesce(CAST(({p} = 0 AND lead({p}) OVER w = 1) AS INTEGER), 0) AS target__{p}"
        for p in OP)
    return (f"SELECT * FROM (SELECT *, {tg}, lead(id) OVER w AS _nid FROM snapshot "
            f"WINDOW w AS (PARTITION BY id ORDER BY fetch_date)) WHERE _nid IS NOT NULL "
            f"AND fetch_date <= DATE '{S.ORDER_SPLIT_DATE}' AND {nulls} < 10 "
            f"AND ind_deceased = 'N' AND fetch_date >= DATE '{S.ORDER_START_DATE}'")


def _test_sql():
    from .q_aggs import SNAPSHOT_DTYPES
    nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c, _ in SNAPSHOT_DTYPES)
    return (f"SELECT * FROM (SELECT *, lead(id) OVER w AS _nid FROM snapshot "
            f"WINDOW w AS (PARTITION BY id ORDER BY fetch_date)) WHERE _nid IS NOT NULL "
            f"AND fetch_date > DATE '{S.ORDER_SPLIT_DATE}' AND {nulls} < 10 AND ind_deceased = 'N'")


@query("e07_balanced_weights", with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS target, round((count(*) - sum({t})) / nullif(sum({t}), 0), 6) AS pos_weight "
    f"FROM ({_train_sql()})" for t in TARGETS), "snapshot"))
def e07_balanced_weights(spark, sf):
    """Balanced positive weight (neg / pos) per label on the train rows."""
    train, _ = labelled_split(spark, sf)
    w = MD.balanced_weights(train, TARGETS)
    return w.select("target", r6("pos_weight").alias("pos_weight"))


@query("e08_train_job", with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS target, count(*) AS n_train, CAST(sum({t}) AS BIGINT) AS n_pos "
    f"FROM ({_train_sql()}) HAVING count(DISTINCT {t}) > 1" for t in TARGETS), "snapshot"))
def e08_train_job(spark, sf):
    """E08 + S08: clean, label, split, keep varying labels, fit, save; returns
    per-label train counts of the saved model."""
    model = fitted_model(spark, sf)
    path = scratch_dir(spark, "model")
    model.save(path, spark)
    train, _ = labelled_split(spark, sf)
    agg = train.agg(*[F.sum(t).cast("long").alias(t) for t in model.targets],
                    F.count(F.lit(1)).alias("_n"))
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col("_n").alias("n_train"),
                 F.col(t).alias("n_pos")) for t in model.targets])).alias("r")).select("r.*")


@query("e11_feature_importance")
def e11_feature_importance(spark, sf):
    """Labelled feature importances per target, above 0, descending."""
    rows = fitted_model(spark, sf).importances(0.0)
    df = spark.createDataFrame(rows, "target string, feature string, importance double")
    return df.orderBy("target", F.desc("importance"))


def _requests(spark, sf):
    from ..schema import column_names
    snap = S.snapshot(spark, sf)
    _, test = P.split_by_date(snap, S.ORDER_SPLIT_DATE)
    req = S.requests_from(test)
    schema = snap.schema
    return json_to_rows(req, schema), [c for c in column_names() if c in snap.columns]


@query("e13_request_labels")
def e13_request_labels(spark, sf):
    """JSON requests -> typed rows -> mean-income fill -> 0/1 per label, named."""
    model = fitted_model(spark, sf)
    rows, _ = _requests(spark, sf)
    train, _ = labelled_split(spark, sf)
    income_mean = train.agg(F.avg("income")).first()[0]
    rows = rows.withColumn("income", F.coalesce("income", F.lit(float(income_mean))))
    s = model.score(rows).select("id", "fetch_date", "target", F.col("yhat").alias("value"))
    return name_predictions(s, target_names(spark)).select("id", "fetch_date", "name", "value")


@query("e14_request_recommendations")
def e14_request_recommendations(spark, sf):
    """JSON requests -> ranked recommendations above 0.01 (4 places)."""
    model = fitted_model(spark, sf)
    rows, _ = _requests(spark, sf)
    train, _ = labelled_split(spark, sf)
    income_mean = train.agg(F.avg("income")).first()[0]
    rows = rows.withColumn("income", F.coalesce("income", F.lit(float(income_mean))))
    rec = MD.recommend(model, rows)
    return name_predictions(rec, target_names(spark)).select(
        "id", "fetch_date", "name", "proba", "rank")


@query("s08_model_roundtrip")
def s08_model_roundtrip(spark, sf):
    """Save the fitted model, load it back, score the test rows."""
    model = fitted_model(spark, sf)
    path = scratch_dir(spark, "model")
    model.save(path, spark)
    loaded = MD.ProductModel.load(spark, path)
    _, test = labelled_split(spark, sf)
    s = loaded.score(test)
    return s.select("id", "fetch_date", "target", r6("proba").alias("proba"), "yhat")


@query("s08_pipeline_roundtrip", with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS target, (SELECT count(*) FROM ({_test_sql()})) AS n_rows, 0 AS n_different "
    f"FROM ({_train_sql()}) HAVING count(DISTINCT {t}) > 1" for t in TARGETS), "snapshot"))
def s08_pipeline_roundtrip(spark, sf):
    """S08 + E05: the product model as one ``PipelineModel``, written, loaded, and its scores of the
    test rows compared with the fitted model's: rows per label, and rows with another score (none)."""
    model = fitted_model(spark, sf)
    path = scratch_dir(spark, "pipeline-model")
    PL.as_pipeline(model).write().save(path)
    _, test = labelled_split(spark, sf)
    keys = ["id", "fetch_date", "target"]
    fitted = model.score(test).select(*keys, "proba", "yhat")
    loaded = PL.score_pipeline(PipelineModel.load(path), test)
    both = fitted.join(loaded.select(*keys, F.col("proba").alias("_p"), F.col("yhat").alias("_y")), keys, "full")
    same = F.col("proba").eqNullSafe(F.col("_p")) & F.col("yhat").eqNullSafe(F.col("_y"))
    return both.groupBy("target").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.sum((~same).cast("long")).alias("n_different"))


def _params_sql():
    t = _train_sql()
    names = " UNION ALL ".join(
        f"SELECT 'target__{c}' AS target, '{n}' AS name_en" for c, n in S.ORDER_PRODUCT_NAMES)
    kept = " UNION ALL ".join(
        f"SELECT '{tt}' AS target FROM ({t}) HAVING count(DISTINCT {tt}) > 1" for tt in TARGETS)
    return (f"SELECT n.target, n.name_en, (SELECT round(avg(income), 6) FROM ({t})) AS income_mean "
            f"FROM ({names}) n WHERE n.target IN ({kept})")


@query("s09_model_params", with_ctes(_params_sql(), "snapshot"))
def s09_model_params(spark, sf):
    """Kept target names and the train mean income, written as JSON lines and read back."""
    train, _ = labelled_split(spark, sf)
    kept = MD.varying_targets(train, TARGETS)
    names = target_names(spark).where(F.col("target").isin(kept)) \
        .select("target", F.col("name").alias("name_en"))
    path = scratch_dir(spark, "model-params")
    MD.write_params(MD.model_params(train, names), path)
    return MD.read_params(spark, path).select("target", "name_en", r6("income_mean").alias("income_mean"))


@query("m02_model_scores")
def m02_model_scores(spark, sf):
    """M02 on the model's test predictions (precision / recall / F1 averages)."""
    _, test = labelled_split(spark, sf)
    s = fitted_model(spark, sf).score(test)
    out = M.averaged_scores(M.confusion(s))
    return out.select("metric", "average", r6("value").alias("value"))


@query("m04_model_roc_auc")
def m04_model_roc_auc(spark, sf):
    """M04 on the model's test probabilities."""
    _, test = labelled_split(spark, sf)
    s = fitted_model(spark, sf).score(test)
    return M.roc_auc(s).select("average", r6("roc_auc").alias("roc_auc"))
