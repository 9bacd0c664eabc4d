"""Driver contract: entry() runs; every query key has a callable; SQL keys are a subset."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"product", "fetch_date", "acquisitions"}


def test_registry_shape():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 130


def test_model_queries_run(spark, sf_small):
    """Fitted models: probabilities, row counts, and scores above the constant baseline."""
    from pyspark.sql import functions as F

    from panelkit.plans.q_model import fitted_model, labelled_split
    q = E.queries()
    model = fitted_model(spark, sf_small)
    _, test = labelled_split(spark, sf_small)
    n = test.count()
    scored = q["e06_e10_fit_and_score"](spark, sf_small)
    assert scored.where("proba < 0 or proba > 1 or proba is null").count() == 0
    assert scored.count() == n * len(model.targets)
    assert {r.yhat for r in scored.select("yhat").distinct().collect()} <= {0, 1}
    loaded = q["s08_model_roundtrip"](spark, sf_small)
    same = model.score(test).select("id", "fetch_date", "target", F.round("proba", 6).alias("proba"), "yhat")
    assert loaded.exceptAll(same.select(loaded.columns)).count() == 0 and loaded.count() == same.count()
    auc = {r.average: r.roc_auc for r in q["m04_model_roc_auc"](spark, sf_small).collect()}
    assert auc["micro"] > 0.5
    importance = q["e11_feature_importance"](spark, sf_small).groupBy("target").agg(F.sum("importance").alias("s")).collect()
    assert importance and all(abs(r.s - 1) < 1e-6 for r in importance)
    batch = q["e14_request_recommendations"](spark, sf_small)
    assert batch.where("proba < 0.01").count() == 0 and batch.count() > 0
    assert q["q10_stream_scoring"](spark, sf_small).count() == batch.count()
