"""Fitted fills and running sums give as many rows as they get."""

import pytest
from pyspark.sql import functions as F

from panelkit import session
from panelkit.operators import features, metrics, profile, running
from panelkit.sources import standins as S


def test_batch_without_income_keeps_its_rows(spark, sf_small):
    snap = S.snapshot(spark, sf_small).limit(50)
    none = snap.withColumn("income", F.lit(None).cast("double"))
    out = features.process_frame(none, S.ORDER_PRODUCTS)
    assert out.count() == none.count() == 50
    one = snap.limit(1).withColumn("income", F.lit(-1.0))
    assert features.process_frame(one, S.ORDER_PRODUCTS).count() == 1


def test_median_of_nothing_is_one_null_row(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert [r.median for r in profile.median(empty, "x").collect()] == [None]
    assert profile.describe(empty, "x").count() == 1


def test_running_sums_keep_null_keys_and_values(spark):
    rows = [("a", 1.0, 1), ("a", None, 2), (None, 3.0, 4), ("b", None, 8), ("b", None, 16)]
    df = spark.createDataFrame(rows, "k string, o double, v long")
    for down in (True, False):
        got = sorted((str(r.k), str(r.o), r.cum_v) for r in running.running_sums(df, ["k"], "o", down, ["v"], tiebreak=[F.col("v")]).collect())
        a = [("a", "1.0", 1), ("a", "None", 3)] if down else [("a", "1.0", 3), ("a", "None", 2)]
        assert got == sorted([("None", "3.0", 4), *a, ("b", "None", 8), ("b", "None", 24)])


def test_pr_curve_has_every_threshold(spark):
    rows = [("t", y, p) for y, p in ((0, .1), (0, .4), (1, .35), (1, .8))]
    got = metrics.pr_curve(spark.createDataFrame(rows, "target string, y int, proba double")).collect()
    assert sorted((r.threshold or 9, round(r.precision, 4), r.recall) for r in got) == [
        (.1, .5, 1.0), (.35, .6667, 1.0), (.4, .5, .5), (.8, 1.0, .5), (9, 1.0, 0.0)]


def test_no_local_scratch_folder_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())
