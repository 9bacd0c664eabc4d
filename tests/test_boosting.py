"""Boosting of several labels at once against Spark ML's GBTClassifier."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelkit.operators import boosting as B

N_FEATURES = 8
EXCLUSIVE = [[5, 6, 7]]


@pytest.fixture(scope="module")
def frame(spark):
    """Two continuous features (one with more than 32 values), a constant one, three of one one-hot column."""
    rng = np.random.default_rng(5)
    n = 3000
    x = np.zeros((n, N_FEATURES))
    x[:, 0], x[:, 1] = rng.normal(size=n), rng.integers(0, 9, n)
    x[:, 2], x[:, 4] = rng.random(n) < 0.3, rng.exponential(size=n)
    kind = rng.integers(0, 4, n)
    for k in range(3):
        x[:, 5 + k] = kind == k + 1
    y = [(x[:, 0] + 0.7 * (x[:, 1] > 4) + x[:, 5] + rng.normal(size=n) > 1), (x[:, 4] * x[:, 7] + rng.normal(size=n) > 1)]
    rows = [(*map(float, r), int(a), int(b)) for r, a, b in zip(x, *y)]
    names = [f"x{k}" for k in range(N_FEATURES)]
    return spark.createDataFrame(rows, [*names, "a", "b"]).repartition(3).persist(), names


def _models(spark, frame, names, path, rounds=4, depth=3, weights=(1.0, 4.0)):
    trees = B.boosted_trees(frame, names, ["a", "b"], [weights] * 2, EXCLUSIVE, rounds, depth)
    return B.as_models(spark, trees, len(names), rounds, path, featuresCol="features", labelCol="_label", weightCol="_w",
                       maxDepth=depth, seed=42)


def _as_spark(frame, names, label, rounds=4, depth=3, weights=(1.0, 4.0)):
    data = VectorAssembler(inputCols=names, outputCol="features").transform(frame).withColumn("_label", F.col(label).cast("double")) \
        .withColumn("_w", F.when(F.col(label) == 1, weights[1]).otherwise(weights[0]))
    return data, GBTClassifier(featuresCol="features", labelCol="_label", weightCol="_w", maxIter=rounds, maxDepth=depth, seed=42).fit(data)


def test_trees_are_those_of_spark_ml(spark, frame, tmp_path):
    frame, names = frame
    for label, mine in zip("ab", _models(spark, frame, names, str(tmp_path / "m"))):
        data, theirs = _as_spark(frame, names, label)
        assert mine.getNumTrees == 4 and mine.treeWeights == theirs.treeWeights and mine.numFeatures == N_FEATURES
        assert mine.totalNumNodes == theirs.totalNumNodes
        assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-6)
        p = [m.transform(data).select(vector_to_array("probability")[1].alias("p"), *names).orderBy(*names).toPandas()["p"] for m in (mine, theirs)]
        assert np.abs(p[0] - p[1]).max() < 1e-5


def test_blocks_and_partitions_change_nothing(spark, frame, tmp_path, monkeypatch):
    frame, names = frame
    once = B.boosted_trees(frame, names, ["a", "b"], [(1.0, 4.0)] * 2, EXCLUSIVE, 2, 3)
    monkeypatch.setattr(B, "CHUNK", 100)
    monkeypatch.setattr(B, "LEAST_ROWS", 500)
    monkeypatch.setattr(B, "CHECKPOINT", 1)
    again = B.boosted_trees(frame, names, ["a", "b"], [(1.0, 4.0)] * 2, EXCLUSIVE, 2, 3)
    for x, y in zip(once, again):
        assert [(t, n[0], n[4], n[6:]) for t, n in x] == [(t, n[0], n[4], n[6:]) for t, n in y]
        assert [n[1] for _, n in x] == pytest.approx([n[1] for _, n in y], rel=1e-6)


def test_nulls_raise(spark, frame):
    frame, names = frame
    with pytest.raises(Exception, match="nulls"):
        B.boosted_trees(frame.withColumn("x0", F.when(F.col("x0") > 0, F.col("x0"))), names, ["a"], [(1.0, 1.0)], (), 1, 2)


def test_summaries_keep_all_rows(monkeypatch):
    monkeypatch.setattr(B, "SUMMARY", 10)
    values, counts = B._cells(np.arange(1000.0), np.ones((1000, 2), np.int64))
    assert len(values) == 10 and counts.sum(axis=0).tolist() == [1000, 1000] and values[-1] == 999.0


def test_large_frames_are_boosted_together(spark, sf_small, monkeypatch):
    """No job for each label: Spark ML's own fit runs once, over the two rows that give the storage its head."""
    from panelkit.operators import model as MD
    from panelkit.plans.q_model import OP, TARGETS, labelled_split
    train, test = labelled_split(spark, sf_small)
    monkeypatch.setattr(MD, "LARGE_ROWS", 10)
    fits, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, data, *more: (fits.append(data.count()), fit(self, data, *more))[1])
    model = MD.fit_product_model(train, OP, TARGETS, max_iter=2, max_depth=2)
    assert fits == [2]
    scored = model.score(test)
    assert scored.count() == test.count() * len(model.targets) and scored.where("proba is null or yhat is null").count() == 0
