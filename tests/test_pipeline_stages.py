"""The feature encoder and the label models as Spark ML stages."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from panelkit.operators import features as FE
from panelkit.operators import model as MD
from panelkit.operators import pipeline as PL
from panelkit.plans.q_model import OP, TARGETS, labelled_split


@pytest.fixture(scope="module")
def split(spark, sf_small):
    train, test = labelled_split(spark, sf_small)
    return train.cache(), test.cache()


def test_stage_equals_encoder_and_keeps_columns(split):
    train, test = split
    model = PL.ClientFeatures(products=OP).fit(train)
    out = model.transform(test)
    assert out.columns == test.columns + ["features"]
    assert [f.dataType for f in out.schema.fields[:-1]] == [f.dataType for f in test.schema.fields]
    fitted = FE.FeatureEncoder(OP).fit(train)
    assert model.featureNames == fitted.feature_names
    want = fitted.assemble(fitted.transform(test)).select("id", "fetch_date", vector_to_array("features").alias("v"))
    got = out.select("id", "fetch_date", vector_to_array("features").alias("v"))
    assert got.count() == test.count() and got.exceptAll(want).count() == 0
    assert out.drop("features").exceptAll(test).count() == 0
    assert model.transform(test.limit(0)).count() == 0
    with pytest.raises(ValueError):
        model.transform(out)
    with pytest.raises(Exception):
        unseen = test.withColumn("gender", F.lit("?"))
        model.copy({model.unknown: "error"}).transform(unseen).collect()


def test_written_stages_load_with_parameters(split, tmp_path):
    train, test = split
    estimator = PL.ClientFeatures(products=OP, freqColumns=["entry_channel"], unknown="error", outputCol="x")
    estimator.write().save(str(tmp_path / "estimator"))
    again = PL.ClientFeatures.load(str(tmp_path / "estimator"))
    assert again.getOrDefault("products") == OP and again.getOrDefault("outputCol") == "x"
    model = again.fit(train)
    model.write().save(str(tmp_path / "model"))
    loaded = PL.ClientFeaturesModel.load(str(tmp_path / "model"))
    assert loaded.uid == model.uid and loaded.getOrDefault("unknown") == "error"
    assert loaded.featureNames == model.featureNames
    pick = ["id", "fetch_date", vector_to_array("x").alias("x")]
    assert loaded.transform(train).select(pick).exceptAll(model.transform(train).select(pick)).count() == 0


def test_product_model_as_one_pipeline(split, tmp_path):
    train, test = split
    model = MD.fit_product_model(train, OP, TARGETS[:2], max_iter=2, max_depth=2)
    PL.as_pipeline(model).write().save(str(tmp_path / "pipeline"))
    loaded = PL.score_pipeline(PipelineModel.load(str(tmp_path / "pipeline")), test)
    want = model.score(test).select(loaded.columns)
    assert loaded.count() == test.count() * len(model.targets)
    assert loaded.exceptAll(want).count() == 0


def test_cross_validator_takes_the_stage(split):
    train, _ = split
    data = train.withColumn("label", F.col("ind_1m_urgent").cast("double"))
    features = PL.ClientFeatures(products=[p for p in OP if p != "ind_1m_urgent"])
    trees = GBTClassifier(maxIter=1, maxDepth=2, labelCol="label")
    grid = ParamGridBuilder().addGrid(features.freqColumns, [[], ["entry_channel"]]).build()
    search = CrossValidator(estimator=Pipeline(stages=[features, trees]), estimatorParamMaps=grid, numFolds=2,
                            evaluator=BinaryClassificationEvaluator(labelCol="label"), seed=1)
    best = search.fit(data)
    assert len(best.avgMetrics) == 2
    assert best.transform(data).where("prediction is null").count() == 0


def test_parameters_keep_nulls_and_types(spark, tmp_path):
    params = spark.createDataFrame([("a", None, 1.5), ("b", "Бонд \"x\"", None)], "target string, name string, income_mean double")
    MD.write_params(params, str(tmp_path / "params"))
    back = MD.read_params(spark, str(tmp_path / "params"))
    assert back.schema == params.schema and sorted(back.collect(), key=str) == sorted(params.collect(), key=str)
    MD.write_params(params.limit(0), str(tmp_path / "none"))
    assert MD.read_params(spark, str(tmp_path / "none")).columns == params.columns
