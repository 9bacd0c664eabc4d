"""Feature encoder and label models as Spark ML stages.

``ClientFeatures`` is an ``Estimator`` and ``ClientFeaturesModel`` its fitted ``Model``: the
feature step, the encoders and the assembled vector (F17, E01-E04) as one stage that adds a
vector column. With the label models behind it a whole product model is one ``PipelineModel``,
which ``PipelineModel.load`` reads back and which fits into ``CrossValidator``.

The fitted constants are JSON in the stage's metadata; the frequency tables are Parquet next
to it, so a loaded stage reads them from its own folder.

Cases: rows with NULLs in any feature are filled as in ``process_frame``; unseen categories
encode to zeros, or raise with ``unknown="error"``; an empty frame transforms to an empty
frame; input columns stay as they are, in their order, and a column of the output's name
raises.
"""

from __future__ import annotations

import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import FREQ_ENCODE_COLUMNS
from . import features as FE
from .model import ProductModel

_INPUT = "_input_row"


class _FeatureParams(Params):
    """Parameters that the estimator and its model share."""

    products = Param(Params._dummy(), "products", "product flag columns", TypeConverters.toListString)
    freqColumns = Param(Params._dummy(), "freqColumns", "columns encoded by train frequency",
                        TypeConverters.toListString)
    maxCategories = Param(Params._dummy(), "maxCategories", "most one-hot categories of a column",
                          TypeConverters.toInt)
    mapPTo5 = Param(Params._dummy(), "mapPTo5", "client type 'P' is 5", TypeConverters.toBoolean)
    unknown = Param(Params._dummy(), "unknown", "unseen category: 'ignore' or 'error'",
                    TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column added", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(products=[], freqColumns=list(FREQ_ENCODE_COLUMNS),
                         maxCategories=FE.MAX_CATEGORIES, mapPTo5=False, unknown="ignore",
                         outputCol="features")


class ClientFeatures(Estimator, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the feature constants on train rows."""

    @keyword_only
    def __init__(self, *, products=None, freqColumns=None, maxCategories=None, mapPTo5=None,
                 unknown=None, outputCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, train: DataFrame) -> "ClientFeaturesModel":
        get = self.getOrDefault
        fitted = FE.FeatureEncoder(get("products"), get("freqColumns"), get("mapPTo5"),
                                   get("maxCategories")).fit(train)
        return self._copyValues(ClientFeaturesModel(fitted))


class ClientFeaturesModel(Model, _FeatureParams, MLReadable, MLWritable):
    """Fitted E05: adds the vector of all encoded features to any frame of client rows."""

    def __init__(self, fitted: FE.FittedFeatures | None = None):
        super().__init__()
        self.fitted = fitted

    @property
    def featureNames(self) -> list[str]:
        """Names of the vector's places."""
        return self.fitted.feature_names

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.getOrDefault("outputCol")
        if out in df.columns:
            raise ValueError(f"column {out} is there already")
        rows = df.withColumn(_INPUT, F.struct(*[F.col(f"`{c}`") for c in df.columns]))
        rows = FE.process_frame(rows, self.fitted.products, self.fitted.median_log_income,
                                self.getOrDefault("mapPTo5"))
        rows = self.fitted.transform(rows, processed=True, unknown=self.getOrDefault("unknown"),
                                     keep=[_INPUT])
        vector = F.col(out)
        for c in rows.columns:
            if c.startswith("_chk_"):  # raises on an unseen category, NULL otherwise
                vector = F.when(F.col(c).isNull(), vector)
        return self.fitted.assemble(rows, out).select(f"{_INPUT}.*", vector.alias(out))

    def write(self) -> MLWriter:
        return _FeaturesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FeaturesReader(cls)


class _FeaturesWriter(MLWriter):
    def __init__(self, instance: ClientFeaturesModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.fitted.save(os.path.join(path, "fitted"), self.sparkSession)


class _FeaturesReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ClientFeaturesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(FE.FittedFeatures.load(self.sparkSession, os.path.join(path, "fitted")))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def as_pipeline(model: ProductModel) -> PipelineModel:
    """A fitted product model as one ``PipelineModel``: features, then one stage per label.

    Label ``t`` gives the columns ``raw_t``, ``proba_t`` and ``pred_t``.
    """
    stage = ClientFeaturesModel(model.features)
    stage.set(stage.products, list(model.features.products))
    stage.set(stage.freqColumns, list(model.features.freq_columns))
    stages = [stage]
    for t in model.targets:
        m = model.models[t].copy()
        stages.append(m.setFeaturesCol("features").setRawPredictionCol(f"raw_{t}")
                      .setProbabilityCol(f"proba_{t}").setPredictionCol(f"pred_{t}"))
    return PipelineModel(stages)


def score_pipeline(pipeline: PipelineModel, df: DataFrame, keys=("id", "fetch_date")) -> DataFrame:
    """E09 + E10 by a pipeline of ``as_pipeline``: (keys..., target, proba, yhat), a row per label."""
    from pyspark.ml.functions import vector_to_array
    targets = [s.getPredictionCol().removeprefix("pred_") for s in pipeline.stages[1:]]
    out = pipeline.transform(df)
    rows = F.array(*[F.struct(F.lit(t).alias("target"),
                              vector_to_array(F.col(f"proba_{t}"))[1].alias("proba"),
                              F.col(f"pred_{t}").cast("int").alias("yhat")) for t in targets])
    return out.select(*keys, F.explode(rows).alias("s")).select(*keys, "s.*")
