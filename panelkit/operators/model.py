"""One boosted-tree classifier per product label.

Training reads one written, assembled frame; each label's GBT fit is a
distributed Spark ML job (the loop over labels runs on the driver, the data
passes do not). Scoring chains every label's model over one scan and returns
the long form (row keys, target, proba, yhat) that the metrics consume.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from typing import Sequence

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CLASS_WEIGHTS, ONE_HOT_COLUMNS, PROBA_THRESHOLD, RANDOM_STATE, TARGET_PREFIX
from . import boosting
from .features import FeatureEncoder, FittedFeatures, _slug

# The reference boosts 100 rounds per label and leaves the depth to its library (6).
DEFAULT_MAX_ITER = 100
DEFAULT_MAX_DEPTH = 6
ROWS_PER_PARTITION = 200_000
#: Frames with more rows are boosted by ``boosting``, all labels at once.
LARGE_ROWS = 200_000


def class_weight_column(label: str, weights: tuple[float, float] | str,
                        pos_weight: float | None = None):
    """E06 fixed 1:4 weights, or E07 'balanced' (positives neg/pos, negatives 1)."""
    if weights == "balanced":
        return F.when(F.col(label) == 1, F.lit(float(pos_weight or 1.0))).otherwise(F.lit(1.0))
    w0, w1 = weights
    return F.when(F.col(label) == 1, F.lit(float(w1))).otherwise(F.lit(float(w0)))


def balanced_weights(train: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Per label neg / pos of the train rows (NULL without positives)."""
    agg = train.agg(*[F.sum(F.col(t)).alias(f"p_{t}") for t in targets],
                    F.count(F.lit(1)).alias("_n"))
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("target"),
                 ((F.col("_n") - F.col(f"p_{t}")) / F.nullif(F.col(f"p_{t}"), F.lit(0)))
                 .alias("pos_weight")) for t in targets])).alias("w")).select("w.*")


def varying_targets(train: DataFrame, targets: Sequence[str]) -> list[str]:
    """A25 on the driver side: labels with both classes in train (small result)."""
    row = train.agg(*[(F.min(t) != F.max(t)).alias(t) for t in targets]).first()
    return [t for t in targets if row[t]]


@dataclass
class ProductModel:
    features: FittedFeatures
    targets: list
    models: dict

    def score_wide(self, df: DataFrame, processed: bool = False) -> DataFrame:
        """Every label model over one scan: columns _p_<t> (probability vector)
        and _y_<t> (0/1) next to the input keys."""
        a = self.features.assemble(self.features.transform(df, processed))
        for t in self.targets:
            m = self.models[t].copy()
            m.setFeaturesCol("features").setProbabilityCol(f"_p_{t}") \
             .setRawPredictionCol(f"_r_{t}").setPredictionCol(f"_y_{t}")
            a = m.transform(a)
        return a

    def score(self, df: DataFrame, keys: Sequence[str] = ("id", "fetch_date"),
              processed: bool = False) -> DataFrame:
        """E09 + E10: long (keys..., target, proba, yhat, [y]) for every label."""
        a = self.score_wide(df, processed)
        has_y = all(t in a.columns for t in self.targets)
        parts = []
        for t in self.targets:
            fields = [F.lit(t).alias("target"),
                      vector_to_array(F.col(f"_p_{t}"))[1].alias("proba"),
                      F.col(f"_y_{t}").cast("int").alias("yhat")]
            if has_y:
                fields.append(F.col(t).cast("int").alias("y"))
            parts.append(F.struct(*fields))
        keys = [k for k in keys if k in a.columns]
        return a.select(*keys, F.explode(F.array(*parts)).alias("s")).select(*keys, "s.*")

    def importances(self, min_importance: float = 0.0) -> list[tuple[str, str, float]]:
        """(target, feature, importance) above ``min_importance``; sums to 1."""
        names = self.features.feature_names
        out = []
        for t in self.targets:
            imp = self.models[t].featureImportances.toArray()
            out += [(t, names[i], float(v)) for i, v in enumerate(imp) if v > min_importance]
        return out

    def save(self, path: str, spark: SparkSession) -> None:
        """Fitted features, every label model, and the label list."""
        self.features.save(os.path.join(path, "features"), spark)
        for t in self.targets:
            self.models[t].write().overwrite().save(os.path.join(path, "models", t))
        spark.createDataFrame([(json.dumps({"targets": self.targets}),)], "meta string") \
            .coalesce(1).write.mode("overwrite").text(os.path.join(path, "meta"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ProductModel":
        meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
        feats = FittedFeatures.load(spark, os.path.join(path, "features"))
        models = {t: GBTClassificationModel.load(os.path.join(path, "models", t))
                  for t in meta["targets"]}
        return cls(feats, meta["targets"], models)


def _weight_pair(weights: tuple[float, float] | str, pos_weight: float | None) -> tuple[float, float]:
    """Weights of the rows with label 0 and 1, as ``class_weight_column`` has them."""
    return (1.0, float(pos_weight or 1.0)) if weights == "balanced" else (float(weights[0]), float(weights[1]))


def _fit_together(frame: DataFrame, feats: FittedFeatures, targets: list, weights: list, n_rows: int,
                  max_iter: int, max_depth: int, seed: int) -> dict:
    """{target: model} by ``boosting.boosted_trees``; ``frame`` has the features as x0, x1, ..."""
    from ..session import scratch_dir
    if not targets:
        return {}
    names = feats.feature_names
    at = {n: k for k, n in enumerate(names)}
    one_hot = [[at[f"{c}_{_slug(v)}"] for v in feats.categories[c][1:]] for c in ONE_HOT_COLUMNS]
    trees = boosting.boosted_trees(frame, [f"x{k}" for k in range(len(names))], targets, weights, one_hot, max_iter, max_depth, n_rows)
    spark = frame.sparkSession
    models = boosting.as_models(spark, trees, len(names), max_iter, scratch_dir(spark, "boosted"), featuresCol="features", labelCol="_label",
                                weightCol="_w", maxDepth=max_depth, seed=seed, checkpointInterval=10)
    return dict(zip(targets, models))


def fit_layout(n_rows: int, n_labels: int, slots: int, parallelism: int | None = None) -> tuple[int, int]:
    """Partitions of the train frame, and label fits at once (``parallelism``, or by size).

    Small frames: the fits together fill the slots, each with few tasks. Large ones: a
    partition per ``ROWS_PER_PARTITION`` rows, in whole waves of the slots, and two fits at once,
    as each keeps its own copy of the binned rows.
    """
    at_once = parallelism or n_labels
    partitions = max(1, -(-slots // max(1, min(at_once, n_labels))), -(-n_rows // ROWS_PER_PARTITION))
    if partitions > slots:
        partitions = -(-partitions // slots) * slots
    return partitions, parallelism or max(2, min(n_labels, -(-2 * slots // partitions)))


def fit_product_model(train: DataFrame, products: Sequence[str],
                      targets: Sequence[str] | None = None,
                      weights: tuple[float, float] | str = CLASS_WEIGHTS,
                      max_iter: int = DEFAULT_MAX_ITER, max_depth: int = DEFAULT_MAX_DEPTH,
                      seed: int = RANDOM_STATE, parallelism: int | None = None) -> ProductModel:
    """Fit features on train, keep varying labels (A25), one GBT each.

    Frames of up to ``LARGE_ROWS`` rows: label fits are independent Spark jobs over the same frame; several are
    submitted at once from driver threads (as ``CrossValidator(parallelism=...)``
    does), so the cluster is not idle between the small per-iteration jobs of a
    single fit. ``fit_layout`` sets partitions and, without ``parallelism``, fits at once. Larger ones: the
    same trees, grown for all labels together (``boosting``).
    """
    targets = list(targets or [TARGET_PREFIX + p for p in products])
    # GBT checkpoints its running predictions every ``checkpointInterval``
    # iterations when the context has a checkpoint folder: make sure it is the
    # session's shared one, so a lost executor never replays the whole boosting.
    from ..session import checkpoint_dir, scratch_dir
    checkpoint_dir(train.sparkSession)
    # The fitted constants take several passes over the train rows: keep them
    # (memory, spilling to disk) instead of re-deriving labels for every pass.
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    n_rows = train.count()
    feats = FeatureEncoder(products).fit(train)
    # Boosting runs several small jobs per iteration over this frame, and each of their
    # tasks carries its lineage: it is written, so that is one scan and not the whole
    # preparation, and dealt into few even partitions.
    path = scratch_dir(train.sparkSession, "train-features")
    large = n_rows > LARGE_ROWS
    rows = feats.transform(train)
    if large:
        rows.select(*targets, *[F.col(f"`{n}`").alias(f"x{k}") for k, n in enumerate(feats.feature_names)]).write.parquet(path)
    else:
        feats.assemble(rows).select(*targets, "features").write.parquet(path)
    train.unpersist()
    assembled = train.sparkSession.read.parquet(path)
    if not large:
        slots = train.sparkSession.sparkContext.defaultParallelism
        partitions, at_once = fit_layout(n_rows, len(targets), slots, parallelism)
        assembled = assembled.repartition(partitions).persist(StorageLevel.MEMORY_AND_DISK)
    kept = varying_targets(assembled, targets)
    pos = {}
    if weights == "balanced":
        pos = {r["target"]: r["pos_weight"] for r in balanced_weights(assembled, kept).collect()}
    if large:
        return ProductModel(feats, kept, _fit_together(assembled, feats, kept, [_weight_pair(weights, pos.get(t)) for t in kept],
                                                       n_rows, max_iter, max_depth, seed))
    assembled.count()  # materialise the cache once, before the parallel fits

    def fit_one(t: str):
        data = assembled.withColumn("_w", class_weight_column(t, weights, pos.get(t))) \
                        .withColumn("_label", F.col(t).cast("double"))
        gbt = GBTClassifier(featuresCol="features", labelCol="_label", weightCol="_w",
                            maxIter=max_iter, maxDepth=max_depth, seed=seed,
                            checkpointInterval=10)
        return t, gbt.fit(data)

    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(kept)))) as pool:
        models = dict(pool.map(fit_one, kept))
    assembled.unpersist()
    return ProductModel(feats, kept, models)


def model_params(train: DataFrame, names: DataFrame) -> DataFrame:
    """The parameter table, a row per target: its columns in ``names`` and the train mean income."""
    # one row beside the target dimension
    return names.crossJoin(F.broadcast(train.agg(F.avg("income").alias("income_mean"))))


def write_params(params: DataFrame, path: str) -> None:
    """The parameter table as JSON lines with its column types; NULLs stay in the lines."""
    params.coalesce(1).write.option("ignoreNullFields", "false").json(os.path.join(path, "rows"))
    params.sparkSession.createDataFrame([(params.schema.json(),)], "schema string").coalesce(1) \
        .write.text(os.path.join(path, "schema"))


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``write_params`` has written."""
    schema = T.StructType.fromJson(json.loads(spark.read.text(os.path.join(path, "schema")).first()[0]))
    return spark.read.schema(schema).json(os.path.join(path, "rows"))


def recommend(model: ProductModel, df: DataFrame, keys: Sequence[str] = ("id", "fetch_date"),
              threshold: float = PROBA_THRESHOLD, places: int = 4) -> DataFrame:
    """E14 / R04 per request row: labels with probability >= threshold, ranked
    by probability (ties by label name), rounded to ``places``.

    The ranking sorts a per-row array of (label, probability), so it needs no
    shuffle and also runs on streams (no window function).
    """
    from ..functions.scalars import round_to
    a = model.score_wide(df)
    arr = F.array(*[F.struct((-vector_to_array(F.col(f"_p_{t}"))[1]).alias("neg"),
                             F.lit(t).alias("target"),
                             vector_to_array(F.col(f"_p_{t}"))[1].alias("proba"))
                    for t in model.targets])
    kept = F.filter(F.sort_array(arr), lambda s: s["proba"] >= F.lit(float(threshold)))
    keys = [k for k in keys if k in a.columns]
    out = a.select(*keys, F.posexplode(kept).alias("pos", "s"))
    return out.select(*keys, F.col("s.target").alias("target"),
                      round_to(F.col("s.proba"), places).alias("proba"),
                      (F.col("pos") + 1).cast("long").alias("rank"))
