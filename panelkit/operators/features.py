"""Feature processing and encoders.

``process_frame`` is the reference's per-row feature step as one ``select``.
``FeatureEncoder.fit`` computes the small fitted constants on the train rows
(min / max per numeric column, sorted category lists, the median of log
income) and writes the frequency tables; ``transform`` is pure
expressions plus size-checked lookups of written tables, so scoring never needs the
train data again. Fitted constants are the only values brought to the driver.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as X
from ..schema import (DROP_COLUMNS, FILL_VALUES, FREQ_ENCODE_COLUMNS, INT_COLUMNS,
                      NUMERICAL_COLUMNS, ONE_HOT_COLUMNS, SEGMENT_CODES, SEGMENT_NULL_CODE)
from ..session import scratch_dir
from . import lookup as L
from .profile import median as exact_median

MAX_CATEGORIES = 1000


def process_frame(df: DataFrame, products: Sequence[str], median_log_income: float | None = None,
                  map_p_to_5: bool = False, keep: Sequence[str] = ("id", "fetch_date")) -> DataFrame:
    """F17 (F01-F09 + P02): derived columns, parsing, fills, int casts, drops.

    ``median_log_income`` is the fitted fill value; None computes it over the
    frame itself (the reference's per-batch behaviour, X4). ``map_p_to_5``
    maps client type 'P' to 5 (the reference parses first, so 'P' becomes
    NULL and then 0, X5).
    """
    ct = X.to_numeric("client_type_1m")
    if map_p_to_5:
        ct = F.when(F.col("client_type_1m") == "P", F.lit(5.0)).otherwise(ct)
    seg = L.map_values("client_segment", dict(SEGMENT_CODES), SEGMENT_NULL_CODE)
    out = df.select(
        *[c for c in df.columns if c not in ("tenure_months", "income", "client_type_1m",
                                            "client_segment")],
        X.number_of_products(products).alias("number_of_products"),
        X.year_of("fetch_date").alias("fetch_year"),
        X.month_of("fetch_date").alias("fetch_month"),
        X.whole_month_diff("fetch_date", "registration_date").alias("tenure_months"),
        X.log_or_null("income").alias("income"),
        ct.alias("client_type_1m"),
        seg.cast("double").alias("client_segment"),
    )
    if median_log_income is None:
        med = exact_median(out, "income").withColumn("_k", F.lit(0))
        out = (out.withColumn("_k", F.lit(0)).join(F.broadcast(med), "_k")
                  .withColumn("income", F.coalesce("income", "median")).drop("_k", "median"))
    else:
        out = out.withColumn("income", F.coalesce(F.col("income"), F.lit(float(median_log_income))))
    out = out.fillna({k: v for k, v in FILL_VALUES.items() if k != "client_type_1m"})
    out = out.withColumn("client_type_1m", F.coalesce("client_type_1m", F.lit(0.0)))
    out = out.select(*[X.to_int(c).alias(c) if c in INT_COLUMNS else F.col(c) for c in out.columns])
    out = out.drop(*[c for c in DROP_COLUMNS if c not in keep])
    numeric = [f.name for f in out.schema.fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in out.schema.fields if isinstance(f.dataType, T.StringType)]
    return out.fillna(0, subset=numeric).fillna("0", subset=text)


@dataclass
class FittedFeatures:
    """Fitted constants of E01-E03 and the assembled feature names."""
    median_log_income: float
    minmax: dict
    categories: dict
    freq_columns: list
    passthrough: list
    products: list
    freq_tables: dict = field(default_factory=dict, repr=False)

    @property
    def feature_names(self) -> list[str]:
        names = list(NUMERICAL_COLUMNS)
        for c in ONE_HOT_COLUMNS:
            names += [f"{c}_{_slug(v)}" for v in self.categories[c][1:]]
        names += [f"{c}_freq" for c in self.freq_columns]
        return names + list(self.passthrough)

    def transform(self, df: DataFrame, processed: bool = False, unknown: str = "ignore",
                  keep: Sequence[str] | None = None) -> DataFrame:
        """E01 + E02 + E03 + E04 columns (not yet assembled), behind the columns ``keep``
        (by default the keys and targets)."""
        p = df if processed else process_frame(df, self.products, self.median_log_income)
        for c in self.freq_columns:
            p = L.apply_frequency(p, self.freq_tables[c], c, 0.0)
        cols = []
        for c in NUMERICAL_COLUMNS:
            lo, hi = self.minmax[c]
            x = F.col(c).cast("double")
            # A constant column scales to 0 (Spark ML MinMaxScaler would give 0.5, X8).
            cols.append((F.lit(0.0) if hi == lo else (x - F.lit(lo)) / F.lit(hi - lo)).alias(c))
        for c in ONE_HOT_COLUMNS:
            cats = self.categories[c]
            for v in cats[1:]:
                cols.append((F.col(c) == F.lit(v)).cast("double").alias(f"{c}_{_slug(v)}"))
            if unknown == "error":
                cols.append(F.when(~F.col(c).isin(*cats), F.raise_error(
                    F.lit(f"unknown category in {c}"))).alias(f"_chk_{c}"))
        cols += [F.col(f"{c}_freq").cast("double").alias(f"{c}_freq") for c in self.freq_columns]
        cols += [F.col(c).cast("double").alias(c) for c in self.passthrough]
        keys = [c for c in ("id", "fetch_date") if c in p.columns]
        if keep is None:
            keep = keys + [c for c in p.columns if c.startswith("target__")]
        return p.select(*[F.col(k) for k in keep], *cols)

    def assemble(self, df: DataFrame, out: str = "features") -> DataFrame:
        """One vector column in ``feature_names`` order."""
        return VectorAssembler(inputCols=self.feature_names, outputCol=out).transform(df)

    # -- persistence (S08) --
    def save(self, path: str, spark: SparkSession) -> None:
        meta = {"median_log_income": self.median_log_income, "minmax": self.minmax,
                "categories": self.categories, "freq_columns": self.freq_columns,
                "passthrough": self.passthrough, "products": self.products}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
            .write.mode("overwrite").text(os.path.join(path, "meta"))
        for c, t in self.freq_tables.items():
            t.write.mode("overwrite").parquet(os.path.join(path, f"freq_{c}"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FittedFeatures":
        meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
        f = cls(**meta)
        f.freq_tables = {c: spark.read.parquet(os.path.join(path, f"freq_{c}"))
                         for c in f.freq_columns}
        return f


def _slug(v) -> str:
    s = str(v)
    return "".join(ch if ch.isalnum() else "_" for ch in s)


class FeatureEncoder:
    """Fit on train rows, transform any frame (batch, request, stream)."""

    def __init__(self, products: Sequence[str], freq_columns: Sequence[str] = FREQ_ENCODE_COLUMNS,
                 map_p_to_5: bool = False, max_categories: int = MAX_CATEGORIES):
        """``max_categories``: most categories that one column may turn into columns."""
        self.max_categories = max_categories
        self.products = list(products)
        self.freq_columns = list(freq_columns)
        self.map_p_to_5 = map_p_to_5

    def fit(self, train: DataFrame) -> FittedFeatures:
        med = exact_median(
            train.select(X.log_or_null("income").alias("li")), "li").first()
        median_log_income = float(med[0]) if med and med[0] is not None else 0.0
        processed = process_frame(train, self.products, median_log_income, self.map_p_to_5)
        # Three small fits read the processed train rows: keep them (spills to disk).
        from pyspark import StorageLevel
        processed = processed.persist(StorageLevel.MEMORY_AND_DISK)
        # One aggregation for every min / max.
        mm = processed.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}")
                             for c in NUMERICAL_COLUMNS for f, n in ((F.min, "lo"), (F.max, "hi"))]
                           ).first()
        minmax = {c: (float(mm[f"lo_{c}"] or 0.0), float(mm[f"hi_{c}"] or 0.0))
                  for c in NUMERICAL_COLUMNS}
        # Sorted category lists; one-hot columns are low-cardinality by design.
        cat_rows = processed.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
            for c in ONE_HOT_COLUMNS])).alias("x")).select("x.*").distinct()
        limit = self.max_categories * len(ONE_HOT_COLUMNS)
        categories: dict = {c: [] for c in ONE_HOT_COLUMNS}
        for r in cat_rows.limit(limit + 1).collect():
            categories[r["c"]].append(r["v"])
        for c, found in categories.items():
            if len(found) > self.max_categories:
                raise ValueError(f"{c}: more than {self.max_categories} one-hot categories")
        types = dict(processed.dtypes)
        for c in ONE_HOT_COLUMNS:
            numeric = types[c] in ("int", "bigint", "double")
            vals = [float(v) if numeric else v for v in categories[c]]
            vals.sort()
            categories[c] = [int(v) if numeric and float(v).is_integer() else v for v in vals]
        # The tables are written, so scoring reads them and not the train rows.
        freq = {}
        for c in self.freq_columns:
            path = scratch_dir(train.sparkSession, f"freq-{c}")
            L.frequency_table(processed, c).write.parquet(path)
            freq[c] = train.sparkSession.read.parquet(path)
        processed.unpersist()
        used = set(NUMERICAL_COLUMNS) | set(ONE_HOT_COLUMNS) | set(self.freq_columns)
        numeric = {f.name for f in processed.schema.fields if isinstance(f.dataType, T.NumericType)}
        passthrough = [c for c in processed.columns if c not in used and not c.startswith("target__")
                       and c not in ("id", "fetch_date") and c in numeric]
        fitted = FittedFeatures(median_log_income, minmax, categories, self.freq_columns,
                                passthrough, self.products, freq)
        return fitted
