"""Sort / top-k / seeded sampling operators (R02-R04, R07 in panel, R08)."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .running import seeded_rank
from .selection import MAX_RANKS, mark_smallest


def head(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """First n rows by an explicit key order (a top-n, the feature itself)."""
    return df.orderBy(*order).limit(n)


def top_k_per_row(long: DataFrame, row_cols: Sequence[str], k: int,
                  score: str = "proba", target: str = "target") -> DataFrame:
    """The k highest-scoring targets of each row; ties break by target name.

    A row has one entry per target, so each window partition is bounded by the
    number of targets.
    """
    w = Window.partitionBy(*row_cols).orderBy(F.col(score).desc(), F.col(target))
    return long.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def recommendations(long: DataFrame, row_cols: Sequence[str], threshold: float = 0.01,
                    places: int = 4, score: str = "proba", target: str = "target") -> DataFrame:
    """Targets with score >= threshold (on the unrounded value), score
    rounded to ``places``, ranked by score descending."""
    kept = long.where(F.col(score) >= threshold)
    w = Window.partitionBy(*row_cols).orderBy(F.col(score).desc(), F.col(target))
    from ..functions.scalars import round_to
    return kept.select(*row_cols, target, round_to(score, places).alias(score),
                       F.row_number().over(w).cast("long").alias("rank"))


def random_positives(long: DataFrame, rates: DataFrame, row_cols: Sequence[str],
                     seed: int = 42, target: str = "target") -> DataFrame:
    """Per target set floor(rate * n) seeded-random rows to 1.

    ``rates`` is (target, rate) with one row per target. The last md5 of each target's positives
    comes from radix selection over all rows; one pass then marks them. With more targets than
    ``selection.MAX_RANKS``, rows are ranked per target (``seeded_rank``) instead.
    """
    from .running import md5_key
    few = rates.limit(MAX_RANKS + 1).collect()
    if len(few) <= MAX_RANKS:
        rate = {r[target]: r["rate"] for r in few}
        known = long.join(F.broadcast(rates.select(target)), target, "left_semi")
        marked = mark_smallest(known, md5_key(list(row_cols) + [target], seed),
                               lambda key, n: math.floor((rate[key[0]] or 0.0) * n), [target])
        if marked is not None:
            return marked.withColumn("yhat", F.col("_chosen").cast("int")).drop("_chosen")
    n = long.groupBy(target).agg(F.count(F.lit(1)).alias("_n"))
    k = n.join(rates, target).select(target, F.floor(F.col("rate") * F.col("_n")).alias("_k"))
    ranked = seeded_rank(long, [target], list(row_cols) + [target], seed)
    return (ranked.join(k, target)
                  .withColumn("yhat", (F.col("rank") <= F.col("_k")).cast("int"))
                  .drop("_k", "rank"))
