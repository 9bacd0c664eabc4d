"""Join-shaped operators (J02-J07): dictionaries, fitted lookups, name joins.

Broadcasts are used only for tables whose size is bounded: fixed dimensions
(products, codes) or fitted tables whose row count is checked against
``max_broadcast_rows`` before the plan is built; above it the join is left to
the shuffle planner (and AQE may still convert it at runtime).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000


def map_values(c, mapping: Mapping, null_value=None) -> Column:
    """Dictionary map of a column; unmapped values give NULL, NULL gives
    ``null_value`` (pandas ``.map`` with a ``None`` key)."""
    x = F.col(c) if isinstance(c, str) else c
    m = F.create_map(*[v for k, val in mapping.items() for v in (F.lit(k), F.lit(val))])
    out = m[x]
    if null_value is not None:
        out = F.when(x.isNull(), F.lit(null_value)).otherwise(out)
    return out


def checked_join(left: DataFrame, right: DataFrame, on, how: str = "left",
                 max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join that broadcasts ``right`` only after its row count is checked."""
    n = right.count()
    r = F.broadcast(right) if n <= max_broadcast_rows else right
    return left.join(r, on, how)


def frequency_table(df: DataFrame, col: str) -> DataFrame:
    """J03 / E03 fit: relative frequency of each non-NULL value (value, freq)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(col).alias("_t")).withColumn("_k", F.lit(0))
    return (counts.withColumn("_k", F.lit(0)).join(F.broadcast(total), "_k")
                  .select(col, (F.col("_n") / F.col("_t")).alias(f"{col}_freq")))


def apply_frequency(df: DataFrame, table: DataFrame, col: str, unseen: float | None = 0.0,
                    max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """J03 / E03 transform: look up each value's fitted frequency.

    NULL and unseen values give ``unseen`` (0.0 by default; None keeps NULL).
    """
    out = checked_join(df, table, col, "left", max_broadcast_rows)
    if unseen is not None:
        out = out.withColumn(f"{col}_freq", F.coalesce(F.col(f"{col}_freq"), F.lit(unseen)))
    return out


def name_predictions(long: DataFrame, names: DataFrame, target_col: str = "target",
                     name_col: str = "name") -> DataFrame:
    """Attach display names to long predictions (row, target, value).

    An inner join, so a target without a name and a name without a target both
    drop, which is what zipping two lists of different length does. ``names``
    is a dimension with one row per target (bounded), hence the broadcast.
    """
    return long.join(F.broadcast(names.select(target_col, name_col)), target_col)


def as_name_map(long: DataFrame, row_cols: Sequence[str], name_col: str = "name",
                value_col: str = "value") -> DataFrame:
    """One map per row (name -> value); rows have at most one entry per target."""
    return long.groupBy(*row_cols).agg(
        F.map_from_entries(F.collect_list(F.struct(name_col, value_col))).alias("predictions"))


def align_rows(features: DataFrame, labels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep labels only for rows that survived feature processing."""
    return features.join(labels, list(keys), "inner")


def label_names(df: DataFrame, dim: DataFrame, column_col: str, prefix: str = "target__",
                lang_col: str = "name_en") -> DataFrame:
    """Display name of a target column: strip the prefix, join the product dimension."""
    key = F.expr(f"substring(`{column_col}`, {len(prefix) + 1})")
    d = dim.select(F.col("column").alias("_col"), F.col(lang_col).alias("name"))
    return df.join(F.broadcast(d), key == F.col("_col"), "left").drop("_col")


def relabel_series(series: DataFrame, dim: DataFrame, series_col: str = "series",
                   name_col: str = "name_en") -> DataFrame:
    """Attach display names to metric series whose name contains the
    product name with blanks as underscores (a regex theta join).

    The dimension is the fixed product list (bounded), so it is broadcast and
    every series row is tested against each pattern once.
    """
    d = dim.select(F.col(name_col).alias("display_name"),
                   F.concat(F.lit(".*"), F.regexp_replace(F.col(name_col), " ", "_"),
                            F.lit(".*")).alias("_pattern"))
    return series.join(F.broadcast(d), F.expr(f"`{series_col}` RLIKE _pattern"),
                       "left").drop("_pattern")
