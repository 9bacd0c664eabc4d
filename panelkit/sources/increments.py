"""Loading a panel batch by batch (S03, S05, W10): a new month relabels only the clients in it.

A panel folder has three parts:

  panel/    the rows, partitioned by period, written with dynamic partition overwrite
  labels/   one folder per load: label rows that the load has closed
  last/     one folder per load: the last row of every client (keys and two masks), the only state

A load joins its rows with the last rows of its clients, so it reads the new rows and one row per
client, not the history. ``last/<load>`` is written at the end and is the commit: a load that dies before is
run again, and a load that is run twice writes the same folders again. Loads come in ascending
order; an earlier one than the last committed is refused, since later labels depend on it.
"""

from __future__ import annotations

import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bitmask
from ..operators.panel import check_keys


def committed(spark: SparkSession, folder: str) -> list[str]:
    """Names of the finished loads, ascending."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(os.path.join(folder, "last"))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("load=")
                  and fs.exists(jvm.org.apache.hadoop.fs.Path(root, n + "/_SUCCESS")))


def _part(folder: str, part: str, load: str) -> str:
    return os.path.join(folder, part, f"load={load}")


def load_batch(batch: DataFrame, folder: str, load: str, products: Sequence[str], id_col: str = "id",
               order_col: str = "fetch_date") -> None:
    """Add the rows of one or more new periods. ``load`` names the batch and sorts after the earlier ones
    (e.g. its first day). Raises ValueError for repeated keys, for a load before the last
    committed one and for rows that are not later than those already there."""
    spark = batch.sparkSession
    done = committed(spark, folder)
    if any(d > load for d in done):
        raise ValueError(f"load {load} comes before {max(done)}, which is committed")
    check_keys(batch, (id_col, order_col))
    before = [d for d in done if d < load]
    now = bitmask.pack(batch, products, [id_col, order_col])
    last = None
    if before:
        last = spark.read.parquet(_part(folder, "last", before[-1]))
        first, until = batch.agg(F.min(order_col)).first()[0], last.agg(F.max(order_col)).first()[0]
        if first is not None and until is not None and first <= until:
            raise ValueError(f"load {load} has rows of {first}, but {until} is already there")
    # the panel's rows: only the periods of this batch are replaced
    (batch.hint("rebalance", order_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(order_col).parquet(os.path.join(folder, "panel")))
    rows = now
    if last is not None:
        rows = now.unionByName(last.join(now.select(id_col).distinct(), id_col, "left_semi"))
    bitmask.label_masks(rows, id_col, order_col).write.mode("overwrite").parquet(_part(folder, "labels", load))
    newest = now.groupBy(id_col).agg(F.max_by(F.struct(order_col, "held", "known"), order_col).alias("r")).select(id_col, "r.*")
    if last is not None:
        newest = newest.unionByName(last.join(now.select(id_col).distinct(), id_col, "left_anti"))
    newest.write.mode("overwrite").parquet(_part(folder, "last", load))


def labels(spark: SparkSession, folder: str, products: Sequence[str], prefix: str = "target__", id_col: str = "id",
           order_col: str = "fetch_date") -> DataFrame:
    """The label rows of all committed loads: keys, flags and one label per product, equal to
    ``bitmask.build_labels(panel, products, inactive=False)`` of the whole panel."""
    parts = [_part(folder, "labels", load) for load in committed(spark, folder)]
    if not parts:
        raise ValueError(f"no load is committed in {folder}")
    rows = spark.read.parquet(*parts)
    return rows.select(id_col, order_col, *bitmask.unpack(F.col("held"), products, known=F.col("known")),
                       *bitmask.unpack(F.col("acquired"), products, prefix))
