"""Source / sink queries S01-S07 (S08 / S09 live with the model queries).

Written tables go to a new folder under the session's checkpoint folder
(shared storage on a cluster), never to a machine-local path.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions.rows import json_to_rows, rows_to_json
from ..schema import SOURCE_TO_NAME
from ..session import scratch_dir
from ..sources import io as IO
from ..sources import standins as S
from ..sources.tables import read_table
from .catalog import query
from .sql_standins import with_ctes

_SOURCE_OF = {new: src for src, new in SOURCE_TO_NAME}


def _snapshot_csv(spark, sf):
    snap = S.snapshot(spark, sf)
    path = os.path.join(scratch_dir(spark, "csv"), "snapshot")
    IO.write_csv(snap, path, [_SOURCE_OF.get(c, c) for c in snap.columns])
    return snap.schema, path


@query("s01_csv_typed_scan", with_ctes("SELECT * FROM snapshot", "snapshot"))
def s01_csv_typed_scan(spark, sf):
    """CSV with source-name header read back by a declared schema (positional rename)."""
    schema, path = _snapshot_csv(spark, sf)
    return IO.read_csv_typed(spark, path, schema)


@query("s02_parquet_scan",
       "SELECT l_orderkey, l_extendedprice, l_discount FROM lineitem "
       "WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_discount > 0.05")
def s02_parquet_scan(spark, sf):
    """Parquet scan with a pushed filter and a pruned read schema."""
    li = read_table(spark, sf, "lineitem")
    return (li.where((F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
                     & (F.col("l_discount") > 0.05))
              .select("l_orderkey", "l_extendedprice", "l_discount"))


@query("s03_s04_read_through_cache", with_ctes("SELECT * FROM snapshot", "snapshot"))
def s03_s04_read_through_cache(spark, sf):
    """S03 + S04: the first call parses the CSV and writes Parquet (partitioned
    by period); the second call finds the table and only reads it."""
    schema, csv_path = _snapshot_csv(spark, sf)
    pq = os.path.join(scratch_dir(spark, "cache"), "snapshot")
    IO.cached_table(spark, pq, csv_path, schema)
    return IO.cached_table(spark, pq, csv_path, schema)


@query("s05_csv_to_parquet_job", with_ctes(
    f"SELECT * FROM snapshot WHERE fetch_date > DATE '{S.ORDER_SPLIT_DATE}'", "snapshot"))
def s05_csv_to_parquet_job(spark, sf):
    """CSV -> typed Parquet partitioned by fetch_date; a period filter on
    the result prunes partitions."""
    schema, csv_path = _snapshot_csv(spark, sf)
    pq = os.path.join(scratch_dir(spark, "parquet"), "snapshot")
    t = IO.csv_to_parquet(spark, csv_path, pq, schema)
    return t.where(F.col("fetch_date") > F.to_date(F.lit(S.ORDER_SPLIT_DATE)))


@query("s06_json_rows_source", with_ctes(
    "SELECT * REPLACE (CASE WHEN id % 37 = 0 THEN NULL ELSE registration_date END "
    "AS registration_date) FROM snapshot", "snapshot"))
def s06_json_rows_source(spark, sf):
    """JSON request strings to typed rows; a bad date becomes NULL."""
    snap = S.snapshot(spark, sf)
    return json_to_rows(S.requests_from(snap), snap.schema)


def _json_sql():
    from .q_aggs import SNAPSHOT_DTYPES
    parts = []
    for c, t in SNAPSHOT_DTYPES:
        v = f"strftime({c}, '%d-%m-%Y')" if t == "date" else c
        parts.append(f"'{c}': {v}")
    return ("SELECT id, fetch_date, CAST(to_json({" + ", ".join(parts) + "}) AS VARCHAR) AS value "
            "FROM snapshot")


@query("s07_json_rows_sink", with_ctes(_json_sql(), "snapshot"))
def s07_json_rows_sink(spark, sf):
    """Rows to JSON objects; dates as dd-MM-yyyy, NULL fields kept."""
    return rows_to_json(S.snapshot(spark, sf), keep=("id", "fetch_date"))


@query("s05_bucketed_panel_labels", with_ctes(
    "SELECT id, fetch_date, " + ", ".join(
        f"coalesce(CAST(({p} = 0 AND lead({p}) OVER w = 1) AS INTEGER), 0) AS target__{p}"
        for p in S.ORDER_PRODUCTS)
    + " FROM snapshot WINDOW w AS (PARTITION BY id ORDER BY fetch_date) "
    "QUALIFY lead(id) OVER w IS NOT NULL", "snapshot"))
def s05_bucketed_panel_labels(spark, sf):
    """S05 variant: the snapshot written bucketed by client; the label build
    (W01, W03, W04) on it needs no shuffle."""
    from ..operators import panel as P
    snap = S.snapshot(spark, sf)
    name = "panel_" + os.path.basename(scratch_dir(spark, "b")).replace("-", "_")
    t = IO.write_bucketed(snap, name, os.path.join(scratch_dir(spark, "bucketed"), name))
    lab = P.build_labels(t, S.ORDER_PRODUCTS)
    return lab.select("id", "fetch_date", *["target__" + p for p in S.ORDER_PRODUCTS])
