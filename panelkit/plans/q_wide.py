"""The full panel of 48 columns and 24 products: load, rename, labels, transitions, totals.

Labels, transitions and client summaries run on bit masks (``operators.bitmask``).
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from .. import schema
from ..operators import bitmask as B
from ..operators import lookup as L
from ..operators import panel as P
from ..operators import profile as A
from ..session import scratch_dir
from ..sources import io as IO
from ..sources import standins as S
from .catalog import query, r6
from .q_aggs import client_summary_sql
from .q_windows import _sql_targets, _sql_transitions
from .sql_standins import with_ctes

WP = S.wide_products()
_LABELLED = f"""SELECT *, {_sql_targets(WP)}, lead(id) OVER w AS _nid FROM wide_panel
    WINDOW w AS (PARTITION BY id ORDER BY fetch_date)"""
_ANY = "greatest(" + ", ".join(f"target__{p}" for p in WP) + ")"
_ACTIVE = f"""SELECT * FROM (SELECT *, max({_ANY}) OVER (PARTITION BY id) AS _active FROM ({_LABELLED}) WHERE _nid IS NOT NULL)
    WHERE _active > 0"""
_OUT = "id, fetch_date, " + ", ".join(WP) + ", " + ", ".join(f"target__{p}" for p in WP)


def _split(spark, sf):
    return P.split_by_date(B.build_labels(S.wide_panel(spark, sf), WP), S.ORDER_SPLIT_DATE)


@query("w10_wide_split_train", with_ctes(
    f"SELECT {_OUT} FROM ({_ACTIVE}) WHERE fetch_date <= DATE '{S.ORDER_SPLIT_DATE}'", "wide_panel"))
def w10_wide_split_train(spark, sf):
    """W01 + W03-W05 + W10 on 24 products: the train side, labels from bit masks."""
    return _split(spark, sf)[0]


@query("w10_wide_split_test", with_ctes(
    f"SELECT {_OUT} FROM ({_ACTIVE}) WHERE fetch_date > DATE '{S.ORDER_SPLIT_DATE}'", "wide_panel"))
def w10_wide_split_test(spark, sf):
    """W10 on 24 products: the test side."""
    return _split(spark, sf)[1]


@query("w08_wide_transitions", with_ctes(_sql_transitions(WP, "wide_panel"), "wide_panel"))
def w08_wide_transitions(spark, sf):
    """W08 on 24 products with NULL gaps, one client shuffle of two masks."""
    t = P.transition_table(S.wide_panel(spark, sf), WP)
    return t.select("prev", "cur", "n", r6("share").alias("share"))


@query("a03_a07_wide_summary", with_ctes(client_summary_sql(WP, "wide_panel"), "wide_panel"))
def a03_a07_wide_summary(spark, sf):
    """A03-A07 on 24 products: lanes and masks per client."""
    s = A.client_product_summary(S.wide_panel(spark, sf), WP)
    return s.select(*[r6(c).alias(c) for c in s.columns])


@query("w03_wide_acquisitions", with_ctes(
    "SELECT fetch_date, product, CAST(sum(y) AS BIGINT) AS acquisitions FROM ("
    + " UNION ALL ".join(f"SELECT fetch_date, '{p}' AS product, target__{p} AS y FROM wide_labels WHERE _nid IS NOT NULL" for p in WP)
    + ") GROUP BY fetch_date, product", "wide_panel", extra=[f"wide_labels AS ({_LABELLED})"]))
def w03_wide_acquisitions(spark, sf):
    """W03 on 24 products: take-ups per product and period, one aggregate of label masks."""
    labelled = B.label_masks(B.pack(S.wide_panel(spark, sf), WP))
    sums = labelled.groupBy("fetch_date").agg(*[F.sum(B.bit(F.col("acquired"), i)).cast("long").alias(p) for i, p in enumerate(WP)])
    return sums.unpivot(["fetch_date"], WP, "product", "acquisitions")


def _names_sql():
    return " UNION ALL ".join(f"SELECT '{c}' AS product, '{ru}' AS name_ru, '{en}' AS name_en" for c, ru, en in schema.PRODUCT_NAMES)


@query("j06_wide_product_names", with_ctes(
    "SELECT t.product, n.name_ru, n.name_en, t.total FROM ("
    + " UNION ALL ".join(f"SELECT '{p}' AS product, CAST(sum({p}) AS BIGINT) AS total FROM wide_panel" for p in WP)
    + f") t JOIN ({_names_sql()}) n ON n.product = t.product", "wide_panel"))
def j06_wide_product_names(spark, sf):
    """A09 + J06: totals of the 24 products with their names in both languages."""
    # the product dimension is fixed, 24 rows: broadcasting it is size-bounded
    names = schema.product_dim(spark).withColumnRenamed("column", "product")
    return B.totals(S.wide_panel(spark, sf), WP).join(F.broadcast(names), "product").select("product", "name_ru", "name_en", "total")


@query("s01_p04_wide_csv", with_ctes("SELECT * FROM wide_snapshot", "wide_snapshot"))
def s01_p04_wide_csv(spark, sf):
    """S01 + P04 + S05: the 48-column CSV under source names, read by the raw schema (flags as
    floats), renamed by position, flags cast, written as Parquet by period."""
    path = scratch_dir(spark, "wide")
    snap = S.wide_snapshot(spark, sf)
    floats = snap.select(*[F.col(c).cast("double").alias(c) if c in WP else F.col(c) for c in snap.columns])
    IO.write_csv(floats, os.path.join(path, "csv"), [source for source, _ in schema.SOURCE_TO_NAME])
    table = IO.csv_to_parquet(spark, os.path.join(path, "csv"), os.path.join(path, "table"), schema.snapshot_schema(raw=True),
                              post=schema.cast_products)
    return table.select(*schema.column_names())
