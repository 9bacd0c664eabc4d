"""Projection and filter queries P01-P16."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import panel as P
from ..schema import DROP_COLUMNS, PRODUCT_PREFIX, TARGET_PREFIX, product_columns
from ..sources import standins as S
from ..sources.tables import read_table
from .catalog import query, r6
from .sql_standins import with_ctes

OP = S.ORDER_PRODUCTS
EP = S.EVENT_PRODUCTS


@query("p01_select_by_prefix", with_ctes(
    f"SELECT id, fetch_date, {', '.join(OP)} FROM snapshot", "snapshot"))
def p01_select_by_prefix(spark, sf):
    """Key columns plus every column with the product prefix."""
    s = S.snapshot(spark, sf)
    return s.select("id", "fetch_date", *product_columns(s.columns, PRODUCT_PREFIX))


@query("p02_drop_columns", with_ctes(
    f"SELECT * EXCLUDE ({', '.join(DROP_COLUMNS)}) FROM snapshot", "snapshot"))
def p02_drop_columns(spark, sf):
    """Drop the 11 columns the model does not use."""
    return S.snapshot(spark, sf).drop(*DROP_COLUMNS)


def _labelled_orders(spark, sf):
    return P.build_labels(S.order_panel(spark, sf), OP)


_LAB_SQL = f"""SELECT * EXCLUDE (_nid) FROM (
  SELECT *, {', '.join(f'coalesce(CAST(({p} = 0 AND lead({p}) OVER w = 1) AS INTEGER), 0) AS target__{p}' for p in OP)},
    lead(id) OVER w AS _nid FROM order_panel
  WINDOW w AS (PARTITION BY id ORDER BY fetch_date)) WHERE _nid IS NOT NULL"""


@query("p03_split_features", with_ctes(
    f"SELECT id, fetch_date, {', '.join(OP)} FROM ({_LAB_SQL})", "order_panel"))
def p03_split_features(spark, sf):
    """Feature side of a labelled frame (everything but target columns)."""
    lab = _labelled_orders(spark, sf)
    return lab.drop(*P.target_columns(lab))


@query("p03_split_labels", with_ctes(
    f"SELECT {', '.join('target__' + p for p in OP)} FROM ({_LAB_SQL})", "order_panel"))
def p03_split_labels(spark, sf):
    """Label side of a labelled frame."""
    lab = _labelled_orders(spark, sf)
    return lab.select(*P.target_columns(lab))


CUSTOMER_RENAME = {"c_custkey": "id", "c_name": "name", "c_nationkey": "province_code",
                   "c_acctbal": "income", "c_mktsegment": "client_segment"}


@query("p04_rename_from_source", "SELECT " + ", ".join(
    f"{k} AS {v}" for k, v in CUSTOMER_RENAME.items()) + " FROM customer")
def p04_rename_from_source(spark, sf):
    """Rename source columns by a name map."""
    return read_table(spark, sf, "customer").withColumnsRenamed(CUSTOMER_RENAME)


@query("p05_label_prefix", with_ctes(
    "SELECT id, fetch_date, " + ", ".join(f"{p} AS {TARGET_PREFIX}{p}" for p in EP)
    + " FROM event_panel", "event_panel"))
def p05_label_prefix(spark, sf):
    """Add the label prefix to product columns."""
    d = S.event_panel(spark, sf)
    return d.select("id", "fetch_date", *[F.col(p).alias(TARGET_PREFIX + p) for p in EP])


_NULLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in S.NULLABLE_COLUMNS)


@query("p06_keep_few_nulls", with_ctes(
    f"SELECT * FROM nullable WHERE {_NULLS} < 10", "nullable"))
def p06_keep_few_nulls(spark, sf):
    """Keep rows with fewer than 10 NULL cells (exactly 10 drops)."""
    return P.keep_few_nulls(S.nullable(spark, sf), 10)


@query("p07_equality_filter", with_ctes(
    "SELECT * FROM nullable WHERE l_returnflag = 'N'", "nullable"))
def p07_equality_filter(spark, sf):
    """Equality filter; NULL rows drop."""
    return P.keep_equal(S.nullable(spark, sf), "l_returnflag", "N")


def _snap_nulls_sql():
    from .q_aggs import SNAPSHOT_DTYPES
    return " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c, _ in SNAPSHOT_DTYPES)


@query("p08_clean", with_ctes(
    f"SELECT * FROM snapshot WHERE {_snap_nulls_sql()} < 10 AND ind_deceased = 'N'", "snapshot"))
def p08_clean(spark, sf):
    """P06 then P07 on the client snapshot (living clients, few NULLs)."""
    return P.clean(S.snapshot(spark, sf))


@query("p09_train_split", with_ctes(
    f"SELECT * FROM snapshot WHERE fetch_date <= DATE '{S.ORDER_SPLIT_DATE}'", "snapshot"))
def p09_train_split(spark, sf):
    """Train side of the date split."""
    return P.split_by_date(S.snapshot(spark, sf), S.ORDER_SPLIT_DATE)[0]


@query("p09_test_split", with_ctes(
    f"SELECT * FROM snapshot WHERE fetch_date > DATE '{S.ORDER_SPLIT_DATE}'", "snapshot"))
def p09_test_split(spark, sf):
    """Test side of the date split."""
    return P.split_by_date(S.snapshot(spark, sf), S.ORDER_SPLIT_DATE)[1]


@query("p10_train_window_start", with_ctes(
    f"SELECT * FROM order_panel WHERE fetch_date >= DATE '{S.ORDER_START_DATE}'", "order_panel"))
def p10_train_window_start(spark, sf):
    """P10: drop periods before the train window."""
    return P.since(S.order_panel(spark, sf), S.ORDER_START_DATE)


@query("p11_bounded_window", with_ctes(
    f"SELECT * FROM event_panel WHERE fetch_date BETWEEN DATE '{S.EVENT_WINDOW[0]}' "
    f"AND DATE '{S.EVENT_WINDOW[1]}'", "event_panel"))
def p11_bounded_window(spark, sf):
    """Bounded period window, both ends included."""
    return P.between_dates(S.event_panel(spark, sf), *S.EVENT_WINDOW)


POINT_ID = 376


@query("p12_client_point_filter", with_ctes(
    f"SELECT * FROM snapshot WHERE id = {POINT_ID}", "snapshot"))
def p12_client_point_filter(spark, sf):
    """One client's rows."""
    return S.snapshot(spark, sf).where(F.col("id") == F.lit(POINT_ID))


_AGE = "TRY_CAST(TRY_CAST(trim(age) AS DOUBLE) AS INTEGER)"


@query("p13_sentinel_filter", with_ctes(
    f"SELECT id, fetch_date, {_AGE} AS age FROM snapshot WHERE {_AGE} IS NOT NULL", "snapshot"))
def p13_sentinel_filter(spark, sf):
    """Drop the ' NA' age sentinel, parse the rest."""
    s = S.snapshot(spark, sf).select("id", "fetch_date", X.to_int("age").alias("age"))
    return s.where(F.col("age").isNotNull())


@query("p14_positive_or_zero", with_ctes(
    "SELECT id, fetch_date, CASE WHEN income > 0 THEN income ELSE 0 END AS income FROM snapshot",
    "snapshot"))
def p14_positive_or_zero(spark, sf):
    """Keep positive values, everything else 0."""
    s = S.snapshot(spark, sf)
    return s.select("id", "fetch_date", X.positive_or_zero("income").cast("double").alias("income"))


@query("p15_drop_nulls", with_ctes(
    "SELECT id, fetch_date, round(ln(income), 6) AS log_income FROM snapshot WHERE income > 0",
    "snapshot"))
def p15_drop_nulls(spark, sf):
    """Log income with NULL results dropped."""
    s = S.snapshot(spark, sf).select("id", "fetch_date", X.log_or_null("income").alias("log_income"))
    return s.dropna(subset=["log_income"]).select("id", "fetch_date", r6("log_income").alias("log_income"))


BINARISE_THRESHOLD = 0.3


@query("p16_threshold_binarise", with_ctes(
    f"SELECT row_id, target, CAST(proba >= {BINARISE_THRESHOLD} AS INTEGER) AS yhat FROM scored",
    "scored"))
def p16_threshold_binarise(spark, sf):
    """Probability to 0/1 at a threshold."""
    s = S.scored(spark, sf)
    return s.select("row_id", "target", (F.col("proba") >= BINARISE_THRESHOLD).cast("int").alias("yhat"))
