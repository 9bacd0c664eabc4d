"""Stand-in tables built from the driver's test tables.

The reference's input is a private client-month CSV. These functions derive
tables of the same shape from the TPC-H-like test tables so every operator
runs on data whose size grows with the scale factor. Each has a DuckDB twin in
``panelkit.plans.sql_standins``; both must stay expression-for-expression equal.

  event_panel   events per (user, day): five 0/1 product flags
  order_panel   orders per (customer, month): five 0/1 product flags
  snapshot      order_panel + customer + nation as a client-month snapshot
                with the reference's column names and raw string formats
  wide_panel    orders per (customer, month): 24 product flags, some NULL
  wide_snapshot snapshot's client columns and the 24 flags: all 48 columns
  nullable      lineitem with nulls made by rule (sparse columns)
  scored        labels + documents as two-label predictions, long form
  metric_events events as a monitoring stream (target = event type)
  requests      snapshot rows as JSON request strings, dates dd-MM-yyyy
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PRODUCT_PREFIX, column_names, product_columns
from .tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the stand-ins (shared with the SQL twins).
# ---------------------------------------------------------------------------
EVENT_TYPES = ["view", "click", "purchase", "signup", "error"]
EVENT_PRODUCTS = [f"ind_{t}" for t in EVENT_TYPES]
EVENT_SPLIT_DATE = "2024-01-20"
EVENT_START_DATE = "2024-01-05"
EVENT_WINDOW = ("2024-01-10", "2024-01-24")

ORDER_PRODUCTS = ["ind_1m_urgent", "ind_1m_large", "ind_1m_high", "ind_1m_low",
                  "ind_1m_open"]
ORDER_SPLIT_DATE = "2000-06-01"
ORDER_START_DATE = "1996-01-01"
LARGE_ORDER_PRICE = 400000.0
SCORED_PANEL_THRESHOLD = 0.4

# Display names of the stand-in products (name_ru carries the same text).
EVENT_PRODUCT_NAMES = [
    ("ind_view", "View"), ("ind_click", "Click"), ("ind_purchase", "Purchase"),
    ("ind_signup", "Signup"), ("ind_error", "Error Report"),
]
ORDER_PRODUCT_NAMES = [
    ("ind_1m_urgent", "Urgent Order"), ("ind_1m_large", "Large Order"),
    ("ind_1m_high", "High Priority"), ("ind_1m_low", "Low Priority"),
    ("ind_1m_open", "Open Order"),
]
SEGMENT_OF_MARKET = [("BUILDING", "01 - TOP"), ("AUTOMOBILE", "02 - PARTICULARES"),
                     ("MACHINERY", "03 - UNIVERSITARIO"), ("FURNITURE", "02 - PARTICULARES")]


def _flag(cond: Column) -> Column:
    return F.max(F.when(cond, 1).otherwise(0))


def event_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return (ev.groupBy(F.col("user_id").alias("id"), F.to_date("ts").alias("fetch_date"))
              .agg(*[_flag(F.col("event_type") == t).alias(f"ind_{t}") for t in EVENT_TYPES]))


def order_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_custkey").alias("id"),
                      F.trunc(F.to_date("o_orderdate"), "month").alias("fetch_date"))
             .agg(_flag(F.col("o_orderpriority") == "1-URGENT").alias("ind_1m_urgent"),
                  _flag(F.col("o_totalprice") > LARGE_ORDER_PRICE).alias("ind_1m_large"),
                  _flag(F.col("o_orderpriority") == "2-HIGH").alias("ind_1m_high"),
                  _flag(F.col("o_orderpriority") == "5-LOW").alias("ind_1m_low"),
                  _flag(F.col("o_orderstatus") == "O").alias("ind_1m_open")))


def _case(key: Column, pairs, default=None) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client-month snapshot in the reference's column names and raw formats."""
    op = order_panel(spark, sf_dir)
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    # nation is a fixed 25-row dimension: broadcasting it is size-bounded.
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = (op.join(cust, op.id == cust.c_custkey)
           .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")))
    k = F.col("id")
    first_month = F.min("fetch_date").over(_by_id())
    j = j.withColumn("registration_date",
                     F.add_months(first_month, -(k % 24).cast("int")))
    months = ((F.year("fetch_date") - F.year("registration_date")) * 12
              + (F.month("fetch_date") - F.month("registration_date")))
    return j.select(
        F.col("fetch_date"),
        k.alias("id"),
        _case(k % 5, [(0, "A"), (1, "B"), (2, "F"), (3, "N")], "P").alias("ind_employee"),
        F.lit("ES").alias("country_of_residence"),
        _case(k % 3, [(0, "H"), (1, "V")]).alias("gender"),
        F.when(k % 13 == 0, F.lit(" NA"))
         .otherwise(F.lpad((F.lit(18) + k % 70).cast("string"), 3, " ")).alias("age"),
        F.col("registration_date"),
        F.when(months < 6, 1.0).otherwise(0.0).alias("ind_new_client"),
        F.lpad(months.cast("string"), 7, " ").alias("tenure_months"),
        F.when(k % 17 == 0, 99.0).otherwise(1.0).alias("client_relationship_status"),
        F.when(k % 31 == 0, F.col("fetch_date")).alias("last_date_as_primary"),
        _case(k % 7, [(0, "1"), (1, "1.0"), (2, "P"), (3, "2"), (4, "3"), (5, "4")])
         .alias("client_type_1m"),
        _case(k % 9, [(0, "I"), (1, "P"), (2, "R"), (4, "A"), (5, "A"), (6, "A"),
                      (7, "A"), (8, "A")]).alias("client_activity_1m"),
        F.lit("S").alias("ind_resident"),
        F.when(F.col("n_regionkey") == 3, "N").otherwise("S").alias("ind_foreigner"),
        F.when(k % 97 == 0, F.lit("S")).alias("ind_spouse_employee"),
        F.when(k % 43 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("K"), F.substring("c_mktsegment", 1, 2),
                             (F.col("c_nationkey") % 4).cast("string"))).alias("entry_channel"),
        F.when(k % 101 == 0, "S").otherwise("N").alias("ind_deceased"),
        F.lit(1.0).alias("address_type"),
        F.when(k % 19 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("c_nationkey").cast("double")).alias("province_code"),
        F.col("n_name").alias("province_name"),
        (k % 2).cast("double").alias("ind_client_activity"),
        F.when(k % 23 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("c_acctbal") * 100.0).alias("income"),
        _case(F.col("c_mktsegment"), SEGMENT_OF_MARKET).alias("client_segment"),
        *[F.when((k + F.month("fetch_date")) % 29 == 0, F.lit(None).cast("int"))
           .otherwise(F.col(p)).alias(p) if p == "ind_1m_large" else F.col(p)
          for p in ORDER_PRODUCTS],
    )


#: What makes each of the 24 products of the wide panel 1, in the products' order; the same text
#: is Spark and DuckDB SQL over ``orders``.
WIDE_CONDITIONS = (
    [f"o_orderpriority = '{p}'" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")]
    + [f"o_orderstatus = '{s}'" for s in "FOP"]
    + [f"o_totalprice >= {50000 * k}" for k in range(1, 9)]
    + [f"day(o_orderdate) BETWEEN {8 * k + 1} AND {8 * k + 8}" for k in range(4)]
    + [f"o_orderkey % 7 = {k}" for k in range(4)])


def wide_products() -> list[str]:
    """The 24 product columns of the full panel."""
    return product_columns(column_names())


def wide_null_rule(i: int) -> str | None:
    """Where product ``i`` of the wide panel is NULL; the same text in both engines."""
    return f"(id + month(fetch_date) + {i}) % 29 = 0" if i % 5 == 2 else None


def wide_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders per (customer, month) with the 24 product flags of the full panel, some NULL."""
    products = wide_products()
    o = read_table(spark, sf_dir, "orders")
    flags = o.groupBy(F.col("o_custkey").alias("id"), F.trunc(F.to_date("o_orderdate"), "month").alias("fetch_date")).agg(
        *[_flag(F.expr(c)).alias(p) for p, c in zip(products, WIDE_CONDITIONS)])
    rules = [(p, wide_null_rule(i)) for i, p in enumerate(products)]
    return flags.select("id", "fetch_date", *[F.col(p) if r is None else F.when(~F.expr(r), F.col(p)).alias(p) for p, r in rules])


def wide_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 48 columns of the full panel: the client columns of ``snapshot`` and 24 flags."""
    client = [c for c in column_names() if not c.startswith(PRODUCT_PREFIX)]
    rows = snapshot(spark, sf_dir).select(*client)
    return rows.join(wide_panel(spark, sf_dir), ["id", "fetch_date"]).select(*column_names())


def _by_id():
    from pyspark.sql import Window
    return Window.partitionBy("id")


NULLABLE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                    "l_shipdate", "fetch_date"]


def nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with rule-made nulls; rows with l_orderkey % 97 = 0 are junk."""
    li = read_table(spark, sf_dir, "lineitem")
    junk = F.col("l_orderkey") % 97 == 0

    def keep(c: Column, drop: Column) -> Column:
        return F.when(~drop, c)

    return li.select(
        F.col("l_orderkey"),
        keep(F.col("l_partkey"), junk).alias("l_partkey"),
        keep(F.col("l_suppkey"), junk).alias("l_suppkey"),
        keep(F.col("l_linenumber"), junk & (F.col("l_linenumber") % 2 == 0)).alias("l_linenumber"),
        keep(F.col("l_quantity"), junk | (F.col("l_suppkey") % 11 == 0)).alias("l_quantity"),
        keep(F.col("l_extendedprice"), junk).alias("l_extendedprice"),
        keep(F.col("l_discount"), junk | (F.col("l_partkey") % 5 == 0)).alias("l_discount"),
        keep(F.col("l_tax"), junk | (F.col("l_linenumber") % 3 == 0)).alias("l_tax"),
        keep(F.col("l_returnflag"), junk | (F.col("l_orderkey") % 7 == 0)).alias("l_returnflag"),
        keep(F.col("l_linestatus"), junk).alias("l_linestatus"),
        keep(F.col("l_shipdate"), junk).alias("l_shipdate"),
        keep(F.trunc(F.to_date("l_shipdate"), "month"), junk).alias("fetch_date"),
    )


SCORED_TARGETS = ["quality", "toxic"]


def scored_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    n = F.col("n_chars").cast("double")
    return (lab.join(docs, "doc_id")
               .select(F.col("doc_id").alias("row_id"),
                       F.col("quality"), F.col("toxic"),
                       F.least(F.lit(1.0), n / 20000.0).alias("proba_quality"),
                       (F.lit(1.0) / (F.lit(1.0) + n / 1000.0)).alias("proba_toxic")))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form (row_id, target, y, proba, yhat) of two label predictions."""
    w = scored_wide(spark, sf_dir)
    long = w.select("row_id", F.explode(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(t).alias("y"),
                 F.col(f"proba_{t}").alias("proba")) for t in SCORED_TARGETS])).alias("s"))
    return long.select("row_id", "s.target", "s.y", "s.proba",
                       (F.col("s.proba") >= 0.5).cast("int").alias("yhat"))


def metric_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("ts").cast("timestamp").alias("ts"), "user_id",
                     F.col("event_type").alias("target"), F.col("value").alias("response_time"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows as JSON strings; dates dd-MM-yyyy; some registration dates invalid."""
    return requests_from(snapshot(spark, sf_dir))


def requests_from(snap: DataFrame) -> DataFrame:
    """JSON request strings for snapshot rows (see ``requests``)."""
    from ..functions.rows import rows_to_json
    bad = F.col("id") % 37 == 0
    return rows_to_json(snap, bad_date=("registration_date", bad, "31-02-2016"))


def scored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-label predictions with heavily tied scores.

    Labels come from the event panel (W01, W03, W04); the score of a test row
    is the train-period acquisition rate of its product given its current
    state (0/1). The rate table has (products x 2) rows, so it is broadcast.
    """
    from ..operators.panel import build_labels
    lab = build_labels(event_panel(spark, sf_dir), EVENT_PRODUCTS)
    long = lab.select("id", "fetch_date", F.explode(F.array(*[
        F.struct(F.lit(p).alias("target"), F.col(p).alias("state"),
                 F.col("target__" + p).alias("y")) for p in EVENT_PRODUCTS])).alias("x")
    ).select("id", "fetch_date", "x.target", "x.state", "x.y")
    split = F.to_date(F.lit(EVENT_SPLIT_DATE))
    rates = (long.where(F.col("fetch_date") <= split).groupBy("target", "state")
                 .agg(F.avg("y").alias("proba")))
    test = long.where(F.col("fetch_date") > split)
    return (test.join(F.broadcast(rates), ["target", "state"])
                .select("id", "fetch_date", "target", "y", "proba",
                        (F.col("proba") >= SCORED_PANEL_THRESHOLD).cast("int").alias("yhat")))
