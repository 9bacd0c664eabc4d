"""Loads over time: bad records set aside (S01, S06), batch-by-batch labels (S03, S05, W10), the key check
(X1) and sketches per period (A01, A15, A19)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rows import rows_to_json
from ..operators import panel as P
from ..operators import sketches as K
from ..session import scratch_dir
from ..sources import increments as I
from ..sources import quarantine as Q
from ..sources import standins as S
from ..sources.io import _CSV_TEXT
from ..sources.tables import read_table
from .catalog import query
from .q_windows import _sql_targets
from .sql_standins import with_ctes

OP = S.ORDER_PRODUCTS
_BAD_DATE, _BAD_FIELDS, _BAD_INCOME = "id % 41 = 0", "id % 43 = 1", "id % 47 = 2"
_CSV_REASON = (f"CASE WHEN {_BAD_FIELDS} THEN 'fields' WHEN {_BAD_DATE} THEN 'registration_date' "
               f"WHEN {_BAD_INCOME} THEN 'income' END")


def _broken_csv(spark, sf):
    """The snapshot as CSV lines, some with a wrong date, a wrong number or one field too many."""
    snap = S.snapshot(spark, sf)
    text = {f.name: F.date_format(f.name, "yyyy-MM-dd") if isinstance(f.dataType, T.DateType) else F.col(f.name).cast("string")
            for f in snap.schema.fields}
    text["registration_date"] = F.when(F.expr(_BAD_DATE), "soon").otherwise(text["registration_date"])
    text["income"] = F.when(F.expr(_BAD_INCOME), "abc").otherwise(text["income"])
    line = F.to_csv(F.struct(*[c.alias(n) for n, c in text.items()]), dict(_CSV_TEXT))
    path = os.path.join(scratch_dir(spark, "broken"), "csv")
    snap.select(F.concat(line, F.when(F.expr(_BAD_FIELDS), ",x").otherwise("")).alias("value")).write.text(path)
    return snap.schema, path


@query("s01_rows_without_rejects", with_ctes(f"SELECT * FROM snapshot WHERE {_CSV_REASON} IS NULL", "snapshot"))
def s01_rows_without_rejects(spark, sf):
    """The typed rows of a CSV with broken records; none of these stops the load."""
    schema, path = _broken_csv(spark, sf)
    return Q.read_csv_split(spark, path, schema, header=False)[0]


@query("s01_reject_table", with_ctes(
    f"SELECT id, reason, count(*) AS n FROM (SELECT id, {_CSV_REASON} AS reason FROM snapshot) WHERE reason IS NOT NULL GROUP BY id, reason",
    "snapshot"))
def s01_reject_table(spark, sf):
    """The rejects with their reason, written as a table; good and rejected rows are all rows."""
    schema, path = _broken_csv(spark, sf)
    table = os.path.join(scratch_dir(spark, "rejects"), "table")
    Q.read_csv_split(spark, path, schema, header=False)[1].write.parquet(table)
    rejects = spark.read.parquet(table)
    return rejects.groupBy(F.split("record", ",")[schema.fieldNames().index("id")].cast("long").alias("id"), "reason").agg(F.count("*").alias("n"))


@query("s06_reject_requests", with_ctes(
    "SELECT * FROM (SELECT id, fetch_date, CASE WHEN id % 29 = 3 THEN 'json' WHEN id % 37 = 0 THEN 'registration_date' END AS reason "
    "FROM snapshot) WHERE reason IS NOT NULL", "snapshot"))
def s06_reject_requests(spark, sf):
    """Requests that are no JSON object or hold a wrong date, with the reason."""
    snap = S.snapshot(spark, sf)
    sent = rows_to_json(snap, bad_date=("registration_date", F.col("id") % 37 == 0, "31-31-2020"), keep=("id", "fetch_date"))
    sent = sent.withColumn("value", F.when(F.col("id") % 29 == 3, F.expr("left(value, 20)")).otherwise(F.col("value")))
    return Q.json_split(sent, snap.schema)[1].select("id", "fetch_date", "reason")


@query("w10_load_by_load", with_ctes(
    f"SELECT id, fetch_date, {', '.join(OP)}, {', '.join('target__' + p for p in OP)} FROM (SELECT *, {_sql_targets(OP)}, lead(id) OVER w AS _nid "
    "FROM order_panel WINDOW w AS (PARTITION BY id ORDER BY fetch_date)) WHERE _nid IS NOT NULL", "order_panel"))
def w10_load_by_load(spark, sf):
    """S03 + S05 + W10: the panel loaded year by year gives the labels of one full run."""
    base = scratch_dir(spark, "loads")
    S.order_panel(spark, sf).write.parquet(os.path.join(base, "raw"))
    raw = spark.read.parquet(os.path.join(base, "raw"))
    # one load a year: as many rows here as the panel has years
    for row in raw.select(F.year("fetch_date").alias("y")).distinct().orderBy("y").collect():
        I.load_batch(raw.where(F.year("fetch_date") == row.y), os.path.join(base, "panel"), f"{row.y}-01-01", OP)
    return I.labels(spark, os.path.join(base, "panel"), OP)


@query("x01_duplicate_keys",
       "SELECT user_id AS id, CAST(ts AS DATE) AS fetch_date, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def x01_duplicate_keys(spark, sf):
    """(client, day) keys that raw events repeat; a label job stops at them."""
    rows = read_table(spark, sf, "events").select(F.col("user_id").alias("id"), F.to_date("ts").alias("fetch_date"))
    return P.duplicate_keys(rows)


_SKETCHED = ["id", "income", "province_name", "age", "ind_1m_large"]


@query("a15_sketch_profile", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_null, true AS distinct_ok, true AS median_ok "
    f"FROM snapshot WHERE fetch_date >= DATE '{S.ORDER_START_DATE}'" for c in _SKETCHED), "snapshot"))
def a15_sketch_profile(spark, sf):
    """A01 + A15 + A19 from sketches per month, written once and merged for a range of months; distinct
    counts within 5% and the median within 2% of the ranks of the exact answer."""
    snap = S.snapshot(spark, sf)
    path = os.path.join(scratch_dir(spark, "sketches"), "table")
    K.period_sketches(snap, _SKETCHED).write.parquet(path)
    since = F.to_date(F.lit(S.ORDER_START_DATE))
    merged = K.merge_sketches(spark.read.parquet(path).where(F.col("period") >= since))
    got = K.read_sketches(merged, [0.5])
    rows = snap.where(F.col("fetch_date") >= since)
    # one estimate a column: five rows beside every snapshot row would be a cross join, so they go in as literals
    median = {r["column"]: r["q50"] for r in got.collect()}
    numbers = [c for c in _SKETCHED if median.get(c) is not None]
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in _SKETCHED],
                     *[F.avg((F.col(c) < median[c]).cast("double")).alias(f"below_{c}") for c in numbers],
                     *[F.avg((F.col(c) <= median[c]).cast("double")).alias(f"upto_{c}") for c in numbers])
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("of"), F.col(c).alias("d"), (F.col(f"below_{c}") if c in numbers else F.lit(0.0)).alias("below"),
                 (F.col(f"upto_{c}") if c in numbers else F.lit(1.0)).alias("upto")) for c in _SKETCHED]))
    exact = exact.select(cells.alias("e")).select("e.*")
    return got.join(exact, F.col("column") == F.col("of")).select(
        "column", "n_rows", "n_null", (F.abs(F.col("approx_distinct") - F.col("d")) <= 0.05 * F.col("d")).alias("distinct_ok"),
        ((F.col("below") <= 0.52) & (F.col("upto") >= 0.48)).alias("median_ok"))
