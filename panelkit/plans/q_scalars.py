"""Scalar-function queries F01-F16 on the client snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..sources import standins as S
from .catalog import query, r6
from .sql_standins import with_ctes

OP = S.ORDER_PRODUCTS


def _snap(spark, sf):
    return S.snapshot(spark, sf)


@query("f01_number_of_products", with_ctes(
    "SELECT id, fetch_date, " + " + ".join(f"coalesce({p}, 0)" for p in OP)
    + " AS number_of_products FROM snapshot", "snapshot"))
def f01_number_of_products(spark, sf):
    """row total of product flags, NULLs skipped."""
    return _snap(spark, sf).select("id", "fetch_date",
                                   X.number_of_products(OP).alias("number_of_products"))


@query("f02_f03_dates", with_ctes(
    "SELECT id, fetch_date, CAST(year(fetch_date) AS INTEGER) AS fetch_year, "
    "CAST(month(fetch_date) AS INTEGER) AS fetch_month, "
    "CAST((year(fetch_date) - year(registration_date)) * 12 + (month(fetch_date) - "
    "month(registration_date)) AS INTEGER) AS tenure FROM snapshot", "snapshot"))
def f02_f03_dates(spark, sf):
    """F02 year / month, F03 whole-month difference (day ignored)."""
    s = _snap(spark, sf)
    return s.select("id", "fetch_date", X.year_of("fetch_date").alias("fetch_year"),
                    X.month_of("fetch_date").alias("fetch_month"),
                    X.whole_month_diff("fetch_date", "registration_date").alias("tenure"))


@query("f04_log", with_ctes(
    "SELECT id, fetch_date, round(CASE WHEN income > 0 THEN ln(income) END, 6) AS log_income "
    "FROM snapshot", "snapshot"))
def f04_log(spark, sf):
    """natural log; 0, negatives and NULL give NULL."""
    return _snap(spark, sf).select("id", "fetch_date",
                                   r6(X.log_or_null("income")).alias("log_income"))


_NUM = "TRY_CAST(trim(client_type_1m) AS DOUBLE)"


@query("f05_f06_numeric_parse", with_ctes(
    f"SELECT id, fetch_date, client_type_1m, {_NUM} AS parsed, "
    f"CASE WHEN client_type_1m = 'P' THEN 5.0 ELSE {_NUM} END AS parsed_p5 FROM snapshot",
    "snapshot"))
def f05_f06_numeric_parse(spark, sf):
    """F05 numeric parse (bad text to NULL); F06 replace 'P' by 5 before parsing
    (the reference parses first, so 'P' never becomes 5, X5)."""
    s = _snap(spark, sf)
    p5 = F.when(F.col("client_type_1m") == "P", F.lit(5.0)).otherwise(X.to_numeric("client_type_1m"))
    return s.select("id", "fetch_date", "client_type_1m",
                    X.to_numeric("client_type_1m").alias("parsed"), p5.alias("parsed_p5"))


@query("f07_f08_fill_nulls", with_ctes(
    """SELECT id, fetch_date, coalesce(province_code, 0.0) AS province_code,
         coalesce(gender, 'V') AS gender, coalesce(client_activity_1m, 'N') AS client_activity_1m,
         coalesce(entry_channel, 'UNK') AS entry_channel,
         coalesce(ind_spouse_employee, '0') AS ind_spouse_employee,
         coalesce(last_date_as_primary, DATE '1970-01-01') AS last_date_as_primary,
         round(coalesce(CASE WHEN income > 0 THEN ln(income) END,
           (SELECT quantile_cont(CASE WHEN income > 0 THEN ln(income) END, 0.5) FROM snapshot)),
           6) AS log_income
       FROM snapshot""", "snapshot"))
def f07_f08_fill_nulls(spark, sf):
    """F07 + F08: per-column fill constants (median of log income), the rest 0 / "0";
    F08 fill the rest with 0 ('0' for text)."""
    from ..operators.profile import median
    s = _snap(spark, sf).withColumn("log_income", X.log_or_null("income"))
    med = median(s, "log_income").withColumn("_k", F.lit(0))
    # One-row fitted constant joined on a constant key (a broadcast of one row).
    j = s.withColumn("_k", F.lit(0)).join(F.broadcast(med), "_k")
    filled = j.fillna({"province_code": 0.0, "gender": "V", "client_activity_1m": "N",
                       "entry_channel": "UNK"}).fillna("0", subset=["ind_spouse_employee"])
    return filled.select(
        "id", "fetch_date", "province_code", "gender", "client_activity_1m", "entry_channel",
        "ind_spouse_employee",
        F.coalesce("last_date_as_primary", F.to_date(F.lit("1970-01-01"))).alias("last_date_as_primary"),
        r6(F.coalesce("log_income", "median")).alias("log_income"))


_INTS = ["age", "tenure_months", "ind_new_client", "client_relationship_status",
         "ind_client_activity", "province_code", "client_type_1m"]


@query("f09_to_int", with_ctes(
    "SELECT id, fetch_date, " + ", ".join(
        f"TRY_CAST(TRY_CAST(trim(CAST({c} AS VARCHAR)) AS DOUBLE) AS INTEGER) AS {c}" for c in _INTS)
    + " FROM snapshot", "snapshot"))
def f09_to_int(spark, sf):
    """integer casts of padded text and float codes (bad text to NULL)."""
    return _snap(spark, sf).select("id", "fetch_date", *[X.to_int(c).alias(c) for c in _INTS])


@query("f10_null_and_zero_tests", with_ctes(
    "SELECT id, fetch_date, income IS NULL AS income_is_null, "
    "ind_1m_large = 0 AS large_is_zero FROM snapshot", "snapshot"))
def f10_null_and_zero_tests(spark, sf):
    """NULL test and equality to zero."""
    return _snap(spark, sf).select("id", "fetch_date", X.is_null("income").alias("income_is_null"),
                                   X.eq_zero("ind_1m_large").alias("large_is_zero"))


@query("f11_format_dates", with_ctes(
    "SELECT id, fetch_date, strftime(registration_date, '%d-%m-%Y') AS registration_text, "
    "strftime(last_date_as_primary, '%Y-%m-%d') AS primary_text FROM snapshot", "snapshot"))
def f11_format_dates(spark, sf):
    """date to text, NULL-safe."""
    s = _snap(spark, sf)
    return s.select("id", "fetch_date",
                    X.format_date("registration_date", "dd-MM-yyyy").alias("registration_text"),
                    X.format_date("last_date_as_primary", "yyyy-MM-dd").alias("primary_text"))


_REQ_DATE = ("CASE WHEN id % 37 = 0 THEN '31-02-2016' "
             "ELSE strftime(registration_date, '%d-%m-%Y') END")


@query("f12_parse_dates", with_ctes(
    f"SELECT id, fetch_date, CAST(try_strptime({_REQ_DATE}, '%d-%m-%Y') AS DATE) AS parsed "
    "FROM snapshot", "snapshot"))
def f12_parse_dates(spark, sf):
    """text to date; invalid dates (31 February) give NULL."""
    s = _snap(spark, sf)
    text = F.when(F.col("id") % 37 == 0, F.lit("31-02-2016")).otherwise(
        F.date_format("registration_date", "dd-MM-yyyy"))
    return s.select("id", "fetch_date", text.alias("_t")).select(
        "id", "fetch_date", X.parse_date("_t", "dd-MM-yyyy").alias("parsed"))


@query("f13_fill_with_mean", with_ctes(
    "SELECT id, fetch_date, round(coalesce(income, (SELECT avg(income) FROM snapshot "
    f"WHERE fetch_date <= DATE '{S.ORDER_SPLIT_DATE}')), 6) AS income FROM snapshot", "snapshot"))
def f13_fill_with_mean(spark, sf):
    """NULL income to the stored train mean."""
    s = _snap(spark, sf)
    mean = (s.where(F.col("fetch_date") <= F.to_date(F.lit(S.ORDER_SPLIT_DATE)))
             .agg(F.avg("income").alias("_m")).withColumn("_k", F.lit(0)))
    j = s.withColumn("_k", F.lit(0)).join(F.broadcast(mean), "_k")
    return j.select("id", "fetch_date", r6(F.coalesce("income", "_m")).alias("income"))


@query("f14_round", with_ctes(
    "SELECT row_id, target, round(proba, 4) AS proba FROM scored", "scored"))
def f14_round(spark, sf):
    """round to 4 places."""
    return S.scored(spark, sf).select("row_id", "target", X.round_to("proba", 4).alias("proba"))


@query("f15_strip_prefix", with_ctes(
    "SELECT target, starts_with(target, 'target__') AS is_target, "
    "CASE WHEN starts_with(target, 'target__') THEN substring(target, 9) END AS product, "
    "count(*) AS n FROM (" + __import__("panelkit.plans.q_aggs", fromlist=["x"])._labels_long_sql()
    + ") GROUP BY target", "order_panel"))
def f15_strip_prefix(spark, sf):
    """starts-with test and substring after the label prefix."""
    from .q_aggs import _order_labels_long
    long = _order_labels_long(spark, sf, train_only=False)
    t = F.col("target")
    return long.groupBy("target").agg(F.count(F.lit(1)).alias("n")).select(
        "target", t.startswith("target__").alias("is_target"),
        F.when(t.startswith("target__"), X.strip_prefix("target", "target__")).alias("product"),
        "n")


@query("f15_underscore_blanks", with_ctes(
    "SELECT id, fetch_date, replace(province_name, ' ', '_') AS series_name FROM snapshot",
    "snapshot"))
def f15_underscore_blanks(spark, sf):
    """blanks to underscores (metric-series names)."""
    return _snap(spark, sf).select("id", "fetch_date",
                                   X.underscore_blanks("province_name").alias("series_name"))
