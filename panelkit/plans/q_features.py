"""Feature queries F17, E01-E05, E12 on the client snapshot (fit on train, apply to test)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import panel as P
from ..schema import NUMERICAL_COLUMNS, ONE_HOT_COLUMNS, SEGMENT_CODES
from ..sources import standins as S
from .catalog import query, r6
from .sql_standins import with_ctes

OP = S.ORDER_PRODUCTS
_SPLIT = f"DATE '{S.ORDER_SPLIT_DATE}'"


def _split(spark, sf):
    return P.split_by_date(S.snapshot(spark, sf), S.ORDER_SPLIT_DATE)


_FITTED: dict = {}


def _fitted(spark, sf) -> FE.FittedFeatures:
    """Encoders fitted on the train split, memoised per application and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        _FITTED[key] = FE.FeatureEncoder(OP).fit(_split(spark, sf)[0])
    return _FITTED[key]


def _toint(e):
    return f"TRY_CAST(TRY_CAST(trim(CAST({e} AS VARCHAR)) AS DOUBLE) AS INTEGER)"


_LOGINC = "CASE WHEN income > 0 THEN ln(income) END"
_SEG = ("CAST(CASE WHEN client_segment IS NULL THEN 0 " + " ".join(
    f"WHEN client_segment = '{k}' THEN {v}" for k, v in SEGMENT_CODES) + " END AS DOUBLE)")
_MONTHS = ("(year(fetch_date) - year(registration_date)) * 12 + "
           "(month(fetch_date) - month(registration_date))")


def processed_sql(where: str) -> str:
    """DuckDB twin of ``process_frame`` with the median fitted on train rows."""
    med = f"(SELECT quantile_cont({_LOGINC}, 0.5) FROM snapshot WHERE fetch_date <= {_SPLIT})"
    nprod = " + ".join(f"coalesce({p}, 0)" for p in OP)
    return f"""SELECT id, fetch_date,
      coalesce(gender, 'V') AS gender,
      coalesce({_toint('age')}, 0) AS age,
      coalesce({_toint('ind_new_client')}, 0) AS ind_new_client,
      coalesce({_toint(_MONTHS)}, 0) AS tenure_months,
      coalesce({_toint('client_relationship_status')}, 0) AS client_relationship_status,
      coalesce({_toint("coalesce(TRY_CAST(trim(client_type_1m) AS DOUBLE), 0.0)")}, 0)
        AS client_type_1m,
      coalesce(client_activity_1m, 'N') AS client_activity_1m,
      coalesce(ind_foreigner, '0') AS ind_foreigner,
      coalesce(entry_channel, 'UNK') AS entry_channel,
      coalesce({_toint('coalesce(province_code, 0.0)')}, 0) AS province_code,
      coalesce({_toint('ind_client_activity')}, 0) AS ind_client_activity,
      coalesce({_LOGINC}, {med}) AS income,
      coalesce({_SEG}, 0.0) AS client_segment,
      {', '.join(f'coalesce({p}, 0) AS {p}' for p in OP)},
      coalesce({_toint(nprod)}, 0) AS number_of_products,
      CAST(year(fetch_date) AS INTEGER) AS fetch_year,
      CAST(month(fetch_date) AS INTEGER) AS fetch_month
    FROM snapshot WHERE {where}"""


def _rounded(df):
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("f17_process_frame", with_ctes(
    "SELECT * REPLACE (round(income, 6) AS income) FROM (" + processed_sql(f"fetch_date > {_SPLIT}")
    + ")", "snapshot"))
def f17_process_frame(spark, sf):
    """the full per-row feature step on test rows, median fitted on train."""
    train, test = _split(spark, sf)
    fitted = _fitted(spark, sf)
    return _rounded(FE.process_frame(test, OP, fitted.median_log_income))


def _minmax_sql():
    lohi = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in NUMERICAL_COLUMNS)
    scaled = ", ".join(
        f"round(CASE WHEN hi_{c} = lo_{c} THEN 0.0 ELSE (CAST(t.{c} AS DOUBLE) - lo_{c}) / "
        f"(hi_{c} - lo_{c}) END, 6) AS {c}" for c in NUMERICAL_COLUMNS)
    return (f"SELECT t.id, t.fetch_date, {scaled} FROM ({processed_sql(f'fetch_date > {_SPLIT}')}) t, "
            f"(SELECT {lohi} FROM ({processed_sql(f'fetch_date <= {_SPLIT}')})) m")


@query("e01_min_max_scaling", with_ctes(_minmax_sql(), "snapshot"))
def e01_min_max_scaling(spark, sf):
    """Min-max scaling fitted on train (constant column -> 0)."""
    train, test = _split(spark, sf)
    fitted = _fitted(spark, sf)
    out = fitted.transform(test)
    return _rounded(out.select("id", "fetch_date", *NUMERICAL_COLUMNS))


def _categories_sql():
    parts = []
    for c in ONE_HOT_COLUMNS:
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(v AS VARCHAR) AS category, "
            f"CAST(row_number() OVER (ORDER BY v) AS INTEGER) AS position FROM "
            f"(SELECT DISTINCT {c} AS v FROM ({processed_sql(f'fetch_date <= {_SPLIT}')}))")
    return ("SELECT \"column\", category, position, position = 1 AS dropped FROM ("
            + " UNION ALL ".join(parts) + ")")


@query("e02_one_hot_categories", with_ctes(_categories_sql(), "snapshot"))
def e02_one_hot_categories(spark, sf):
    """Fitted one-hot categories in sorted order; the first is dropped."""
    train, _ = _split(spark, sf)
    fitted = _fitted(spark, sf)
    rows = []
    types = dict(FE.process_frame(train, OP, 0.0).dtypes)
    for c in ONE_HOT_COLUMNS:
        for i, v in enumerate(fitted.categories[c], start=1):
            text = (f"{float(v)}" if types[c] == "double" else str(v))
            rows.append((c, text, i, i == 1))
    return spark.createDataFrame(rows, "column string, category string, position int, dropped boolean")


@query("e02_one_hot_encoded", with_ctes(
    "SELECT id, fetch_date, gender, CAST(gender = 'V' AS DOUBLE) AS gender_V "
    f"FROM ({processed_sql(f'fetch_date > {_SPLIT}')})", "snapshot"))
def e02_one_hot_encoded(spark, sf):
    """Drop-first one-hot columns of the test rows (gender shown)."""
    train, test = _split(spark, sf)
    fitted = _fitted(spark, sf)
    out = fitted.transform(test)
    proc = FE.process_frame(test, OP, fitted.median_log_income).select("id", "fetch_date", "gender")
    return proc.join(out.select("id", "fetch_date", "gender_V"), ["id", "fetch_date"])


def _freq_sql():
    train = processed_sql(f"fetch_date <= {_SPLIT}")
    test = processed_sql(f"fetch_date > {_SPLIT}")
    sel = []
    joins = []
    for i, c in enumerate(["entry_channel", "province_code"]):
        joins.append(
            f"LEFT JOIN (SELECT {c} AS v, count(*) / (SELECT count({c}) FROM ({train})) AS f "
            f"FROM ({train}) WHERE {c} IS NOT NULL GROUP BY {c}) f{i} ON t.{c} = f{i}.v")
        sel.append(f"round(coalesce(f{i}.f, 0.0), 6) AS {c}_freq")
    return f"SELECT t.id, t.fetch_date, {', '.join(sel)} FROM ({test}) t " + " ".join(joins)


@query("e03_frequency_encoding", with_ctes(_freq_sql(), "snapshot"))
def e03_frequency_encoding(spark, sf):
    """Frequency encoding fitted on train; unseen values encode to 0."""
    train, test = _split(spark, sf)
    fitted = _fitted(spark, sf)
    out = fitted.transform(test)
    return _rounded(out.select("id", "fetch_date", "entry_channel_freq", "province_code_freq"))


@query("e04_assembled_features")
def e04_assembled_features(spark, sf):
    """E04 + E05: fit on train, transform and assemble test rows into one vector."""
    from pyspark.ml.functions import vector_to_array
    train, test = _split(spark, sf)
    fitted = _fitted(spark, sf)
    a = fitted.assemble(fitted.transform(test))
    return a.select("id", "fetch_date", vector_to_array("features").alias("features"))


@query("e12_feature_names")
def e12_feature_names(spark, sf):
    """Feature names after encoding, in assembled order."""
    train, _ = _split(spark, sf)
    fitted = _fitted(spark, sf)
    return spark.createDataFrame(list(enumerate(fitted.feature_names)),
                                 "position int, feature string")
