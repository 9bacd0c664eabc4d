"""Join-shaped queries J01-J07."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lookup as L
from ..operators import panel as P
from ..operators import profile as A
from ..schema import SEGMENT_CODES, SEGMENT_NULL_CODE
from ..sources import standins as S
from .catalog import query, r6
from .sql_standins import with_ctes

OP = S.ORDER_PRODUCTS
EP = S.EVENT_PRODUCTS


def _anti_sql():
    from .q_windows import _OUT, _order_labelled_sql
    return with_ctes(f"SELECT {_OUT} FROM ({_order_labelled_sql(True)})", "order_panel")


@query("j01_anti_join_inactive", _anti_sql())
def j01_anti_join_inactive(spark, sf):
    """Drop clients without acquisitions through a left-anti join."""
    from .q_windows import _OUT
    lab = P.build_labels(S.order_panel(spark, sf), OP)
    t = ["target__" + p for p in OP]
    out = P.drop_clients_without_acquisition(lab, t, use_window=False)
    return out.select(*_OUT.split(", "))


_SEG_SQL = ("CASE WHEN client_segment IS NULL THEN 0 " + " ".join(
    f"WHEN client_segment = '{k}' THEN {v}" for k, v in SEGMENT_CODES) + " END")


@query("j02_dictionary_map", with_ctes(
    f"SELECT id, fetch_date, client_segment, {_SEG_SQL} AS segment_code FROM snapshot",
    "snapshot"))
def j02_dictionary_map(spark, sf):
    """Segment text to code; NULL to 0, unmapped to NULL."""
    s = S.snapshot(spark, sf)
    code = L.map_values("client_segment", dict(SEGMENT_CODES), SEGMENT_NULL_CODE)
    return s.select("id", "fetch_date", "client_segment", code.alias("segment_code"))


_TRAIN = f"fetch_date <= DATE '{S.ORDER_SPLIT_DATE}'"


@query("j03_frequency_lookup", with_ctes(
    f"""SELECT t.id, t.fetch_date, t.entry_channel,
          round(coalesce(f.freq, 0.0), 6) AS entry_channel_freq
        FROM snapshot t LEFT JOIN (
          SELECT entry_channel, count(*) / (SELECT count(entry_channel) FROM snapshot
            WHERE {_TRAIN}) AS freq
          FROM snapshot WHERE {_TRAIN} AND entry_channel IS NOT NULL GROUP BY entry_channel) f
        ON t.entry_channel = f.entry_channel
        WHERE NOT ({_TRAIN})""", "snapshot"))
def j03_frequency_lookup(spark, sf):
    """Category frequency fitted on train, looked up for test rows."""
    s = S.snapshot(spark, sf)
    train, test = P.split_by_date(s, S.ORDER_SPLIT_DATE)
    table = L.frequency_table(train, "entry_channel")
    out = L.apply_frequency(test.select("id", "fetch_date", "entry_channel"), table,
                            "entry_channel")
    return out.select("id", "fetch_date", "entry_channel",
                      r6("entry_channel_freq").alias("entry_channel_freq"))


# Display names of the two document labels.
SCORED_NAMES = [("quality", "Quality"), ("toxic", "Toxic")]


@query("j04_name_predictions", with_ctes(
    "SELECT s.row_id, n.name, s.yhat AS value FROM scored s JOIN (VALUES "
    + ", ".join(f"('{t}', '{n}')" for t, n in SCORED_NAMES) + ") n(target, name) "
    "ON s.target = n.target", "scored"))
def j04_name_predictions(spark, sf):
    """Predictions labelled with display names (long form of the dict)."""
    s = S.scored(spark, sf).select("row_id", "target", F.col("yhat").alias("value"))
    names = spark.createDataFrame(SCORED_NAMES, "target string, name string")
    return L.name_predictions(s, names).select("row_id", "name", "value")


@query("j04_name_map", with_ctes(
    "SELECT s.row_id, string_agg(n.name || '=' || CAST(s.yhat AS VARCHAR), ';' ORDER BY n.name) AS predictions, "
    "count(*) AS n_names FROM scored s JOIN (VALUES "
    + ", ".join(f"('{t}', '{n}')" for t, n in SCORED_NAMES) + ") n(target, name) "
    "ON s.target = n.target GROUP BY s.row_id", "scored"))
def j04_name_map(spark, sf):
    """One map per row from display name to the predicted 0/1, shown as text by name."""
    s = S.scored(spark, sf).select("row_id", "target", F.col("yhat").alias("value"))
    names = spark.createDataFrame(SCORED_NAMES, "target string, name string")
    maps = L.as_name_map(L.name_predictions(s, names), ["row_id"])
    shown = F.transform(F.array_sort(F.map_keys("predictions")),
                        lambda name: F.concat(name, F.lit("="), F.col("predictions")[name].cast("string")))
    return maps.select("row_id", F.concat_ws(";", shown).alias("predictions"),
                       F.size("predictions").cast("long").alias("n_names"))


@query("j05_align_rows", with_ctes(
    f"""SELECT f.id, f.fetch_date, f.income, l.target__ind_1m_urgent
        FROM (SELECT * FROM snapshot WHERE ind_deceased = 'N') f
        JOIN (SELECT id, fetch_date, target__ind_1m_urgent FROM (
          SELECT *, coalesce(CAST((ind_1m_urgent = 0 AND lead(ind_1m_urgent) OVER w = 1)
            AS INTEGER), 0) AS target__ind_1m_urgent, lead(id) OVER w AS _nid FROM order_panel
          WINDOW w AS (PARTITION BY id ORDER BY fetch_date)) WHERE _nid IS NOT NULL) l
        ON f.id = l.id AND f.fetch_date = l.fetch_date""", "snapshot"))
def j05_align_rows(spark, sf):
    """Labels aligned with the rows that survive cleaning (inner join on keys)."""
    feats = P.keep_equal(S.snapshot(spark, sf), "ind_deceased", "N").select(
        "id", "fetch_date", "income")
    labels = P.build_labels(S.order_panel(spark, sf), ["ind_1m_urgent"]).select(
        "id", "fetch_date", "target__ind_1m_urgent")
    return L.align_rows(feats, labels, ["id", "fetch_date"])


def _rates_sql():
    from .q_aggs import _labels_long_sql
    return _labels_long_sql(f"fetch_date <= DATE '{S.ORDER_SPLIT_DATE}'")


@query("j06_label_names", with_ctes(
    f"""SELECT r.target, n.name, round(r.rate, 6) AS rate FROM (
          SELECT target, avg(y) AS rate FROM ({_rates_sql()}) GROUP BY target) r
        LEFT JOIN (VALUES {', '.join(f"('{c}', '{n}')" for c, n in S.ORDER_PRODUCT_NAMES)})
          n(col, name) ON substring(r.target, 9) = n.col""", "order_panel"))
def j06_label_names(spark, sf):
    """Target column to display name (strip prefix, join the product dimension)."""
    from .q_aggs import _order_labels_long
    rates = A.label_rates(_order_labels_long(spark, sf))
    dim = spark.createDataFrame([(c, n, n) for c, n in S.ORDER_PRODUCT_NAMES],
                                "column string, name_ru string, name_en string")
    return L.label_names(rates, dim, "target").select("target", "name", r6("rate").alias("rate"))


def _series_sql():
    return "concat('stats_counts.target.', upper(substring(target, 1, 1)), substring(target, 2))"


@query("j07_relabel_series", with_ctes(
    f"""SELECT s.series, n.display_name, count(*) AS n FROM (
          SELECT {_series_sql()} AS series FROM metric_events) s
        LEFT JOIN (VALUES {', '.join(f"('{n}')" for _, n in S.EVENT_PRODUCT_NAMES)}) n(display_name)
          ON regexp_matches(s.series, '.*' || replace(n.display_name, ' ', '_') || '.*')
        GROUP BY s.series, n.display_name""", "metric_events"))
def j07_relabel_series(spark, sf):
    """Metric series relabelled by a name pattern (regex theta join)."""
    ev = S.metric_events(spark, sf)
    series = ev.select(F.concat(F.lit("stats_counts.target."),
                                F.upper(F.substring("target", 1, 1)),
                                F.substring("target", 2, 1 << 20)).alias("series"))
    dim = spark.createDataFrame([(c, n, n) for c, n in S.EVENT_PRODUCT_NAMES],
                                "column string, name_ru string, name_en string")
    r = L.relabel_series(series, dim)
    return r.groupBy("series", "display_name").agg(F.count(F.lit(1)).alias("n"))
