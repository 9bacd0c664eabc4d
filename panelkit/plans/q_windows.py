"""Window operators W01-W10 over the event and order panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import panel as P
from ..sources import standins as S
from .catalog import query, r6
from .sql_standins import with_ctes

EP = S.EVENT_PRODUCTS
OP = S.ORDER_PRODUCTS


def _sql_lead(products, fn="lead", suffix="_next"):
    return ", ".join(
        f"{fn}({p}) OVER (PARTITION BY id ORDER BY fetch_date) AS {p}{suffix}" for p in products)


def _sql_targets(products):
    return ", ".join(
        f"coalesce(CAST(({p} = 0 AND lead({p}) OVER w = 1) AS INTEGER), 0) AS target__{p}"
        for p in products)


@query("w01_lead_products", with_ctes(
    f"SELECT id, fetch_date, {_sql_lead(EP)} FROM event_panel", "event_panel"))
def w01_lead_products(spark, sf):
    """Next row's product flags per client."""
    d = S.event_panel(spark, sf)
    return P.lead_products(d, EP).select("id", "fetch_date", *[p + "_next" for p in EP])


@query("w02_lag_products", with_ctes(
    f"SELECT id, fetch_date, {_sql_lead(OP, 'lag', '_prev')} FROM order_panel", "order_panel"))
def w02_lag_products(spark, sf):
    """Previous row's product flags per client."""
    d = S.order_panel(spark, sf)
    return P.lag_products(d, OP).select("id", "fetch_date", *[p + "_prev" for p in OP])


W03_SQL = with_ctes(
    f"SELECT id, fetch_date, {_sql_targets(EP)} FROM event_panel "
    "WINDOW w AS (PARTITION BY id ORDER BY fetch_date)", "event_panel")


@query("w03_acquisition_labels", W03_SQL)
def w03_acquisition_labels(spark, sf):
    """target__p = 1 when p is 0 now and 1 in the next row."""
    d = S.event_panel(spark, sf)
    t = P.add_targets(d, EP)
    return t.select("id", "fetch_date", *["target__" + p for p in EP])


W04_BODY = (
    f"""SELECT id, fetch_date, {', '.join(EP)}, {', '.join('target__' + p for p in EP)} FROM (
      SELECT *, {_sql_targets(EP)}, lead(id) OVER w AS _nid FROM event_panel
      WINDOW w AS (PARTITION BY id ORDER BY fetch_date)) WHERE _nid IS NOT NULL""")
W04_SQL = with_ctes(W04_BODY, "event_panel")


@query("w04_drop_last_row", W04_SQL)
def w04_drop_last_row(spark, sf):
    """Labelled panel without each client's last row."""
    return P.build_labels(S.event_panel(spark, sf), EP)


def _order_labelled_sql(drop_inactive: bool) -> str:
    inner = f"""SELECT * FROM (
      SELECT *, {_sql_targets(OP)}, lead(id) OVER w AS _nid FROM order_panel
      WINDOW w AS (PARTITION BY id ORDER BY fetch_date)) WHERE _nid IS NOT NULL"""
    if not drop_inactive:
        return inner
    anyt = "greatest(" + ", ".join("target__" + p for p in OP) + ")"
    return f"""SELECT * FROM ({inner}) x WHERE id NOT IN (
      SELECT id FROM ({inner}) y GROUP BY id HAVING max({anyt}) = 0)"""


_OUT = ", ".join(["id", "fetch_date"] + OP + ["target__" + p for p in OP])


@query("w05_drop_inactive_clients", with_ctes(
    f"SELECT {_OUT} FROM ({_order_labelled_sql(True)})", "order_panel"))
def w05_drop_inactive_clients(spark, sf):
    """Drop clients without any acquisition (after W04), window form."""
    d = P.build_labels(S.order_panel(spark, sf), OP, drop_inactive=True)
    return d.select(*_OUT.split(", "))


@query("w06_product_diff", with_ctes(
    "SELECT id, fetch_date, " + ", ".join(
        f"{p} - lag({p}) OVER (PARTITION BY id ORDER BY fetch_date) AS {p}_diff" for p in OP)
    + " FROM order_panel", "order_panel"))
def w06_product_diff(spark, sf):
    """Difference to the previous row per product."""
    return P.product_changes(S.order_panel(spark, sf), OP)


def _sql_changes(products):
    diffs = ", ".join(
        f"{p} - lag({p}) OVER (PARTITION BY id ORDER BY fetch_date) AS d_{p}" for p in products)

    def tot(cond):
        return " + ".join(f"sum(CASE WHEN {cond.format(f'd_{p}')} THEN 1 ELSE 0 END)"
                          for p in products)
    return (f"SELECT CAST({tot('{} <> 0')} AS BIGINT) AS n_changes, "
            f"CAST({tot('{} = 1')} AS BIGINT) AS n_up, CAST({tot('{} = -1')} AS BIGINT) AS n_down "
            f"FROM (SELECT {diffs} FROM order_panel)")


@query("w07_count_changes", with_ctes(_sql_changes(OP), "order_panel"))
def w07_count_changes(spark, sf):
    """Number of changes: any, +1 only, -1 only."""
    return P.count_changes(S.order_panel(spark, sf), OP)


def _sql_transitions(products, src):
    pairs = " UNION ALL ".join(
        f"SELECT lag({p}) OVER (PARTITION BY id ORDER BY fetch_date) AS prev, {p} AS cur FROM {src}"
        for p in products)
    comp = ("SELECT sum(" + " + ".join(f"c_{p} - CASE WHEN c_{p} > 0 THEN 1 ELSE 0 END"
                                       for p in products)
            + ") FROM (SELECT id, " + ", ".join(f"count({p}) AS c_{p}" for p in products)
            + f" FROM {src} GROUP BY id)")
    return f"""SELECT prev, cur, count(*) AS n, round(count(*) / ({comp}), 6) AS share
      FROM ({pairs}) WHERE prev IS NOT NULL AND cur IS NOT NULL GROUP BY prev, cur"""


@query("w08_transition_table", with_ctes(_sql_transitions(OP, "order_panel"), "order_panel"))
def w08_transition_table(spark, sf):
    """0->0, 0->1, 1->0, 1->1 counts and shares of comparable cells."""
    t = P.transition_table(S.order_panel(spark, sf), OP)
    return t.select("prev", "cur", "n", r6("share").alias("share"))


def _sql_period_totals(products, src):
    return " UNION ALL ".join(
        f"SELECT '{p}' AS product, fetch_date, CAST(sum({p}) AS BIGINT) AS total "
        f"FROM {src} GROUP BY fetch_date" for p in products)


@query("w09_period_total_changes", with_ctes(
    f"""SELECT product, fetch_date, total, change,
          CASE WHEN change > 0 THEN change ELSE 0 END AS gain FROM (
        SELECT product, fetch_date, total,
          coalesce(total - lag(total) OVER (PARTITION BY product ORDER BY fetch_date), 0) AS change
        FROM ({_sql_period_totals(EP, 'event_panel')}))""", "event_panel"))
def w09_period_total_changes(spark, sf):
    """Change of period totals vs previous period, positives only as gain."""
    return P.period_total_changes(S.event_panel(spark, sf), EP)


@query("w10_label_split_test", with_ctes(
    f"SELECT {_OUT} FROM ({_order_labelled_sql(True)}) "
    f"WHERE fetch_date > DATE '{S.ORDER_SPLIT_DATE}'", "order_panel"))
def w10_label_split_test(spark, sf):
    """Full target build (W01, W03, W04, W05) then the test side of the split."""
    _, test = P.label_and_split(S.order_panel(spark, sf), OP, S.ORDER_SPLIT_DATE)
    return test.select(*_OUT.split(", "))


@query("w10_label_split_train", with_ctes(
    f"SELECT {_OUT} FROM ({_order_labelled_sql(True)}) "
    f"WHERE fetch_date <= DATE '{S.ORDER_SPLIT_DATE}'", "order_panel"))
def w10_label_split_train(spark, sf):
    """Full target build then the train side of the split."""
    train, _ = P.label_and_split(S.order_panel(spark, sf), OP, S.ORDER_SPLIT_DATE)
    return train.select(*_OUT.split(", "))


@query("w03_acquisitions_per_period", with_ctes(
    " UNION ALL ".join(
        f"SELECT '{p}' AS product, fetch_date, CAST(sum(target__{p}) AS BIGINT) AS acquisitions "
        f"FROM ({W04_BODY}) GROUP BY fetch_date" for p in EP),
    "event_panel"))
def w03_acquisitions_per_period(spark, sf):
    """Flagship: new product take-ups per product and period."""
    lab = P.build_labels(S.event_panel(spark, sf), EP)
    long = lab.select("fetch_date", F.explode(F.array(*[
        F.struct(F.lit(p).alias("product"), F.col("target__" + p).alias("y")) for p in EP]))
        .alias("x"))
    return (long.groupBy("x.product", "fetch_date")
                .agg(F.sum("x.y").cast("long").alias("acquisitions")))


@query("f16_percent_shares", with_ctes(
    f"SELECT prev, cur, printf('%.2f%%', share * 100) AS share_text FROM "
    f"({_sql_transitions(OP, 'order_panel')})", "order_panel"))
def f16_percent_shares(spark, sf):
    """F16: transition shares as percent text with two decimals (display form)."""
    t = P.transition_table(S.order_panel(spark, sf), OP)
    return t.select("prev", "cur", F.format_string("%.2f%%", F.round("share", 6) * 100)
                    .alias("share_text"))


@query("w08_transition_table_with_nulls", with_ctes(_sql_transitions(OP, "snapshot"), "snapshot"))
def w08_transition_table_with_nulls(spark, sf):
    """W08 on the snapshot, whose large-order flag has NULL gaps (share over A08)."""
    t = P.transition_table(S.snapshot(spark, sf), OP)
    return t.select("prev", "cur", "n", r6("share").alias("share"))
