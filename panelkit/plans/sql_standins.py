"""DuckDB twins of ``panelkit.sources.standins`` for the oracle SQL.

``with_ctes(body, "snapshot", ...)`` prefixes a query with the CTEs it needs
(dependencies first). Expressions mirror the Spark definitions one for one.
"""

from __future__ import annotations

from ..sources.standins import (EVENT_TYPES, LARGE_ORDER_PRICE, SEGMENT_OF_MARKET)


def _event_panel() -> str:
    flags = ",\n    ".join(
        f"max(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS ind_{t}" for t in EVENT_TYPES)
    return f"""event_panel AS (
  SELECT user_id AS id, CAST(ts AS DATE) AS fetch_date,
    {flags}
  FROM events GROUP BY 1, 2)"""


def _order_panel() -> str:
    return f"""order_panel AS (
  SELECT o_custkey AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS fetch_date,
    max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS ind_1m_urgent,
    max(CASE WHEN o_totalprice > {LARGE_ORDER_PRICE} THEN 1 ELSE 0 END) AS ind_1m_large,
    max(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS ind_1m_high,
    max(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS ind_1m_low,
    max(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS ind_1m_open
  FROM orders GROUP BY 1, 2)"""


def _snapshot() -> str:
    seg = " ".join(f"WHEN '{m}' THEN '{s}'" for m, s in SEGMENT_OF_MARKET)
    return f"""snapshot_base AS (
  SELECT op.*, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name, n.n_regionkey,
    CAST(min(op.fetch_date) OVER (PARTITION BY op.id)
         - to_months(CAST(op.id % 24 AS INTEGER)) AS DATE) AS registration_date
  FROM order_panel op JOIN customer c ON op.id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey),
snapshot_m AS (
  SELECT *, (year(fetch_date) - year(registration_date)) * 12
            + (month(fetch_date) - month(registration_date)) AS _months
  FROM snapshot_base),
snapshot AS (
  SELECT fetch_date, id,
    CASE id % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'F' WHEN 3 THEN 'N' ELSE 'P' END
      AS ind_employee,
    'ES' AS country_of_residence,
    CASE id % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'V' END AS gender,
    CASE WHEN id % 13 = 0 THEN ' NA' ELSE lpad(CAST(18 + id % 70 AS VARCHAR), 3, ' ') END AS age,
    registration_date,
    CASE WHEN _months < 6 THEN 1.0 ELSE 0.0 END::DOUBLE AS ind_new_client,
    lpad(CAST(_months AS VARCHAR), 7, ' ') AS tenure_months,
    CASE WHEN id % 17 = 0 THEN 99.0 ELSE 1.0 END::DOUBLE AS client_relationship_status,
    CASE WHEN id % 31 = 0 THEN fetch_date END AS last_date_as_primary,
    CASE id % 7 WHEN 0 THEN '1' WHEN 1 THEN '1.0' WHEN 2 THEN 'P' WHEN 3 THEN '2'
      WHEN 4 THEN '3' WHEN 5 THEN '4' END AS client_type_1m,
    CASE id % 9 WHEN 0 THEN 'I' WHEN 1 THEN 'P' WHEN 2 THEN 'R' WHEN 3 THEN NULL ELSE 'A' END
      AS client_activity_1m,
    'S' AS ind_resident,
    CASE WHEN n_regionkey = 3 THEN 'N' ELSE 'S' END AS ind_foreigner,
    CASE WHEN id % 97 = 0 THEN 'S' END AS ind_spouse_employee,
    CASE WHEN id % 43 = 0 THEN NULL
      ELSE concat('K', substring(c_mktsegment, 1, 2), CAST(c_nationkey % 4 AS VARCHAR)) END
      AS entry_channel,
    CASE WHEN id % 101 = 0 THEN 'S' ELSE 'N' END AS ind_deceased,
    1.0::DOUBLE AS address_type,
    CASE WHEN id % 19 = 0 THEN NULL ELSE CAST(c_nationkey AS DOUBLE) END AS province_code,
    n_name AS province_name,
    CAST(id % 2 AS DOUBLE) AS ind_client_activity,
    CASE WHEN id % 23 = 0 THEN NULL ELSE c_acctbal * 100.0 END::DOUBLE AS income,
    CASE c_mktsegment {seg} END AS client_segment,
    ind_1m_urgent,
    CASE WHEN (id + month(fetch_date)) % 29 = 0 THEN NULL ELSE ind_1m_large END AS ind_1m_large,
    ind_1m_high, ind_1m_low, ind_1m_open
  FROM snapshot_m)"""


def _nullable() -> str:
    return """nullable AS (
  SELECT l_orderkey,
    CASE WHEN NOT (l_orderkey % 97 = 0) THEN l_partkey END AS l_partkey,
    CASE WHEN NOT (l_orderkey % 97 = 0) THEN l_suppkey END AS l_suppkey,
    CASE WHEN NOT (l_orderkey % 97 = 0 AND l_linenumber % 2 = 0) THEN l_linenumber END
      AS l_linenumber,
    CASE WHEN NOT (l_orderkey % 97 = 0 OR l_suppkey % 11 = 0) THEN l_quantity END AS l_quantity,
    CASE WHEN NOT (l_orderkey % 97 = 0) THEN l_extendedprice END AS l_extendedprice,
    CASE WHEN NOT (l_orderkey % 97 = 0 OR l_partkey % 5 = 0) THEN l_discount END AS l_discount,
    CASE WHEN NOT (l_orderkey % 97 = 0 OR l_linenumber % 3 = 0) THEN l_tax END AS l_tax,
    CASE WHEN NOT (l_orderkey % 97 = 0 OR l_orderkey % 7 = 0) THEN l_returnflag END
      AS l_returnflag,
    CASE WHEN NOT (l_orderkey % 97 = 0) THEN l_linestatus END AS l_linestatus,
    CASE WHEN NOT (l_orderkey % 97 = 0) THEN l_shipdate END AS l_shipdate,
    CASE WHEN NOT (l_orderkey % 97 = 0) THEN CAST(date_trunc('month', l_shipdate) AS DATE) END
      AS fetch_date
  FROM lineitem)"""


def _scored() -> str:
    return """scored_wide AS (
  SELECT l.doc_id AS row_id, l.quality, l.toxic,
    least(1.0, CAST(d.n_chars AS DOUBLE) / 20000.0) AS proba_quality,
    1.0 / (1.0 + CAST(d.n_chars AS DOUBLE) / 1000.0) AS proba_toxic
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
scored AS (
  SELECT row_id, 'quality' AS target, quality AS y, proba_quality AS proba,
         CAST(proba_quality >= 0.5 AS INTEGER) AS yhat FROM scored_wide
  UNION ALL
  SELECT row_id, 'toxic' AS target, toxic AS y, proba_toxic AS proba,
         CAST(proba_toxic >= 0.5 AS INTEGER) AS yhat FROM scored_wide)"""


def _metric_events() -> str:
    return """metric_events AS (
  SELECT ts, user_id, event_type AS target, value AS response_time FROM events)"""


def _scored_panel() -> str:
    from ..sources.standins import EVENT_PRODUCTS, EVENT_SPLIT_DATE, SCORED_PANEL_THRESHOLD
    tgt = ", ".join(
        f"coalesce(CAST(({p} = 0 AND lead({p}) OVER w = 1) AS INTEGER), 0) AS target__{p}"
        for p in EVENT_PRODUCTS)
    long = " UNION ALL ".join(
        f"SELECT id, fetch_date, '{p}' AS target, {p} AS state, target__{p} AS y FROM ep_labels"
        for p in EVENT_PRODUCTS)
    return f"""ep_labels AS (
  SELECT * FROM (SELECT *, {tgt}, lead(id) OVER w AS _nid FROM event_panel
    WINDOW w AS (PARTITION BY id ORDER BY fetch_date)) WHERE _nid IS NOT NULL),
ep_long AS ({long}),
ep_rates AS (SELECT target, state, avg(y) AS proba FROM ep_long
  WHERE fetch_date <= DATE '{EVENT_SPLIT_DATE}' GROUP BY target, state),
scored_panel AS (
  SELECT l.id, l.fetch_date, l.target, l.y, r.proba, CAST(r.proba >= {SCORED_PANEL_THRESHOLD} AS INTEGER) AS yhat
  FROM ep_long l JOIN ep_rates r ON l.target = r.target AND l.state = r.state
  WHERE l.fetch_date > DATE '{EVENT_SPLIT_DATE}')"""


def _wide_panel() -> str:
    from ..sources.standins import WIDE_CONDITIONS, wide_null_rule, wide_products
    products = wide_products()
    flags = ", ".join(f"max(CASE WHEN {c} THEN 1 ELSE 0 END) AS {p}" for p, c in zip(products, WIDE_CONDITIONS))
    rules = [(p, wide_null_rule(i)) for i, p in enumerate(products)]
    out = ", ".join(p if r is None else f"CASE WHEN NOT ({r}) THEN {p} END AS {p}" for p, r in rules)
    return f"""wide_flags AS (
  SELECT o_custkey AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS fetch_date, {flags} FROM orders GROUP BY 1, 2),
wide_panel AS (SELECT id, fetch_date, {out} FROM wide_flags)"""


def _wide_snapshot() -> str:
    from ..schema import PRODUCT_PREFIX, column_names
    columns = ", ".join(("w." if c.startswith(PRODUCT_PREFIX) else "s.") + c for c in column_names())
    return f"""wide_snapshot AS (
  SELECT {columns} FROM snapshot s JOIN wide_panel w ON s.id = w.id AND s.fetch_date = w.fetch_date)"""


_DEFS = {
    "wide_panel": ([], _wide_panel),
    "wide_snapshot": (["snapshot", "wide_panel"], _wide_snapshot),
    "scored_panel": (["event_panel"], _scored_panel),
    "event_panel": ([], _event_panel),
    "order_panel": ([], _order_panel),
    "snapshot": (["order_panel"], _snapshot),
    "nullable": ([], _nullable),
    "scored": ([], _scored),
    "metric_events": ([], _metric_events),
}


def with_ctes(body: str, *names: str, extra: list[str] | None = None) -> str:
    """``WITH <needed stand-ins>, <extra CTEs> <body>``."""
    order: list[str] = []

    def visit(n: str):
        deps, _ = _DEFS[n]
        for d in deps:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [_DEFS[n][1]() for n in order] + list(extra or [])
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
