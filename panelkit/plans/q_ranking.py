"""Sort / limit / top-k / sampling queries R01-R09."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import panel as P
from ..operators import profile as A
from ..operators import ranking as R
from ..operators.running import md5_sql
from ..sources import standins as S
from .catalog import query, r6
from .sql_standins import with_ctes

EP = S.EVENT_PRODUCTS


@query("r01_sort_by_value", with_ctes(
    "SELECT entry_channel, count(*) AS n FROM snapshot WHERE entry_channel IS NOT NULL "
    "GROUP BY entry_channel", "snapshot"))
def r01_sort_by_value(spark, sf):
    """Category sizes sorted descending (a global sort)."""
    return A.category_sizes(S.snapshot(spark, sf), "entry_channel").orderBy(
        F.desc("n"), "entry_channel")


@query("r02_head", with_ctes(
    "SELECT * FROM event_panel ORDER BY id, fetch_date LIMIT 10", "event_panel"))
def r02_head(spark, sf):
    """First 10 rows by an explicit key order."""
    return R.head(S.event_panel(spark, sf), ["id", "fetch_date"], 10)


@query("r03_top_k_per_row", with_ctes(
    """SELECT id, fetch_date, target, round(proba, 6) AS proba, rank FROM (
         SELECT *, row_number() OVER (PARTITION BY id, fetch_date
           ORDER BY proba DESC, target) AS rank FROM scored_panel) WHERE rank <= 3""",
    "scored_panel"))
def r03_top_k_per_row(spark, sf):
    """Top-3 products per client-period by score (ties by name)."""
    t = R.top_k_per_row(S.scored_panel(spark, sf), ["id", "fetch_date"], 3)
    return t.select("id", "fetch_date", "target", r6("proba").alias("proba"), "rank")


@query("r04_ranked_recommendations", with_ctes(
    """SELECT id, fetch_date, target, round(proba, 4) AS proba,
         row_number() OVER (PARTITION BY id, fetch_date ORDER BY proba DESC, target) AS rank
       FROM scored_panel WHERE proba >= 0.01""", "scored_panel"))
def r04_ranked_recommendations(spark, sf):
    """Recommendations above 0.01, rounded to 4 places, ranked."""
    return R.recommendations(S.scored_panel(spark, sf), ["id", "fetch_date"], 0.01, 4)


SAMPLE_N = 1000


@query("r06_seeded_sample", with_ctes(
    f"SELECT * FROM snapshot ORDER BY {md5_sql(['id', 'fetch_date'], 42)} LIMIT {SAMPLE_N}",
    "snapshot"))
def r06_seeded_sample(spark, sf):
    """Fixed-size seeded sample (md5 order, distributed rank)."""
    return A.hash_sample(S.snapshot(spark, sf), SAMPLE_N, ["id", "fetch_date"], 42)


@query("r07_downsample_inactive", with_ctes(
    f"""SELECT * EXCLUDE (_held) FROM (
          SELECT *, max(coalesce(ind_1m_large, 0)) OVER (PARTITION BY id) AS _held
          FROM order_panel) WHERE _held > 0 OR substring({md5_sql(['id'], 42)}, 1, 8)
        >= '{P.hex_threshold(0.8)}'""", "order_panel"))
def r07_downsample_inactive(spark, sf):
    """Keep clients holding the product, and a seeded 20% of the others."""
    return P.downsample_inactive(S.order_panel(spark, sf), ["ind_1m_large"], 0.2, 42)


@query("r08_random_positives", with_ctes(
    f"""SELECT row_id, target, CAST(rn <= k AS INTEGER) AS yhat FROM (
          SELECT s.row_id, s.target, row_number() OVER (PARTITION BY s.target
            ORDER BY {md5_sql(['s.row_id', 's.target'], 42)}) AS rn, k.k
          FROM scored s JOIN (SELECT target, floor(avg(y) * count(*)) AS k FROM scored
            GROUP BY target) k ON s.target = k.target)""", "scored"))
def r08_random_positives(spark, sf):
    """Per label, floor(rate * n) seeded-random rows set to 1."""
    s = S.scored(spark, sf).select("row_id", "target", "y")
    rates = s.groupBy("target").agg(F.avg("y").alias("rate"))
    return R.random_positives(s.drop("y"), rates, ["row_id"], 42).select("row_id", "target", "yhat")


@query("r09_append_total", with_ctes(
    """SELECT CAST(fetch_date AS VARCHAR) AS fetch_date, CAST(sum(ind_purchase) AS BIGINT) AS total
       FROM event_panel GROUP BY fetch_date
       UNION ALL SELECT 'Total', CAST(sum(ind_purchase) AS BIGINT) FROM event_panel""",
    "event_panel"))
def r09_append_total(spark, sf):
    """Per-period totals with an appended Total row."""
    t = (S.event_panel(spark, sf).groupBy("fetch_date")
          .agg(F.sum("ind_purchase").cast("long").alias("total")))
    return A.append_total(t, "fetch_date", ["total"])
