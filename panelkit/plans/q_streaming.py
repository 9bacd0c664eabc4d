"""Streaming monitor queries Q01-Q10.

Each query runs a real Structured Streaming job over the events file (file
source, available-now trigger) into a Parquet sink under the session's
checkpoint folder and returns the written table. Windows go through the keyed update sink, so the table holds
all of them up to the last event.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources import standins as S
from ..streaming import monitor as Q
from .catalog import query, r6

WINDOW = ["window_start", "window_end"]


def _run(spark, sf, build, keys=None, name="stream"):
    """The table of a streaming query: keyed updates, or complete mode without keys."""
    out = scratch_dir(spark, name)
    data = Q.run_to_parquet(build(Q.event_stream(spark, sf)), out, "update" if keys else "complete")
    return Q.latest(spark, data, keys) if keys else spark.read.parquet(data)


def _tumbling_sql(minutes, value_sql, group="", where="TRUE"):
    g = f", {group}" if group else ""
    return f"""SELECT * FROM (
      SELECT time_bucket(INTERVAL '{minutes} minutes', ts) AS window_start,
             time_bucket(INTERVAL '{minutes} minutes', ts) + INTERVAL '{minutes} minutes' AS window_end
             {g}, {value_sql}
      FROM (SELECT ts, event_type AS target, value AS response_time FROM events WHERE {where})
      GROUP BY 1, 2{g})"""


@query("q01_target_counts_15min", _tumbling_sql(15, "count(*) AS n", "target"))
def q01_target_counts_15min(spark, sf):
    """Q01: positive predictions per target, 15-minute tumbling windows."""
    return _run(spark, sf, Q.target_counts, [*WINDOW, "target"], name="q01")


@query("q02_moving_average_10min", f"""SELECT window_start, window_end, n, round(n / 10.0, 6) AS moving_avg
    FROM (SELECT s AS window_start, s + INTERVAL 10 MINUTE AS window_end, count(*) AS n FROM (
      SELECT time_bucket(INTERVAL '1 minute', ts) - k * INTERVAL 1 MINUTE AS s
      FROM events, range(0, 10) r(k)) GROUP BY s)""")
def q02_moving_average_10min(spark, sf):
    """Q02: responses, 10-minute moving average with a 1-minute slide."""
    d = Q.moving_average(_run(spark, sf, Q.minute_counts, WINDOW, name="q02"))
    return d.select("window_start", "window_end", "n", r6("moving_avg").alias("moving_avg"))


@query("q03_response_time_mean_90", f"""SELECT window_start, window_end, n,
      round(list_sum(list_slice(v, 1, greatest(1, CAST(round(n * 0.9) AS INTEGER))))
        / greatest(1, CAST(round(n * 0.9) AS INTEGER)), 6) AS mean_90
    FROM (SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start,
            time_bucket(INTERVAL '1 minute', ts) + INTERVAL 1 MINUTE AS window_end,
            count(*) AS n, list_sort(list(value)) AS v
          FROM events GROUP BY 1, 2)""")
def q03_response_time_mean_90(spark, sf):
    """Q03: mean of the fastest 90% of response times per minute."""
    d = Q.trimmed_mean_90(_run(spark, sf, Q.value_counts, [*WINDOW, "response_time"], name="q03"))
    return d.select("window_start", "window_end", F.col("n").cast("long").alias("n"),
                    r6("mean_90").alias("mean_90"))


@query("q04_request_total", "SELECT count(*) AS requests FROM events")
def q04_request_total(spark, sf):
    """Q04: request total over the whole range (complete mode)."""
    return _run(spark, sf, Q.request_total, name="q04")


@query("q05_gauge_last_value",
       "SELECT event_type AS target, arg_max(value, ts) FILTER (WHERE value IS NOT NULL) "
       "AS last_value FROM events GROUP BY event_type")
def q05_gauge_last_value(spark, sf):
    """Q05: last non-NULL gauge value per series (complete mode)."""
    return _run(spark, sf, Q.last_value, name="q05")


@query("q06_gauge_mean_10min", f"""SELECT window_start, window_end, target, round(mean_value, 6) AS mean_value
    FROM ({_tumbling_sql(10, 'avg(response_time) AS mean_value', 'target')})""")
def q06_gauge_mean_10min(spark, sf):
    """Q06: gauge mean per series and 10-minute window."""
    d = _run(spark, sf, Q.gauge_mean, [*WINDOW, "target"], name="q06")
    return d.select("window_start", "window_end", "target", r6("mean_value").alias("mean_value"))


@query("q07_range_totals", f"""SELECT target, CAST(sum(n) AS BIGINT) AS total FROM (
    {_tumbling_sql(15, 'count(*) AS n', 'target')}) GROUP BY target""")
def q07_range_totals(spark, sf):
    """Q07: per-target sum over the range of Q01's windows."""
    return Q.range_totals(q01_target_counts_15min(spark, sf))


@query("q08_throttled_gauge_10s", f"""SELECT * FROM (
    SELECT time_bucket(INTERVAL '10 seconds', ts) AS window_start,
           time_bucket(INTERVAL '10 seconds', ts) + INTERVAL 10 SECOND AS window_end,
           event_type AS target, arg_max(value, ts) AS value
    FROM events GROUP BY 1, 2, 3)""")
def q08_throttled_gauge_10s(spark, sf):
    """Q08: one gauge value (the last) per series and 10 seconds."""
    return _run(spark, sf, Q.throttled_gauge, [*WINDOW, "target"], name="q08")


def _throttle_sql(seconds):
    return f"""WITH RECURSIVE e AS (
      SELECT event_type AS target, ts, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, value) AS k
      FROM events WHERE value IS NOT NULL),
    r AS (
      SELECT target, k, ts, value, ts AS last_send, true AS sent FROM e WHERE k = 1
      UNION ALL
      SELECT e.target, e.k, e.ts, e.value,
        CASE WHEN e.ts > r.last_send + INTERVAL {seconds} SECOND THEN e.ts ELSE r.last_send END,
        e.ts > r.last_send + INTERVAL {seconds} SECOND
      FROM r JOIN e ON e.target = r.target AND e.k = r.k + 1)
    SELECT target, ts, value FROM r WHERE sent"""


@query("q08_gauge_since_last_send", _throttle_sql(10))
def q08_gauge_since_last_send(spark, sf):
    """Q08: a gauge value when more than 10 seconds have passed since the last send (keyed state)."""
    out = scratch_dir(spark, "q08-state")
    return spark.read.parquet(Q.run_to_parquet(Q.since_last_send(Q.event_stream(spark, sf)), out, keyed_state=True))


@query("q08_gauge_since_last_send_1h", _throttle_sql(3600))
def q08_gauge_since_last_send_1h(spark, sf):
    """Q08 with an hour between sends."""
    out = scratch_dir(spark, "q08-state")
    return spark.read.parquet(Q.run_to_parquet(Q.since_last_send(Q.event_stream(spark, sf), 3600), out, keyed_state=True))


@query("q09_elapsed_seconds",
       "SELECT event_type AS target, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) "
       "AS elapsed_seconds FROM events GROUP BY event_type")
def q09_elapsed_seconds(spark, sf):
    """Q09: seconds from each series' first to latest event (complete mode)."""
    d = _run(spark, sf, Q.elapsed, name="q09")
    return d.select("target", r6("elapsed_seconds").alias("elapsed_seconds"))


@query("q10_stream_scoring")
def q10_stream_scoring(spark, sf):
    """Q10: JSON requests arrive as files; each micro-batch is parsed, scored by
    every label model and ranked (stateless), into a Parquet sink."""
    from pyspark.sql import types as T

    from ..functions.rows import json_to_rows
    from ..operators import panel as P
    from ..operators.model import recommend
    from .q_model import fitted_model

    model = fitted_model(spark, sf)
    snap = S.snapshot(spark, sf)
    _, test = P.split_by_date(snap, S.ORDER_SPLIT_DATE)
    inbox = os.path.join(scratch_dir(spark, "q10"), "inbox")
    S.requests_from(test).write.mode("overwrite").text(inbox)
    stream = spark.readStream.schema(T.StructType([T.StructField("value", T.StringType())])) \
        .text(inbox)
    from .q_model import labelled_split
    train, _ = labelled_split(spark, sf)
    income_mean = float(train.agg(F.avg("income")).first()[0])
    rows = json_to_rows(stream, snap.schema).withColumn(
        "income", F.coalesce("income", F.lit(income_mean)))  # F13
    recs = recommend(model, rows, ["id", "fetch_date"], 0.01, 4)
    out = scratch_dir(spark, "q10")
    data = Q.run_to_parquet(recs, out, "append")
    return spark.read.parquet(data)
