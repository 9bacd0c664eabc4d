"""Prediction-service monitoring as Structured Streaming (Q01-Q10).

The reference pushes counters, gauges and timers to a metrics daemon and
aggregates them in a dashboard. Here the same aggregations are streaming
queries over an event stream ``(ts, target, response_time, ...)``:

  Q01 positive predictions per target, 15-minute tumbling counts
  Q02 responses, 10-minute moving average (1-minute slide)
  Q03 response time, mean of the fastest 90% per interval
  Q04 request total (complete mode)
  Q05 gauge: last non-NULL value per series
  Q06 gauge mean per series and window
  Q07 sum over the range per target (from Q01's output)
  Q08 throttled gauge: a value when more than 10 seconds have passed since the last one sent
      (keyed state), and the last value of 10-second windows
  Q09 elapsed time since the first event of each series
  Q10 stream scoring: JSON requests in, recommendations out

Every windowed query carries a watermark (an argument, 1 hour by default) so its state is
bounded; late rows beyond it are dropped. Windows go to a keyed update sink, which also
holds those that the watermark has not closed yet. Sinks are Parquet folders with their checkpoint next to
them under the session's checkpoint folder, so a restarted query resumes.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WATERMARK = "1 hour"

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def event_stream(spark: SparkSession, folder: str, file_glob: str = "events.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet file stream of events as (ts TIMESTAMP, target, response_time, user_id).

    ``withWatermark`` needs TIMESTAMP (not NTZ); the session time zone is UTC.
    """
    r = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    ev = r.parquet(folder)
    return ev.select(F.col("ts").cast("timestamp").alias("ts"), "user_id",
                     F.col("event_type").alias("target"),
                     F.col("value").alias("response_time"))


def _bounds(df: DataFrame) -> DataFrame:
    return df.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("window.end").cast("timestamp_ntz").alias("window_end"),
                     *[c for c in df.columns if c != "window"])


def target_counts(events: DataFrame, every: str = "15 minutes", watermark: str = WATERMARK) -> DataFrame:
    """Q01: positive predictions per target per tumbling window."""
    g = (events.withWatermark("ts", watermark)
               .groupBy(F.window("ts", every), "target")
               .agg(F.count(F.lit(1)).alias("n")))
    return _bounds(g)


def minute_counts(events: DataFrame, slide: str = "1 minute", watermark: str = WATERMARK) -> DataFrame:
    """Q02, stream part: responses per slide."""
    return _bounds(events.withWatermark("ts", watermark).groupBy(F.window("ts", slide))
                   .agg(F.count(F.lit(1)).alias("n")))


def moving_average(counts: DataFrame, buckets: int = 10, slide: str = "1 minute") -> DataFrame:
    """Q02: per sliding window of ``buckets`` slides, count and count per slide (idle slides
    count as 0, as a moving average of a per-minute counter does). Slides are added up,
    not events: each slide's count enters ``buckets`` windows."""
    step = F.expr(f"INTERVAL {slide}")
    back = F.explode(F.array(*[F.lit(k) for k in range(buckets)]))
    start = F.col("window_start") - F.col("k") * step
    g = (counts.withColumn("k", back).select(start.alias("window_start"), "n")
         .groupBy("window_start").agg(F.sum("n").alias("n")))
    return g.select("window_start", (F.col("window_start") + F.lit(buckets) * step).alias("window_end"), "n",
                    (F.col("n") / F.lit(float(buckets))).alias("moving_avg"))


def value_counts(events: DataFrame, every: str = "1 minute", watermark: str = WATERMARK) -> DataFrame:
    """Q03, stream part: how often each response time occurs per interval."""
    return _bounds(events.withWatermark("ts", watermark).groupBy(F.window("ts", every), "response_time")
                   .agg(F.count(F.lit(1)).alias("n")))


def trimmed_mean_90(counts: DataFrame) -> DataFrame:
    """Q03: mean of the lowest 90% of response times per interval (at least one).

    Works on counts per distinct value with a running count, so no interval is ever
    collected into one row.
    """
    w = Window.partitionBy("window_start", "window_end")
    upto = F.sum("n").over(w.orderBy("response_time").rowsBetween(Window.unboundedPreceding, 0))
    c = counts.select("*", upto.alias("_hi"), F.sum("n").over(w).alias("_all"))
    k = F.greatest(F.lit(1), F.round(F.col("_all") * 0.9).cast("long"))
    used = F.greatest(F.lit(0), F.least(F.col("n"), k - (F.col("_hi") - F.col("n"))))
    return (c.select("window_start", "window_end", "response_time", "_all", used.alias("_used"))
            .groupBy("window_start", "window_end")
            .agg(F.max("_all").alias("n"),
                 (F.sum(F.col("response_time") * F.col("_used")) / F.sum("_used")).alias("mean_90")))


def request_total(events: DataFrame) -> DataFrame:
    """Q04: running request total (a global aggregate; complete / update mode)."""
    return events.agg(F.count(F.lit(1)).alias("requests"))


def last_value(events: DataFrame, series: str = "target", value: str = "response_time") -> DataFrame:
    """Q05: gauge reducer 'last non-NULL' per series."""
    return events.groupBy(series).agg(
        F.expr(f"max_by({value}, ts) FILTER (WHERE {value} IS NOT NULL)").alias("last_value"))


def gauge_mean(events: DataFrame, every: str = "10 minutes", series: str = "target",
               value: str = "response_time", watermark: str = WATERMARK) -> DataFrame:
    """Q06: gauge mean per series and window."""
    g = (events.withWatermark("ts", watermark)
               .groupBy(F.window("ts", every), series)
               .agg(F.avg(value).alias("mean_value")))
    return _bounds(g)


def range_totals(counts: DataFrame) -> DataFrame:
    """Q07: sum over the displayed range per target (of Q01's windows)."""
    return counts.groupBy("target").agg(F.sum("n").cast("long").alias("total"))


def throttled_gauge(events: DataFrame, every: str = "10 seconds", series: str = "target",
                    value: str = "response_time", watermark: str = WATERMARK) -> DataFrame:
    """Q08: at most one gauge value per series and 10-second window (the last)."""
    g = (events.withWatermark("ts", watermark)
               .groupBy(F.window("ts", every), series)
               .agg(F.max_by(value, "ts").alias("value")))
    return _bounds(g)


def since_last_send(events: DataFrame, seconds: float = 10.0, ttl_days: float | None = None, series: str = "target",
                    value: str = "response_time", watermark: str = WATERMARK) -> DataFrame:
    """Q08: (series, ts, value) of the events that are sent: the first of a series, and each one more
    than ``seconds`` after the one sent before it, as the service's throttle does.

    The time of the last send is keyed state (``transformWithState``), so it outlives batches and
    restarts. Within a batch a series' events are taken in time order; NULL values are not sent,
    and events older than the watermark are dropped. A task holds 16 bytes for each event that a
    series has in one batch, so bound batches by ``max_files_per_trigger``. The state is one
    number per series. With ``ttl_days`` (for streams that never end: the available-now trigger
    does not stop over processing time) that of a series without events goes after so many days.
    """
    from pyspark.sql.streaming import StatefulProcessor

    step, ttl = int(seconds * 1e6), None if ttl_days is None else int(ttl_days * 86_400_000)

    class Throttle(StatefulProcessor):
        def init(self, handle) -> None:
            self.last = handle.getValueState("last_send", T.StructType([T.StructField("micros", T.LongType())]), ttl)

        def handleInputRows(self, key, rows, timerValues):
            import numpy as np
            import pandas as pd

            parts = [(p["micros"].to_numpy(), p["value"].to_numpy()) for p in rows]
            at, values = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((values, at))
            at, values = at[order], values[order]
            k, sent = 0, []
            if self.last.exists():
                k = int(np.searchsorted(at, self.last.get()[0] + step, side="right"))
            while k < len(at):
                sent.append(k)
                k = int(np.searchsorted(at, at[k] + step, side="right"))
            if sent:
                self.last.update((int(at[sent[-1]]),))
                yield pd.DataFrame({series: key[0], "micros": at[sent], "value": values[sent]})

        def close(self) -> None:
            pass

    rows = (events.withWatermark("ts", watermark).where(F.col(value).isNotNull())
            .select(series, F.unix_micros("ts").alias("micros"), F.col(value).cast("double").alias("value")))
    sent = rows.groupBy(series).transformWithStateInPandas(
        Throttle(), f"{series} string, micros long, value double", "Append", "None" if ttl is None else "ProcessingTime")
    return sent.select(series, F.timestamp_micros("micros").cast("timestamp_ntz").alias("ts"), "value")


def elapsed(events: DataFrame, series: str = "target") -> DataFrame:
    """Q09: seconds from each series' first event to its latest."""
    g = events.groupBy(series).agg(F.min("ts").alias("_t0"), F.max("ts").alias("_t1"))
    micros = (F.unix_micros("_t1") - F.unix_micros("_t0")).cast("double")
    return g.select(series, (micros / F.lit(1e6)).alias("elapsed_seconds"))


def run_to_parquet(stream: DataFrame, out_dir: str, mode: str = "append",
                   available_now: bool = True, keyed_state: bool = False) -> str:
    """Run a streaming query to completion (available-now trigger) into a
    Parquet folder; the checkpoint sits next to it. Returns the data path.

    Append goes to the file sink. Complete mode overwrites the table. In update mode each
    batch holds the changed rows alone: it is written to a folder of its own (a batch run
    again overwrites just that), and ``latest`` reads the newest row of each key. ``keyed_state``
    runs the query with the RocksDB store that ``transformWithState`` needs.
    """
    data = os.path.join(out_dir, "data")
    ckpt = os.path.join(out_dir, "_checkpoint")
    w = stream.writeStream.option("checkpointLocation", ckpt).outputMode(mode)
    if mode == "append":
        w = w.format("parquet").option("path", data)
    else:
        def write(batch: DataFrame, epoch: int) -> None:
            to = data if mode == "complete" else os.path.join(data, f"batch={epoch}")
            batch.write.mode("overwrite").parquet(to)
        w = w.foreachBatch(write)
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    usual = conf.get(name)
    if keyed_state:
        conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = (w.trigger(availableNow=True) if available_now else w).start()
        q.awaitTermination()
    finally:
        conf.set(name, usual)
    return data


def latest(spark: SparkSession, data: str, keys: list[str]) -> DataFrame:
    """The table of an update-mode query: the row of the last batch for each key."""
    rows = spark.read.parquet(data)
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row"))
    return newest.select(*keys, "_row.*")
