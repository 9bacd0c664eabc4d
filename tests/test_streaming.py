"""Streaming = batch for the monitor aggregations, up to the last event."""

from pyspark.sql import functions as F

from panelkit.session import scratch_dir
from panelkit.sources import standins as S
from panelkit.streaming import monitor as Q


def run(spark, sf, build, keys, name):
    data = Q.run_to_parquet(build(Q.event_stream(spark, sf)), scratch_dir(spark, name), "update")
    return Q.latest(spark, data, keys)


def test_stream_counts_equal_batch(spark, sf_small):
    got = run(spark, sf_small, Q.target_counts, ["window_start", "window_end", "target"], "t-stream")
    ev = S.metric_events(spark, sf_small)
    batch = (ev.groupBy(F.window("ts", "15 minutes"), "target").agg(F.count(F.lit(1)).alias("n"))
               .select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "target", "n"))
    a = sorted(got.select("window_start", "target", "n").collect())
    b = sorted(batch.collect())
    assert a == b and len(a) > 0


def test_trimmed_mean_of_the_lowest_values(spark, sf_small):
    counts = spark.createDataFrame([("a", "b", 1.0, 8), ("a", "b", 5.0, 1), ("a", "b", 100.0, 1), ("c", "d", 7.0, 1)],
                                   "window_start string, window_end string, response_time double, n long")
    got = {r.window_start: (r.n, r.mean_90) for r in Q.trimmed_mean_90(counts).collect()}
    assert got == {"a": (10, 13 / 9), "c": (1, 7.0)}
    rows = Q.trimmed_mean_90(run(spark, sf_small, Q.value_counts, ["window_start", "window_end", "response_time"], "t-mean90")).collect()
    assert rows and all(r.mean_90 is not None for r in rows)


def test_update_sink_keeps_the_newest_row_of_each_key(spark, tmp_path):
    spark.createDataFrame([(1, 10), (2, 20)], "k int, v int").write.parquet(str(tmp_path / "batch=0"))
    spark.createDataFrame([(2, 21), (3, 30)], "k int, v int").write.parquet(str(tmp_path / "batch=1"))
    assert sorted(map(tuple, Q.latest(spark, str(tmp_path), ["k"]).collect())) == [(1, 10), (2, 21), (3, 30)]


def sent(events, seconds):
    """The throttle of the service, event by event."""
    last, out = {}, []
    for target, ts, value in sorted(e for e in events if e[2] is not None):
        if target not in last or (ts - last[target]).total_seconds() > seconds:
            last[target] = ts
            out.append((target, ts, value))
    return out


def test_gauge_keeps_its_last_send_over_restarts(spark, tmp_path):
    from datetime import datetime, timedelta
    start = datetime(2024, 1, 1)
    events = [(("a", "b")[k % 2], start + timedelta(seconds=3.5 * k), None if k % 11 == 0 else float(k)) for k in range(60)]
    events += [("a", start + timedelta(seconds=300), 1.0), ("a", start + timedelta(seconds=310), 2.0), ("a", start + timedelta(seconds=310.5), 3.0)]
    schema, out = Q.EVENT_SCHEMA, str(tmp_path / "out")
    for part in range(3):  # a new query for each file, with the state of the one before
        rows = [(k, ts, 1, target, value, None) for k, (target, ts, value) in enumerate(events) if k // 21 == part]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = Q.since_last_send(Q.event_stream(spark, str(tmp_path / "in"), "*.parquet"), 10)
        data = Q.run_to_parquet(stream, out, keyed_state=True)
    got = sorted((r.target, r.ts, r.value) for r in spark.read.parquet(data).collect())
    assert got == sent(events, 10) and 5 < len(got) < 40
