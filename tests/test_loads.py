"""Batch-by-batch loads, rejects, the key check and sketches on hand rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators import bitmask, panel, sketches
from panelkit.session import scratch_dir
from panelkit.sources import increments, quarantine

PRODUCTS = ["ind_1m_a", "ind_1m_b"]
SCHEMA = "id long, fetch_date date, ind_1m_a int, ind_1m_b int"


def months(n=17):
    """Clients that come, pause, leave and return over 17 months; some flags NULL."""
    rows = []
    for m in range(n):
        day = dt.date(2015 + m // 12, m % 12 + 1, 28)
        for c in range(12):
            if (c * 7 + m * 3) % 5 and not (c == 4 and m > 6):
                rows.append((c, day, (c + m) % 2, None if (c + m) % 7 == 0 else (c * m) % 3 % 2))
    return rows


def test_loads_one_by_one_equal_a_full_run(spark):
    rows = months()
    df = spark.createDataFrame(rows, SCHEMA)
    folder = scratch_dir(spark, "test-loads")
    want = sorted(map(str, bitmask.build_labels(df, PRODUCTS, inactive=False).collect()))
    days = sorted({r[1] for r in rows})
    for day in days:
        increments.load_batch(df.where(F.col("fetch_date") == day), folder, str(day), PRODUCTS)
    assert increments.committed(spark, folder) == [str(d) for d in days]
    assert sorted(map(str, increments.labels(spark, folder, PRODUCTS).collect())) == want
    # the last load again changes nothing; the panel has its rows once
    increments.load_batch(df.where(F.col("fetch_date") == days[-1]), folder, str(days[-1]), PRODUCTS)
    assert sorted(map(str, increments.labels(spark, folder, PRODUCTS).collect())) == want
    assert spark.read.parquet(folder + "/panel").count() == len(rows)
    last = spark.read.parquet(f"{folder}/last/load={days[-1]}")
    assert {r.id: r.fetch_date for r in last.collect()} == {c: max(d for i, d, *_ in rows if i == c) for c in {r[0] for r in rows}}
    with pytest.raises(ValueError, match="comes before"):
        increments.load_batch(df.where(F.col("fetch_date") == days[0]), folder, str(days[0]), PRODUCTS)
    with pytest.raises(ValueError, match="already there"):
        increments.load_batch(df.where(F.col("fetch_date") == days[0]), folder, "2999-01-01", PRODUCTS)


def test_empty_load_keeps_the_state(spark):
    df = spark.createDataFrame(months(2), SCHEMA)
    folder = scratch_dir(spark, "test-loads")
    increments.load_batch(df.where("month(fetch_date) = 1"), folder, "a", PRODUCTS)
    increments.load_batch(df.where("false"), folder, "b", PRODUCTS)
    increments.load_batch(df.where("month(fetch_date) = 2"), folder, "c", PRODUCTS)
    want = sorted(map(str, bitmask.build_labels(df, PRODUCTS, inactive=False).collect()))
    assert sorted(map(str, increments.labels(spark, folder, PRODUCTS).collect())) == want


def test_repeated_keys_stop_the_load(spark):
    day = dt.date(2015, 1, 28)
    df = spark.createDataFrame([(1, day, 0, 1), (1, day, 1, 1), (2, day, 0, 0), (None, day, 0, 0)], SCHEMA)
    assert [(r.id, r.n) for r in panel.duplicate_keys(df).collect()] == [(1, 2)]
    folder = scratch_dir(spark, "test-loads")
    with pytest.raises(ValueError, match="repeated keys"):
        increments.load_batch(df, folder, "a", PRODUCTS)
    assert increments.committed(spark, folder) == []
    panel.check_keys(df.where("id = 2 or id is null"))
    panel.check_keys(df.where("false"))


TYPED = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType()),
                      T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType())])


def test_csv_records_are_kept_or_rejected(spark):
    lines = ["1,2020-01-05, padded,1.5", "2,soon,a,1", "3,2020-01-05,b,one", "four,soon,b,2", "5,2020-01-05,c,1,extra",
             "6,2020-01-05", "7,,,", '8,2020-01-05,"quoted, comma",2']
    path = scratch_dir(spark, "test-csv")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows, rejects = quarantine.read_csv_split(spark, path, TYPED, header=False)
    assert sorted((r.id, r.name, r.x) for r in rows.collect()) == [
        (1, " padded", 1.5), (7, None, None), (8, "quoted, comma", 2.0)]
    got = {r.record: r.reason for r in rejects.collect()}
    assert got == {lines[1]: "day", lines[2]: "x", lines[3]: "id", lines[4]: "fields", lines[5]: "fields"}
    assert rejects.where("file like '%test-csv%'").count() == 5
    assert (rows.count(), rejects.count()) == (3, 5)
    # only one column of the rows: the same records are good
    assert sorted(r.id for r in rows.select("id").collect()) == [1, 7, 8]


def test_json_requests_are_kept_or_rejected(spark):
    sent = [('{"id": 1, "day": "05-01-2020", "name": "a", "x": 1.5}',), ('{"id": 2, "day": "31-31-2020"}',), ("{broken",), (None,),
            ('{"id": "z", "x": "one"}',), ("{}",), ('{"id": 3, "other": 1}',)]
    rows, rejects = quarantine.json_split(spark.createDataFrame(sent, "value string"), TYPED)
    assert sorted(map(str, rows.collect())) == sorted(map(str, [
        T.Row(id=1, day=dt.date(2020, 1, 5), name="a", x=1.5), T.Row(id=None, day=None, name=None, x=None),
        T.Row(id=3, day=None, name=None, x=None)]))
    assert sorted(map(str, ((r.value, r.reason) for r in rejects.collect()))) == sorted(map(str, [
        (sent[1][0], "day"), ("{broken", "json"), (None, "json"), (sent[4][0], "id")]))


def test_sketches_merge_over_periods(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 6).alias("fetch_date"), (F.col("id") % 9000).alias("k"), F.when(F.col("id") % 4 > 0, F.col("id") / 3).alias("v"),
        F.when(F.col("id") % 5 == 0, float("nan")).otherwise(1.0).alias("n"), F.lit(None).cast("string").alias("none"),
        F.concat(F.lit("s"), F.col("id") % 7).alias("s"))
    table = sketches.period_sketches(df, ["k", "v", "n", "none", "s"])
    assert table.count() == 30
    whole = {r["column"]: r for r in sketches.read_sketches(sketches.merge_sketches(table)).collect()}
    assert [whole[c].n_rows for c in ("k", "v", "n", "none", "s")] == [60_000] * 5
    assert (whole["v"].n_null, whole["n"].n_null, whole["none"].n_null, whole["s"].n_null) == (15_000, 12_000, 60_000, 0)
    assert abs(whole["k"].approx_distinct - 9000) < 0.05 * 9000 and whole["s"].approx_distinct == 7 and whole["none"].approx_distinct == 0
    assert abs(whole["v"].q50 - 10_000) < 0.02 * 20_000 and whole["n"].q50 == 1.0 and whole["s"].q50 is None and whole["none"].q50 is None
    # two periods alone, from the same table
    part = {r["column"]: r for r in sketches.read_sketches(sketches.merge_sketches(table.where("period in (0, 3)"))).collect()}
    exact = df.where("fetch_date in (0, 3)").agg(F.count_distinct("k").alias("k"), F.median("v").alias("v")).first()
    assert abs(part["k"].approx_distinct - exact.k) <= 0.05 * exact.k and abs(part["v"].q50 - exact.v) < 400
    assert sketches.period_sketches(df.where("false"), ["k", "v"]).count() == 0
