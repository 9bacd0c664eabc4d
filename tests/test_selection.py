"""Radix selection against sorting."""

import contextlib
import hashlib
import io
import math
import random

import numpy as np
from pyspark.sql import functions as F

from panelkit.operators import profile as A
from panelkit.operators import running
from panelkit.operators import selection as Sel
from panelkit.operators.ranking import random_positives


def odd_doubles():
    own = random.Random(7)
    some = [own.gauss(0, 1) for _ in range(300)] + [1e308, -1e308, 5e-324, 0.0, 1e-300, 2.0 ** -1000] + [3.25] * 400
    return some + [own.expovariate(1e-9) for _ in range(200)] + [10.0 ** own.randint(-300, 300) for _ in range(60)]


def test_doubles_of_any_size(spark):
    values = odd_doubles()
    rows = spark.createDataFrame([(v,) for v in values + [None, float("nan")]], "v double").repartition(5)
    ordered = sorted(values)
    found = Sel.ranked_values(rows, F.col("v"), lambda _, n: range(0, n, 37))[()]
    assert {k: f.value for k, f in found.items()} == {k: ordered[k] for k in range(0, len(values), 37)}
    for k, f in found.items():
        assert f.below == sum(v < f.value for v in values) and f.equal == values.count(f.value)


def test_longs_by_key_and_null_keys(spark):
    own = random.Random(8)
    data = [(own.choice(["a", "b", None]), own.choice([own.randrange(2 ** 60), 5, 2 ** 59])) for _ in range(900)]
    rows = spark.createDataFrame(data, "k string, v long").repartition(4)
    found = Sel.ranked_values(rows, F.col("v"), lambda key, n: [0, n // 2, n - 1, n + 5], ["k"])
    for key in ("a", "b", None):
        own_values = sorted(v for k, v in data if k == key)
        assert {k: f.value for k, f in found[(key,)].items()} == {k: own_values[k] for k in (0, len(own_values) // 2, len(own_values) - 1)}


def test_quantiles(spark):
    values = [v for v in odd_doubles() if abs(v) < 1e100]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.p: r.q for r in running.exact_quantiles(rows, "v", probs).collect()}
    for p in probs:
        assert math.isclose(got[p], float(np.quantile(values, p)), rel_tol=1e-9, abs_tol=1e-12)
    assert A.median(rows.where("false"), "v").first().median is None


def test_sample_is_the_smallest_hashes(spark):
    data = [(k % 700, f"d{k % 700}") for k in range(800)]  # 100 keys twice
    rows = spark.createDataFrame(data, "id long, t string").repartition(6)
    digests = sorted(hashlib.md5(f"{i}:{t}:42".encode()).hexdigest() for i, t in data)
    for n in (0, 1, 50, 799, 800, 5000):
        got = A.hash_sample(rows, n, ["id", "t"], 42).collect()
        assert sorted(hashlib.md5(f"{r.id}:{r.t}:42".encode()).hexdigest() for r in got) == digests[:n]


def test_no_row_is_sorted_or_shuffled(spark, sf_small):
    from panelkit.sources import standins as S
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        A.hash_sample(S.nullable(spark, sf_small), 50, ["l_orderkey", "l_partkey"], 42).explain()
    assert "Sort" not in text.getvalue() and "Exchange hashpartitioning" not in text.getvalue() and "Window" not in text.getvalue()


def test_positives_per_target(spark):
    rows = spark.createDataFrame([(i, t) for i in range(300) for t in ("x", "y", "z")], "row_id long, target string")
    rates = spark.createDataFrame([("x", 0.1), ("y", 0.0), ("w", 0.5)], "target string, rate double")
    got = random_positives(rows, rates, ["row_id"], 42).groupBy("target").agg(F.sum("yhat").alias("k"), F.count("*").alias("n")).collect()
    assert {r.target: (r.k, r.n) for r in got} == {"x": (30, 300), "y": (0, 300)}
