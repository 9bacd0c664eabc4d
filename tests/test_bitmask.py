"""Bit masks of product flags against the flags themselves."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators import bitmask as B
from panelkit.operators import panel as P
from panelkit.sources import standins as S

PRODUCTS = [f"p{i}" for i in range(24)]


def panel(seed=3, clients=40):
    own = random.Random(seed)
    rows = []
    for c in range(clients):
        for month in sorted(own.sample(range(1, 13), own.randint(1, 8))):
            rows.append((c, f"2020-{month:02d}-01", [own.choice([0, 0, 1, 1, None]) if c % 3 else own.choice([0, 1]) for _ in PRODUCTS]))
    rows.append((99, "2020-01-01", [None] * 24))
    rows.append((98, "2020-01-01", [1] * 24))
    rows.append((98, "2020-02-01", [1] * 24))
    return rows


@pytest.fixture(scope="module")
def rows():
    return panel()


@pytest.fixture(scope="module")
def table(spark, rows):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("fetch_date", T.StringType()),
                           *[T.StructField(p, T.IntegerType()) for p in PRODUCTS]])
    return spark.createDataFrame([(i, d, *f) for i, d, f in rows], schema).withColumn("fetch_date", F.to_date("fetch_date"))


def histories(rows):
    out = {}
    for i, _, flags in sorted(rows, key=lambda r: r[:2]):
        out.setdefault(i, []).append(flags)
    return out


def test_pack_and_unpack(table):
    got = B.pack(table, PRODUCTS).select("id", "fetch_date", *B.unpack(F.col("held"), PRODUCTS, known=F.col("known")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, table.select(got.columns).collect()))


def test_transitions_and_comparable_cells(table, rows):
    n, cells = [0] * 4, 0
    for flags in histories(rows).values():
        for p in range(24):
            values = [f[p] for f in flags]
            cells += max(0, sum(v is not None for v in values) - 1)
            for a, b in zip(values, values[1:]):
                if a is not None and b is not None:
                    n[2 * a + b] += 1
    assert tuple(B.transition_counts(table, PRODUCTS).first()) == (*n, cells)


@pytest.mark.parametrize("inactive", [False, True])
def test_labels_equal_those_of_the_columns(table, inactive):
    want = P.build_labels(table, PRODUCTS, inactive)
    got = B.build_labels(table, PRODUCTS, inactive).select(want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.count() > 0


def test_client_summary(table, rows):
    total, means, le_one, never, ends, same = 0, 0.0, 0, 0, 0, 0
    people = histories(rows)
    for flags in people.values():
        by_product = [[f[p] for f in flags if f[p] is not None] for p in range(24)]
        mean = sum(sum(v) / len(v) for v in by_product if v)
        total += sum(map(sum, by_product))
        means += mean
        le_one += mean <= 1
        never += sum(map(sum, by_product)) == 0
        ends += all(v and v[0] == v[-1] for v in by_product)
        same += all(v and len(set(v)) == 1 for v in by_product)
    n = len(people)
    got = B.client_summary(table, PRODUCTS).first()
    assert [round(x, 9) for x in got] == [round(x / n, 9) for x in (total, means, le_one, never, ends, same)]


def test_totals_and_bounds(table, rows):
    got = {r["product"]: r.total for r in B.totals(table, PRODUCTS).collect()}
    assert got == {p: sum(f[i] or 0 for _, _, f in rows) for i, p in enumerate(PRODUCTS)}
    assert B.totals(table.where("id = 99"), PRODUCTS).where("total is not null").isEmpty()
    with pytest.raises(ValueError):
        B.pack(table, [f"p{i}" for i in range(63)])
    assert B.build_labels(table.where("false"), PRODUCTS).count() == 0
    assert B.client_summary(table.where("false"), PRODUCTS).first().mean_products is None


def test_the_client_shuffle_moves_masks_only(spark, sf_small):
    import contextlib
    import io
    labelled = B.build_labels(S.wide_panel(spark, sf_small), S.wide_products())
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        labelled.explain("formatted")
    plan = text.getvalue()
    windows = [part for part in plan.split("\n\n") if part.lstrip().startswith("(") and ") Window" in part]
    assert windows and all("ind_1m" not in part for part in windows)
