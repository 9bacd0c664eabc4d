"""Distributed exact quantiles, top-k and profiles against brute force."""

import numpy as np
import pandas as pd

from panelkit.operators import profile as A
from panelkit.operators.running import exact_quantiles, running_sums, seeded_rank


def test_exact_quantiles_match_numpy_linear(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=500), np.full(300, 1.5), rng.exponential(size=200)])
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r.p: r.q for r in exact_quantiles(df, "x", probs, buckets=7).collect()}
    for p in probs:
        assert abs(got[p] - np.quantile(vals, p)) < 1e-12


def test_grouped_quantiles(spark):
    pdf = pd.DataFrame({"g": ["a"] * 5 + ["b"] * 4, "x": [1, 2, 3, 4, 100, 10, 20, 30, 40]})
    df = spark.createDataFrame(pdf)
    got = {(r.g, r.p): r.q for r in exact_quantiles(df, "x", [0.5], keys=["g"], buckets=3).collect()}
    assert got[("a", 0.5)] == 3.0 and got[("b", 0.5)] == 25.0


def test_running_sums_match_cumsum(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 400), "v": rng.random(400), "w": rng.integers(0, 5, 400)})
    df = spark.createDataFrame(pdf)
    out = running_sums(df, ["k"], "v", True, ["w"], buckets=5).toPandas()
    for k, g in pdf.groupby("k"):
        exp = g.sort_values("v", ascending=False)["w"].cumsum().to_numpy()
        got = out[out.k == k].sort_values("v", ascending=False)["cum_w"].to_numpy()
        assert (exp == got).all()


def test_seeded_rank_is_a_permutation(spark):
    df = spark.range(1000).withColumnRenamed("id", "row").selectExpr("row", "row % 3 AS k")
    r = seeded_rank(df, ["k"], ["row"], 42).toPandas()
    for k, g in r.groupby("k"):
        assert sorted(g["rank"]) == list(range(1, len(g) + 1))


def test_top_values_two_stage_equals_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"c": rng.integers(0, 50, 2000).astype(str), "d": rng.integers(0, 4, 2000)})
    got = A.top_values(spark.createDataFrame(pdf), ["c"], k=5).orderBy("rank").toPandas()
    vc = pdf["c"].value_counts()
    exp = sorted(vc.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert list(zip(got["value"], got["n"])) == exp


def test_null_history_total_row(spark):
    import datetime as dt
    rows = [(dt.date(2015, 1, 28), None), (dt.date(2015, 1, 28), "a"), (dt.date(2015, 2, 28), "b"),
            (None, None)]
    df = spark.createDataFrame(rows, "fetch_date date, c string")
    got = {r.fetch_date: (r["count"], r.nan_sum) for r in A.null_history(df, "c").collect()}
    assert got == {"2015-01-28": (1, 1), "2015-02-28": (1, 0), "Total": (2, 1)}


def test_describe_matches_pandas(spark):
    x = pd.Series([3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5], dtype=float)
    d = A.describe(spark.createDataFrame(pd.DataFrame({"x": x})), "x").first()
    ref = x.describe(percentiles=[0.1, 0.25, 0.5, 0.75, 0.99])
    assert d["count"] == ref["count"] and abs(d["std"] - ref["std"]) < 1e-12
    for p in ["10%", "25%", "50%", "75%", "99%"]:
        assert abs(d["p" + p[:-1]] - ref[p]) < 1e-12


def test_association_perfect_dependence(spark):
    pdf = pd.DataFrame({"a": ["x", "y"] * 50, "b": ["p", "q"] * 50})
    r = A.association(spark.createDataFrame(pdf), [("a", "b")]).first()
    assert abs(r.cramers_v - 1.0) < 1e-12 and abs(r.chi2 - 100.0) < 1e-9


def test_association_covers_all_features_products_and_targets(spark, sf_small):
    from itertools import combinations

    from panelkit.plans import catalog
    from panelkit.plans.q_aggs import OP
    catalog.load_all()
    numerical = ["age", "tenure_months", "income", "fetch_year", "fetch_month", "number_of_products"]
    category = ["gender", "ind_new_client", "client_relationship_status", "client_type_1m",
                "client_activity_1m", "ind_foreigner", "entry_channel", "province_code",
                "ind_client_activity", "client_segment"]
    columns = numerical + category + OP + ["target__" + p for p in OP]
    got = {frozenset(r.pair.split("|")): r
           for r in catalog.QUERIES["a30_association_all"](spark, sf_small).collect()}
    assert set(got) == {frozenset(p) for p in combinations(columns, 2)}
    # the pairs of the six demographic features are the same rows
    for r in catalog.QUERIES["a30_association"](spark, sf_small).collect():
        assert r[1:] == got[frozenset(r.pair.split("|"))][1:]
    # a target against a feature, by hand: the last row of a client has no target
    from panelkit.sources import standins as S
    pdf = S.snapshot(spark, sf_small).toPandas().sort_values(["id", "fetch_date"])
    nxt = pdf.groupby("id")["ind_1m_urgent"].shift(-1)
    y = ((pdf["ind_1m_urgent"] == 0) & (nxt == 1))[nxt.notna()].astype(int)
    table = pd.crosstab(pdf.loc[y.index, "client_segment"], y)
    o = table.to_numpy(float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    r = got[frozenset(["client_segment", "target__ind_1m_urgent"])]
    assert r.n == o.sum() and abs(r.chi2 - ((o - e) ** 2 / e).sum()) < 1e-5


def test_association_counts_past_the_range_of_a_long(spark):
    # 3 million equal rows: o * o * n is 2.7e19
    df = spark.range(3_000_000).selectExpr("IF(id < 2999990, 'x', 'y') AS a", "IF(id < 2999990, 'p', 'q') AS b")
    r = A.association(df, [("a", "b")]).first()
    assert r.n == 3_000_000 and abs(r.cramers_v - 1.0) < 1e-9


def test_hot_key_is_split_across_buckets(spark):
    # One target holds 90% of the rows: its running totals still come from many
    # window partitions (buckets), and stay exact.
    from panelkit.operators.running import with_buckets
    rng = np.random.default_rng(11)
    n = 3000
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.9, "hot", "cold"),
                        "v": rng.random(n), "w": rng.integers(0, 3, n)})
    df = spark.createDataFrame(pdf)
    b = with_buckets(df, ["k"], "v", True, buckets=16).toPandas()
    assert b[b.k == "hot"]["_bkt"].nunique() >= 8
    out = running_sums(df, ["k"], "v", True, ["w"], buckets=16).toPandas()
    g = pdf[pdf.k == "hot"].sort_values("v", ascending=False)
    got = out[out.k == "hot"].sort_values("v", ascending=False)["cum_w"].to_numpy()
    assert (g["w"].cumsum().to_numpy() == got).all()


def test_approx_profile_close_to_exact(spark, sf_small):
    from panelkit.sources import standins as S
    snap = S.snapshot(spark, sf_small)
    exact = {r.column: r for r in A.column_profile(snap).collect()}
    approx = {r.column: r for r in A.column_profile(snap, approx=True).collect()}
    assert set(exact) == set(approx)
    for c, e in exact.items():
        a = approx[c]
        assert (a.non_null, a.nulls, a.zeros, a.dtype) == (e.non_null, e.nulls, e.zeros, e.dtype)
        assert abs(a.n_unique - e.n_unique) <= max(2, 0.05 * e.n_unique)


def test_qq_fit_is_the_line_through_the_points(spark, sf_small):
    from panelkit.plans import catalog
    catalog.load_all()
    pts = catalog.QUERIES["a23_qq_points"](spark, sf_small).toPandas()
    fit = catalog.QUERIES["a23_qq_fit"](spark, sf_small).first()
    slope, intercept = np.polyfit(pts["theoretical"], pts["sample"], 1)
    assert abs(fit.slope - slope) < 1e-4 and abs(fit.intercept - intercept) < 1e-4
    assert abs(fit.r - np.corrcoef(pts["theoretical"], pts["sample"])[0, 1]) < 1e-4


def test_association_by_hand_with_nulls_and_large_dictionaries(spark, monkeypatch):
    """Literal and joined dictionaries give the same; NULLs leave their pairs; clashing names; empty table."""
    rows = [(i % 3, f"v{i % 7}", None if i % 5 == 0 else str(i % 2), None) for i in range(210)]
    df = spark.createDataFrame(rows, "i int, code string, value string, none string")
    pairs = [("i", "code"), ("i", "value"), ("code", "value"), ("i", "none")]

    def by_hand(a, b):
        both = [(r[a], r[b]) for r in rows if r[a] is not None and r[b] is not None]
        n, seen = len(both), {}
        for x in both:
            seen[x] = seen.get(x, 0) + 1
        left = {x: sum(o for (p, _), o in seen.items() if p == x) for x, _ in both}
        right = {y: sum(o for (_, q), o in seen.items() if q == y) for _, y in both}
        return n, sum((seen.get((x, y), 0) - left[x] * right[y] / n) ** 2 / (left[x] * right[y] / n)
                      for x in left for y in right)

    want = {"i|code": by_hand(0, 1), "i|value": by_hand(0, 2), "code|value": by_hand(1, 2)}
    for limit in (64, 2, 0):
        monkeypatch.setattr(A, "MAX_LITERAL_CODES", limit)
        got = {r.pair: (r.n, r.chi2) for r in A.association(df, pairs).collect()}
        assert got.keys() == want.keys()
        assert all(got[p][0] == want[p][0] and abs(got[p][1] - want[p][1]) < 1e-6 for p in want)
    assert A.association(df.limit(0), pairs).count() == 0
