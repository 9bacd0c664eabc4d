"""Aggregation queries A01-A30 (and R05, R09 which share the profile code)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import panel as P
from ..operators import profile as A
from ..sources import standins as S
from .catalog import query, r6
from .sql_standins import with_ctes

OP = S.ORDER_PRODUCTS
EP = S.EVENT_PRODUCTS


def _snap(spark, sf):
    return S.snapshot(spark, sf)


@query("a01_distinct_counts", with_ctes(
    "SELECT count(DISTINCT fetch_date) AS n_fetch_date, count(DISTINCT id) AS n_id FROM snapshot",
    "snapshot"))
def a01_distinct_counts(spark, sf):
    """Distinct periods and clients."""
    return A.distinct_counts(_snap(spark, sf), ["fetch_date", "id"])


@query("a02_clients_per_period", with_ctes(
    "SELECT fetch_date, count(DISTINCT id) AS n_clients FROM event_panel GROUP BY fetch_date",
    "event_panel"))
def a02_clients_per_period(spark, sf):
    """Distinct clients per period."""
    return A.distinct_per_period(S.event_panel(spark, sf))


def client_summary_sql(products=OP, src="snapshot"):
    per = ", ".join(
        f"sum({p}) AS s_{p}, avg({p}) AS m_{p}, "
        f"arg_min({p}, fetch_date) FILTER (WHERE {p} IS NOT NULL) AS f_{p}, "
        f"arg_max({p}, fetch_date) FILTER (WHERE {p} IS NOT NULL) AS l_{p}" for p in products)
    total = " + ".join(f"coalesce(s_{p}, 0)" for p in products)
    msum = " + ".join(f"coalesce(m_{p}, 0.0)" for p in products)
    same = " AND ".join(f"coalesce(f_{p} = l_{p}, false)" for p in products)
    unch = " AND ".join(f"coalesce(f_{p} = m_{p}, false)" for p in products)
    return f"""SELECT round(avg(total), 6) AS mean_periods_held, round(avg(mean_sum), 6) AS mean_products,
      round(avg(CAST(mean_sum <= 1 AS DOUBLE)), 6) AS share_le_one,
      round(avg(CAST(total = 0 AS DOUBLE)), 6) AS share_never,
      round(avg(CAST(same_ends AS DOUBLE)), 6) AS share_same_ends,
      round(avg(CAST(unchanged AS DOUBLE)), 6) AS share_unchanged
    FROM (SELECT {total} AS total, {msum} AS mean_sum, {same} AS same_ends, {unch} AS unchanged
          FROM (SELECT id, {per} FROM {src} GROUP BY id))"""


@query("a03_a07_client_product_summary", with_ctes(client_summary_sql(), "snapshot"))
def a03_a07_client_product_summary(spark, sf):
    """A03-A07 (A03, A04, A05, A06, A07): holding per client, never / unchanged / same ends."""
    s = A.client_product_summary(_snap(spark, sf), OP)
    return s.select(*[r6(c).alias(c) for c in s.columns])


@query("a08_comparable_cells", with_ctes(
    "SELECT CAST(sum(" + " + ".join(f"c_{p} - CASE WHEN c_{p} > 0 THEN 1 ELSE 0 END" for p in OP)
    + ") AS BIGINT) AS comparable_cells FROM (SELECT id, "
    + ", ".join(f"count({p}) AS c_{p}" for p in OP) + " FROM snapshot GROUP BY id)", "snapshot"))
def a08_comparable_cells(spark, sf):
    """Non-NULL cells minus each client's first non-NULL row per product."""
    return A.comparable_cells(_snap(spark, sf), OP)


@query("a09_product_totals", with_ctes(" UNION ALL ".join(
    f"SELECT '{p}' AS product, CAST(sum({p}) AS BIGINT) AS total FROM snapshot" for p in OP),
    "snapshot"))
def a09_product_totals(spark, sf):
    """A09 + R01: total of each product, ascending."""
    return A.product_totals(_snap(spark, sf), OP).orderBy("total")


@query("a10_category_sizes", with_ctes(
    "SELECT entry_channel, count(*) AS n FROM snapshot WHERE entry_channel IS NOT NULL "
    "GROUP BY entry_channel", "snapshot"))
def a10_category_sizes(spark, sf):
    """A10 + R01: category sizes, descending, NULL group dropped."""
    return A.category_sizes(_snap(spark, sf), "entry_channel").orderBy(F.desc("n"))


@query("a11_value_counts_with_nulls", with_ctes(
    "SELECT client_type_1m, count(*) AS n FROM snapshot GROUP BY client_type_1m", "snapshot"))
def a11_value_counts_with_nulls(spark, sf):
    """Value counts, NULL kept."""
    return A.category_sizes(_snap(spark, sf), "client_type_1m", keep_null=True)


@query("a12_relative_frequency", with_ctes(
    "SELECT province_code, count(*) AS n, round(count(*) / (SELECT count(province_code) "
    "FROM snapshot), 6) AS freq FROM snapshot WHERE province_code IS NOT NULL "
    "GROUP BY province_code", "snapshot"))
def a12_relative_frequency(spark, sf):
    """Relative frequency of each non-NULL value."""
    r = A.relative_frequency(_snap(spark, sf), "province_code")
    return r.select("province_code", "n", r6("freq").alias("freq"))


@query("a13_distinct_values", with_ctes(
    "SELECT DISTINCT client_activity_1m FROM snapshot", "snapshot"))
def a13_distinct_values(spark, sf):
    """Distinct values, NULL kept."""
    return A.distinct_values(_snap(spark, sf), "client_activity_1m")


@query("a14_value_shares", with_ctes(
    "SELECT round(avg(CAST(client_segment IS NULL AS DOUBLE)), 6) AS null_share, "
    "round(avg(CAST(client_segment IS NOT DISTINCT FROM '02 - PARTICULARES' AS DOUBLE)), 6) "
    "AS value_share, round(avg(CAST(client_segment IS DISTINCT FROM '02 - PARTICULARES' "
    "AS DOUBLE)), 6) AS other_share FROM snapshot", "snapshot"))
def a14_value_shares(spark, sf):
    """NULL share, share of one value, share of the rest."""
    s = A.value_shares(_snap(spark, sf), "client_segment", "02 - PARTICULARES")
    return s.select(*[r6(c).alias(c) for c in s.columns])


# Spark type names of the snapshot columns (the dtype column of A15).
SNAPSHOT_DTYPES = [
    ("fetch_date", "date"), ("id", "bigint"), ("ind_employee", "string"),
    ("country_of_residence", "string"), ("gender", "string"), ("age", "string"),
    ("registration_date", "date"), ("ind_new_client", "double"), ("tenure_months", "string"),
    ("client_relationship_status", "double"), ("last_date_as_primary", "date"),
    ("client_type_1m", "string"), ("client_activity_1m", "string"), ("ind_resident", "string"),
    ("ind_foreigner", "string"), ("ind_spouse_employee", "string"), ("entry_channel", "string"),
    ("ind_deceased", "string"), ("address_type", "double"), ("province_code", "double"),
    ("province_name", "string"), ("ind_client_activity", "double"), ("income", "double"),
    ("client_segment", "string"),
] + [(p, "int") for p in OP]
_NUMERIC = {"bigint", "double", "int"}


def _profile_sql():
    parts = []
    for c, t in SNAPSHOT_DTYPES:
        zero = f"CAST(sum(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) AS BIGINT)" if t in _NUMERIC \
            else "CAST(0 AS BIGINT)"
        parts.append(
            f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, "
            f"CAST(count(*) - count({c}) AS BIGINT) AS nulls, {zero} AS zeros, "
            f"count(DISTINCT {c}) AS n_unique FROM snapshot")
    return " UNION ALL ".join(parts)


@query("a15_column_profile", with_ctes(_profile_sql(), "snapshot"))
def a15_column_profile(spark, sf):
    """Type, non-NULL count, NULLs, zeros, distinct values of every column."""
    return A.column_profile(_snap(spark, sf))


def _top5_sql():
    parts = [f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM snapshot"
             for c, _ in SNAPSHOT_DTYPES]
    return f"""SELECT "column", rank, value, n FROM (
      SELECT "column", value, n, row_number() OVER (PARTITION BY "column"
        ORDER BY n DESC, value) AS rank
      FROM (SELECT "column", value, count(*) AS n FROM ({' UNION ALL '.join(parts)})
            WHERE value IS NOT NULL GROUP BY "column", value)) WHERE rank <= 5"""


@query("r05_top5_values", with_ctes(_top5_sql(), "snapshot"))
def r05_top5_values(spark, sf):
    """Top-5 values of every column (two-stage top-k)."""
    return A.top_values(_snap(spark, sf), k=5)


@query("a16_null_history", with_ctes(
    """SELECT CASE WHEN grouping(fetch_date) = 1 THEN 'Total'
         ELSE strftime(fetch_date, '%Y-%m-%d') END AS fetch_date,
       count(l_returnflag) AS count, CAST(count(*) - count(l_returnflag) AS BIGINT) AS nan_sum
       FROM nullable WHERE fetch_date IS NOT NULL GROUP BY ROLLUP (fetch_date)""", "nullable"))
def a16_null_history(spark, sf):
    """A16 + R09: per-period non-NULL / NULL counts with a Total row."""
    return A.null_history(S.nullable(spark, sf), "l_returnflag")


_NULLS_SQL = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in S.NULLABLE_COLUMNS)


@query("a17_null_count_histogram", with_ctes(
    f"SELECT {_NULLS_SQL} AS n_nulls, count(*) AS rows FROM nullable GROUP BY 1", "nullable"))
def a17_null_count_histogram(spark, sf):
    """Rows per number of NULL cells."""
    return A.null_count_histogram(S.nullable(spark, sf))


@query("a17_rows_above_ten_nulls", with_ctes(
    f"SELECT CAST(sum(CAST({_NULLS_SQL} > 10 AS INTEGER)) AS BIGINT) AS rows_above FROM nullable",
    "nullable"))
def a17_rows_above_ten_nulls(spark, sf):
    """Rows with more than 10 NULL cells."""
    return A.rows_above_nulls(S.nullable(spark, sf), 10)


_AGE_SQL = "TRY_CAST(TRY_CAST(trim(age) AS DOUBLE) AS INTEGER)"


def _describe_sql(expr, src, where="TRUE"):
    ps = A.DESCRIBE_PERCENTILES
    qs = ", ".join(f"round(quantile_cont(x, {p}), 6) AS p{int(round(p * 100))}" for p in ps)
    return f"""SELECT count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
      round(min(x), 6) AS min, round(max(x), 6) AS max, {qs}
      FROM (SELECT CAST({expr} AS DOUBLE) AS x FROM {src} WHERE {where})"""


@query("a18_describe_age", with_ctes(
    _describe_sql(_AGE_SQL, "snapshot", f"{_AGE_SQL} IS NOT NULL"), "snapshot"))
def a18_describe_age(spark, sf):
    """A18 + P13: describe() of age without ' NA' rows, exact percentiles."""
    s = _snap(spark, sf)
    ages = s.select(X.to_int("age").alias("age")).where(F.col("age").isNotNull())
    d = A.describe(ages, "age")
    return d.select(*[r6(c).alias(c) if c != "count" else F.col(c) for c in d.columns])


_LOG_INCOME = "CASE WHEN income > 0 THEN ln(income) END"


@query("a19_median_log_income", with_ctes(
    f"SELECT round(quantile_cont({_LOG_INCOME}, 0.5), 6) AS median FROM snapshot", "snapshot"))
def a19_median_log_income(spark, sf):
    """Exact median of log income (the imputation value)."""
    s = _snap(spark, sf).select(X.log_or_null("income").alias("log_income"))
    return A.median(s, "log_income").select(r6("median").alias("median"))


@query("a20_mean_income", with_ctes(
    "SELECT round(avg(income), 6) AS mean FROM snapshot", "snapshot"))
def a20_mean_income(spark, sf):
    """Mean income."""
    return A.mean(_snap(spark, sf), "income").select(r6("mean").alias("mean"))


@query("a21_last_income", with_ctes(
    "SELECT id, arg_max(income, fetch_date) FILTER (WHERE income IS NOT NULL) AS income "
    "FROM snapshot GROUP BY id", "snapshot"))
def a21_last_income(spark, sf):
    """Each client's last non-NULL income."""
    return A.last_non_null(_snap(spark, sf), "income")


_LAST_INCOME_SQL = ("SELECT id, arg_max(income, fetch_date) FILTER (WHERE income IS NOT NULL) "
                    "AS income FROM snapshot GROUP BY id")


@query("a22_income_histogram", with_ctes(
    f"""SELECT bin, count(*) AS n, round(min(lo + (bin - 1) * w), 6) AS bin_start FROM (
      SELECT CASE WHEN hi = lo THEN 1 ELSE
        CAST(least(floor((income - lo) / w), 99) AS INTEGER) + 1 END AS bin, lo, w
      FROM ({_LAST_INCOME_SQL}) t, (SELECT min(income) AS lo, max(income) AS hi,
            (max(income) - min(income)) / 100 AS w FROM ({_LAST_INCOME_SQL})) r
      WHERE income IS NOT NULL) GROUP BY bin""", "snapshot"))
def a22_income_histogram(spark, sf):
    """100 equal-width bins of each client's last income."""
    h = A.equal_width_histogram(A.last_non_null(_snap(spark, sf), "income"), "income", 100)
    return h.select("bin", "n", r6("bin_start").alias("bin_start"))


def _qq_sql():
    grid = A.qq_grid(99)
    vals = ", ".join(f"({i + 1}, {p!r}, {z!r})" for i, (p, z) in enumerate(grid))
    plist = ", ".join(repr(p) for p, _ in grid)
    return f"""SELECT round(CAST(g.p AS DOUBLE), 6) AS p, round(CAST(g.z AS DOUBLE), 6) AS theoretical,
        round(q.qs[g.i], 6) AS sample
      FROM (SELECT quantile_cont({_LOG_INCOME}, [{plist}]) AS qs FROM snapshot) q,
           (VALUES {vals}) g(i, p, z)"""


@query("a23_qq_points", with_ctes(_qq_sql(), "snapshot"))
def a23_qq_points(spark, sf):
    """Normal Q-Q points of log income on a 99-point grid."""
    s = _snap(spark, sf).select(X.log_or_null("income").alias("log_income"))
    q = A.qq_points(s, "log_income", 99)
    return q.select(r6("p").alias("p"), r6("theoretical").alias("theoretical"),
                    r6("sample").alias("sample"))


def _qq_fit_sql():
    grid = A.qq_grid(99)
    vals = ", ".join(f"({i + 1}, CAST({z!r} AS DOUBLE))" for i, (_, z) in enumerate(grid))
    plist = ", ".join(repr(p) for p, _ in grid)
    return f"""SELECT round(regr_slope(s, z), 6) AS slope, round(regr_intercept(s, z), 6) AS intercept,
        round(corr(s, z), 6) AS r
      FROM (SELECT g.z, q.qs[g.i] AS s
            FROM (SELECT quantile_cont({_LOG_INCOME}, [{plist}]) AS qs FROM snapshot) q,
                 (VALUES {vals}) g(i, z))"""


@query("a23_qq_fit", with_ctes(_qq_fit_sql(), "snapshot"))
def a23_qq_fit(spark, sf):
    """Line through the normal Q-Q points of log income, and its correlation."""
    s = _snap(spark, sf).select(X.log_or_null("income").alias("log_income"))
    f = A.qq_fit(s, "log_income", 99)
    return f.select(*[r6(c).alias(c) for c in f.columns])


def _labels_long_sql(where="TRUE"):
    from .q_windows import _order_labelled_sql
    lab = f"SELECT * FROM ({_order_labelled_sql(False)}) WHERE {where}"
    return " UNION ALL ".join(
        f"SELECT id, fetch_date, 'target__{p}' AS target, target__{p} AS y FROM ({lab})"
        for p in OP)


def _order_labels_long(spark, sf, train_only=True):
    lab = P.build_labels(S.order_panel(spark, sf), OP)
    if train_only:
        lab, _ = P.split_by_date(lab, S.ORDER_SPLIT_DATE)
    return A.labels_long(lab, ["target__" + p for p in OP], ["id", "fetch_date"])


_TRAIN = f"fetch_date <= DATE '{S.ORDER_SPLIT_DATE}'"


@query("a24_label_rates", with_ctes(
    f"SELECT target, round(avg(y), 6) AS rate FROM ({_labels_long_sql(_TRAIN)}) GROUP BY target "
    "HAVING avg(y) > 0.01", "order_panel"))
def a24_label_rates(spark, sf):
    """Train acquisition rate per label, kept above 1%."""
    r = A.label_rates(_order_labels_long(spark, sf), 0.01)
    return r.select("target", r6("rate").alias("rate"))


@query("a25_varying_labels", with_ctes(
    f"SELECT target, count(DISTINCT y) AS n_values FROM ({_labels_long_sql(_TRAIN)}) "
    "GROUP BY target HAVING count(DISTINCT y) > 1", "order_panel"))
def a25_varying_labels(spark, sf):
    """Labels with more than one value in train."""
    return A.varying_labels(_order_labels_long(spark, sf))


@query("a26_penetration", with_ctes(" UNION ALL ".join(
    f"SELECT '{p}' AS product, round(avg(CAST(h <> 0 AS DOUBLE)) * 100, 6) AS percent FROM "
    f"(SELECT id, max(coalesce({p}, 0)) AS h FROM snapshot GROUP BY id)" for p in OP),
    "snapshot"))
def a26_penetration(spark, sf):
    """A26 + R01: % of clients holding each product at least once, ascending."""
    r = A.penetration(_snap(spark, sf), OP)
    return r.select("product", r6("percent").alias("percent")).orderBy("percent")


@query("a27_class_weights", with_ctes(
    f"SELECT target, round(count(*) / nullif(sum(y), 0), 6) AS weight "
    f"FROM ({_labels_long_sql(_TRAIN)}) GROUP BY target", "order_panel"))
def a27_class_weights(spark, sf):
    """Rows / positives per label."""
    r = A.class_weights(_order_labels_long(spark, sf))
    return r.select("target", r6("weight").alias("weight"))


@query("a28_period_totals", with_ctes(" UNION ALL ".join(
    f"SELECT '{p}' AS product, fetch_date, CAST(sum({p}) AS BIGINT) AS total "
    f"FROM event_panel GROUP BY fetch_date" for p in EP), "event_panel"))
def a28_period_totals(spark, sf):
    """Per-period product totals."""
    return P.period_totals(S.event_panel(spark, sf), EP)


@query("a29_true_vs_predicted", with_ctes(
    "SELECT target, CAST(sum(y) AS BIGINT) AS n_true, CAST(sum(yhat) AS BIGINT) AS n_pred "
    "FROM scored GROUP BY target", "scored"))
def a29_true_vs_predicted(spark, sf):
    """True vs predicted positives per target."""
    return A.true_vs_predicted(S.scored(spark, sf))


A30_FEATURES = ["age", "client_segment", "gender", "income", "ind_foreigner", "province_code"]
A30_PAIRS = [(a, b) for i, a in enumerate(A30_FEATURES) for b in A30_FEATURES[i + 1:]]


def _a30_sql():
    base = f"""SELECT *, {_AGE_SQL} AS age_n FROM snapshot"""

    def bins(c):
        return (f"CASE WHEN {c} IS NULL THEN NULL WHEN max({c}) OVER () = min({c}) OVER () THEN '1' "
                f"ELSE CAST(CAST(least(floor(({c} - min({c}) OVER ()) / ((max({c}) OVER () - "
                f"min({c}) OVER ()) / 10)), 9) AS INTEGER) + 1 AS VARCHAR) END")
    coded = (f"SELECT gender, client_segment, CAST(province_code AS VARCHAR) AS province_code, "
             f"ind_foreigner, {bins('income')} AS income, {bins('age_n')} AS age FROM ({base})")
    pairs = " UNION ALL ".join(
        f"SELECT '{a}|{b}' AS pair, CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b "
        f"FROM coded WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a, b in A30_PAIRS)
    return f"""coded AS ({coded}),
    cells AS (SELECT pair, a, b, count(*) AS o FROM ({pairs}) GROUP BY pair, a, b),
    ra AS (SELECT pair, a, sum(o) AS na FROM cells GROUP BY pair, a),
    rb AS (SELECT pair, b, sum(o) AS nb FROM cells GROUP BY pair, b),
    tot AS (SELECT pair, sum(o) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS c
            FROM cells GROUP BY pair),
    chi AS (SELECT c.pair, t.n, t.r, t.c, sum(o * o * t.n / (na * nb)) - t.n AS chi2
            FROM cells c JOIN ra USING (pair, a) JOIN rb USING (pair, b) JOIN tot t
            ON c.pair = t.pair GROUP BY c.pair, t.n, t.r, t.c)"""


@query("a30_association", with_ctes(
    "SELECT pair, CAST(n AS BIGINT) AS n, round(chi2, 6) AS chi2, "
    "round(CASE WHEN least(r, c) - 1 > 0 THEN sqrt(chi2 / n / (least(r, c) - 1)) END, 6) "
    "AS cramers_v FROM chi", "snapshot", extra=[_a30_sql()]))
def a30_association(spark, sf):
    """Chi-square and Cramer's V of the pairs of six demographic features, over all rows."""
    s = _snap(spark, sf).withColumn("age", X.to_int("age"))
    coded = A.binned(A.binned(s, "income", 10), "age", 10)
    coded = coded.withColumn("province_code", F.col("province_code").cast("string"))
    r = A.association(coded, A30_PAIRS)
    return r.select("pair", F.col("n").cast("long").alias("n"), r6("chi2").alias("chi2"),
                    r6("cramers_v").alias("cramers_v"))


A30_INTERVAL = ["age", "tenure_months", "income", "fetch_year", "fetch_month",
                "number_of_products"]
A30_CATEGORY = ["gender", "ind_new_client", "client_relationship_status", "client_type_1m",
                "client_activity_1m", "ind_foreigner", "entry_channel", "province_code",
                "ind_client_activity", "client_segment"]
A30_ALL = A30_INTERVAL + A30_CATEGORY + OP + ["target__" + p for p in OP]
A30_ALL_PAIRS = [(a, b) for i, a in enumerate(A30_ALL) for b in A30_ALL[i + 1:]]


def _a30_all_sql():
    interval = {"age": _AGE_SQL, "income": "income",
                "tenure_months": "TRY_CAST(TRY_CAST(trim(tenure_months) AS DOUBLE) AS INTEGER)",
                "fetch_year": "year(fetch_date)", "fetch_month": "month(fetch_date)",
                "number_of_products": " + ".join(f"coalesce({p}, 0)" for p in OP)}
    targets = ", ".join(
        f"CASE WHEN lead(id) OVER w IS NOT NULL THEN coalesce(CAST(({p} = 0 AND lead({p}) OVER w = 1) "
        f"AS INTEGER), 0) END AS target__{p}" for p in OP)
    numbers = ", ".join(f"CAST({e} AS DOUBLE) AS x_{c}" for c, e in interval.items())
    ranges = ", ".join(f"min(x_{c}) AS lo_{c}, max(x_{c}) AS hi_{c}" for c in interval)
    bins = ", ".join(
        f"CASE WHEN x_{c} IS NULL THEN NULL WHEN hi_{c} = lo_{c} THEN '1' ELSE CAST(CAST(least(floor("
        f"(x_{c} - lo_{c}) / ((hi_{c} - lo_{c}) / 10)), 9) AS INTEGER) + 1 AS VARCHAR) END AS {c}"
        for c in interval)
    texts = ", ".join(f"CAST(r.{c} AS VARCHAR) AS {c}" for c in A30_ALL[len(A30_INTERVAL):])
    pairs = ", ".join(f"{{'pair': '{a}|{b}', 'a': {a}, 'b': {b}}}" for a, b in A30_ALL_PAIRS)
    return f"""raw AS (SELECT *, {numbers}, {targets} FROM snapshot
      WINDOW w AS (PARTITION BY id ORDER BY fetch_date)),
    coded AS (SELECT {bins}, {texts} FROM raw r, (SELECT {ranges} FROM raw)),
    long AS (SELECT unnest([{pairs}]) AS p FROM coded),
    cells AS (SELECT p.pair AS pair, p.a AS a, p.b AS b, CAST(count(*) AS DOUBLE) AS o FROM long
              WHERE p.a IS NOT NULL AND p.b IS NOT NULL GROUP BY ALL),
    ra AS (SELECT pair, a, sum(o) AS na FROM cells GROUP BY pair, a),
    rb AS (SELECT pair, b, sum(o) AS nb FROM cells GROUP BY pair, b),
    tot AS (SELECT pair, sum(o) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS c
            FROM cells GROUP BY pair),
    chi AS (SELECT c.pair, t.n, t.r, t.c,
              greatest(sum(o * o * t.n / (na * nb)) - t.n, 0) AS chi2
            FROM cells c JOIN ra USING (pair, a) JOIN rb USING (pair, b) JOIN tot t
            ON c.pair = t.pair GROUP BY c.pair, t.n, t.r, t.c)"""


@query("a30_association_all", with_ctes(
    "SELECT pair, CAST(n AS BIGINT) AS n, round(chi2, 6) AS chi2, "
    "round(CASE WHEN least(r, c) - 1 > 0 THEN sqrt(chi2 / n / (least(r, c) - 1)) END, 6) "
    "AS cramers_v FROM chi", "snapshot", extra=[_a30_all_sql()]))
def a30_association_all(spark, sf):
    """Chi-square and Cramer's V of every pair of features, products and targets, over all rows.

    A client's last row has no next period: its targets are NULL and leave only the pairs of targets.
    """
    s = P.add_targets(_snap(spark, sf), OP)
    targets = ["target__" + p for p in OP]
    s = s.withColumns({t: F.when(F.col("_has_next"), F.col(t)) for t in targets} | {
        "age": X.to_int("age"), "tenure_months": X.to_int("tenure_months"),
        "fetch_year": X.year_of("fetch_date"), "fetch_month": X.month_of("fetch_date"),
        "number_of_products": X.number_of_products(OP)})
    r = A.association(A.binned_all(s.select(*A30_ALL), A30_INTERVAL, 10), A30_ALL_PAIRS)
    return r.select("pair", F.col("n").cast("long").alias("n"), r6("chi2").alias("chi2"),
                    r6("cramers_v").alias("cramers_v"))


@query("a10_category_sizes_province", with_ctes(
    "SELECT province_code, count(*) AS n FROM snapshot WHERE province_code IS NOT NULL "
    "GROUP BY province_code", "snapshot"))
def a10_category_sizes_province(spark, sf):
    """A10 + R01: province sizes, descending, NULL group dropped."""
    return A.category_sizes(_snap(spark, sf), "province_code").orderBy(F.desc("n"))


@query("a11_value_counts_activity", with_ctes(
    "SELECT client_activity_1m, count(*) AS n FROM snapshot GROUP BY client_activity_1m",
    "snapshot"))
def a11_value_counts_activity(spark, sf):
    """Value counts of the activity code, NULL kept."""
    return A.category_sizes(_snap(spark, sf), "client_activity_1m", keep_null=True)


_LOG_LAST_SQL = (f"SELECT id, CASE WHEN income > 0 THEN ln(income) END AS income "
                 f"FROM ({_LAST_INCOME_SQL})")


@query("a22_log_income_histogram", with_ctes(
    f"""SELECT bin, count(*) AS n, round(min(lo + (bin - 1) * w), 6) AS bin_start FROM (
      SELECT CASE WHEN hi = lo THEN 1 ELSE
        CAST(least(floor((income - lo) / w), 99) AS INTEGER) + 1 END AS bin, lo, w
      FROM ({_LOG_LAST_SQL}) t, (SELECT min(income) AS lo, max(income) AS hi,
            (max(income) - min(income)) / 100 AS w FROM ({_LOG_LAST_SQL})) r
      WHERE income IS NOT NULL) GROUP BY bin""", "snapshot"))
def a22_log_income_histogram(spark, sf):
    """100 equal-width bins of each client's last income after the log."""
    last = A.last_non_null(_snap(spark, sf), "income")
    logged = last.select("id", X.log_or_null("income").alias("income"))
    h = A.equal_width_histogram(logged, "income", 100)
    return h.select("bin", "n", r6("bin_start").alias("bin_start"))
