"""Profiling and aggregation operators.

Every profile is one or two aggregation passes with map-side partial
aggregation; per-column work is an ``unpivot`` into (column, value) rows, not
one job per column. Top-k per column is two-stage (salted buckets, then the
merge) so a high-cardinality column never lands in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import null_count
from ..session import scratch_dir
from . import bitmask
from .lookup import checked_join, map_values
from .running import exact_quantiles

#: Most values of a column that are looked up in a literal map.
MAX_LITERAL_CODES = 64


def _sum_cols(cols: Sequence[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


# --- A01-A02 ---------------------------------------------------------------

def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact distinct count of each column (NULL not counted)."""
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in cols])


def distinct_per_period(df: DataFrame, period: str = "fetch_date", id_col: str = "id") -> DataFrame:
    """Distinct clients per period."""
    return df.groupBy(period).agg(F.count_distinct(id_col).alias("n_clients"))


# --- A03-A08: per-client product statistics ---------------------------------

def client_product_summary(df: DataFrame, products: Sequence[str], id_col: str = "id",
                           order_col: str = "fetch_date") -> DataFrame:
    """A03-A07 in one per-client aggregation of bit masks and one scalar aggregation.

    mean_periods_held  A03: mean over clients of the summed product flags
    mean_products      A04: mean over clients of the summed per-product means
    share_le_one       A04: share of clients whose mean product count <= 1
    share_never        A05: share of clients that never hold any product
    share_same_ends    A06: share with the same product set at first and last row
    share_unchanged    A07: share whose product set never changed
    NULL cells are skipped as pandas does; a product with no value at all never
    compares equal (NaN != NaN).
    """
    return bitmask.client_summary(df, products, id_col, order_col)


def comparable_cells(df: DataFrame, products: Sequence[str], id_col: str = "id") -> DataFrame:
    """Non-NULL cells minus the first non-NULL row of each client and product."""
    per = df.groupBy(id_col).agg(*[F.count(p).alias(f"c_{p}") for p in products])
    terms = [F.col(f"c_{p}") - F.when(F.col(f"c_{p}") > 0, 1).otherwise(0) for p in products]
    return per.agg(F.sum(_sum_cols(terms)).cast("long").alias("comparable_cells"))


# --- A09-A14: totals, value counts ----------------------------------------

def unpivot_values(df: DataFrame, cols: Sequence[str], name: str = "column",
                   value: str = "value", as_string: bool = False) -> DataFrame:
    """(column, value) rows for the given columns (types unified to string if asked)."""
    vals = [(F.col(c).cast("string") if as_string else F.col(c)) for c in cols]
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(name), v.alias(value)) for c, v in zip(cols, vals)])).alias("_u")
    ).select(f"_u.{name}", f"_u.{value}")


def product_totals(df: DataFrame, products: Sequence[str]) -> DataFrame:
    """Total of each product (sorted ascending by the caller / R01)."""
    u = unpivot_values(df, products, "product", "v")
    return u.groupBy("product").agg(F.sum("v").cast("long").alias("total"))


def category_sizes(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    """A10 (NULL group dropped, as pandas groupby does) / A11 (NULL kept)."""
    src = df if keep_null else df.where(F.col(col).isNotNull())
    return src.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def relative_frequency(df: DataFrame, col: str) -> DataFrame:
    """Count of each non-NULL value over the non-NULL total.

    The total comes from a one-row aggregate joined on a constant key: it is a
    single value, so the join is a broadcast of one row.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(col).alias("_t")).withColumn("_k", F.lit(0))
    return (counts.withColumn("_k", F.lit(0)).join(F.broadcast(total), "_k")
                  .select(col, "n", (F.col("n") / F.col("_t")).alias("freq")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values, NULL kept."""
    return df.select(col).distinct()


def value_shares(df: DataFrame, col: str, value) -> DataFrame:
    """NULL share, share of ``value``, share of everything else (NULL counts
    as 'else', as ``!=`` does in pandas)."""
    x = F.col(col)
    is_v = x.eqNullSafe(F.lit(value))
    return df.agg(F.avg(x.isNull().cast("double")).alias("null_share"),
                  F.avg(is_v.cast("double")).alias("value_share"),
                  F.avg((~is_v).cast("double")).alias("other_share"))


# --- A15 / R05: column profile ---------------------------------------------

def value_counts_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n): rows per value of every column, values as text.

    One unpivot and one grouped count with map-side partial aggregation; a hot
    value collapses before the shuffle. Floating zeros are normalised (-0.0 is
    0.0) so distinct texts are distinct values. Shared by A15 and R05.
    """
    cols = list(cols or df.columns)
    vals = []
    for c in cols:
        x = F.col(c)
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            x = F.when(x == 0, F.lit(0.0)).otherwise(x)
        vals.append(x.cast("string"))
    u = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in zip(cols, vals)])
    ).alias("_u")).select("_u.column", "_u.value")
    return u.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def column_profile(df: DataFrame, cols: Sequence[str] | None = None,
                   counts: DataFrame | None = None, approx: bool = False,
                   rsd: float = 0.01) -> DataFrame:
    """Per column: type, non-NULL count, NULLs, zeros, exact distinct count.

    Everything comes from the (column, value, n) counts: distinct = number of
    non-NULL value groups, zeros = rows whose value is numerically 0 (numeric
    columns only). No per-column COUNT(DISTINCT) expansion of the rows.

    ``approx=True`` is one scan with fixed-size state instead: counts are exact,
    the distinct count is HyperLogLog++ (relative error ``rsd``); nothing per
    distinct value is materialised, which matters for id-like columns at scale.
    """
    cols = list(cols or df.columns)
    if approx:
        return _approx_profile(df, cols, rsd)
    counts = counts if counts is not None else value_counts_long(df, cols)
    types = dict(df.dtypes)
    numeric = [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]
    v, n = F.col("value"), F.col("n")
    is_zero = F.col("column").isin(*numeric) & (F.expr("try_cast(value AS double)") == 0) \
        if numeric else F.lit(False)
    prof = counts.groupBy("column").agg(
        F.sum(F.when(v.isNotNull(), n).otherwise(0)).cast("long").alias("non_null"),
        F.sum(F.when(v.isNull(), n).otherwise(0)).cast("long").alias("nulls"),
        F.sum(F.when(is_zero, n).otherwise(0)).cast("long").alias("zeros"),
        F.count(v).alias("n_unique"))
    dtype = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return prof.select("column", dtype[F.col("column")].alias("dtype"), "non_null", "nulls",
                       "zeros", "n_unique")


def _approx_profile(df: DataFrame, cols: Sequence[str], rsd: float) -> DataFrame:
    types = dict(df.dtypes)
    aggs = []
    for c in cols:
        x = F.col(c)
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        zero = F.sum(F.when(x == 0, 1).otherwise(0)) if numeric else F.lit(0)
        aggs += [F.count(x).alias(f"{c}__n"), F.sum(x.isNull().cast("long")).alias(f"{c}__null"),
                 zero.cast("long").alias(f"{c}__zero"),
                 F.approx_count_distinct(x, rsd).alias(f"{c}__nunique")]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                 F.col(f"{c}__n").alias("non_null"), F.col(f"{c}__null").alias("nulls"),
                 F.col(f"{c}__zero").alias("zeros"),
                 F.col(f"{c}__nunique").alias("n_unique")) for c in cols])).alias("p")
    ).select("p.*")


def top_k_per_group(counts: DataFrame, group: str, order: Sequence[Column], k: int,
                    salt_of: Column, buckets: int = 64) -> DataFrame:
    """Exact top-k rows per ``group`` in two stages: top-k within
    (group, salt bucket), then top-k of the survivors (at most k x buckets rows
    per group). ``order`` must be a total order."""
    stage1 = Window.partitionBy(group, "_salt").orderBy(*order)
    s = (counts.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(buckets)))
               .withColumn("_r1", F.row_number().over(stage1))
               .where(F.col("_r1") <= k).drop("_r1", "_salt"))
    stage2 = Window.partitionBy(group).orderBy(*order)
    return (s.withColumn("rank", F.row_number().over(stage2).cast("long"))
             .where(F.col("rank") <= k))


def top_values(df: DataFrame, cols: Sequence[str] | None = None, k: int = 5,
               counts: DataFrame | None = None) -> DataFrame:
    """The k most frequent non-NULL values of each column (value as text).
    Ties break by the value text, ascending."""
    counts = counts if counts is not None else value_counts_long(df, cols)
    counts = counts.where(F.col("value").isNotNull())
    return top_k_per_group(counts, "column", [F.col("n").desc(), F.col("value")], k,
                           F.col("value")).select("column", "rank", "value", "n")


# --- A16-A17: nulls ---------------------------------------------------------

def null_history(df: DataFrame, col: str, period: str = "fetch_date") -> DataFrame:
    """A16 + R09: per period non-NULL and NULL counts plus a 'Total' row (rollup).
    Rows without a period are left out of both, as pandas groupby drops them."""
    g = df.where(F.col(period).isNotNull()).rollup(period).agg(F.count(col).alias("count"),
                              F.sum(F.col(col).isNull().cast("long")).alias("nan_sum"),
                              F.grouping(period).alias("_g"))
    label = F.when(F.col("_g") == 1, F.lit("Total")).otherwise(
        F.date_format(F.col(period), "yyyy-MM-dd"))
    return g.select(label.alias(period), "count", "nan_sum")


def null_count_histogram(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Number of rows per NULL count."""
    cols = list(cols or df.columns)
    return df.groupBy(null_count(cols).alias("n_nulls")).agg(F.count(F.lit(1)).alias("rows"))


def rows_above_nulls(df: DataFrame, threshold: int = 10,
                     cols: Sequence[str] | None = None) -> DataFrame:
    """Rows with more than ``threshold`` NULL cells."""
    cols = list(cols or df.columns)
    return df.agg(F.sum((null_count(cols) > threshold).cast("long")).alias("rows_above"))


# --- A18-A23: distributions -------------------------------------------------

DESCRIBE_PERCENTILES = [0.1, 0.25, 0.5, 0.75, 0.99]


def describe(df: DataFrame, col: str, percentiles: Sequence[float] = DESCRIBE_PERCENTILES,
             exact: bool = True) -> DataFrame:
    """Count, mean, std (sample), min, percentiles, max of one column.

    Exact percentiles use the distributed rank of ``running.exact_quantiles``
    (pandas / DuckDB linear interpolation); ``exact=False`` uses
    ``percentile_approx`` for speed.
    """
    x = F.col(col).cast("double")
    base = df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"),
                  F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
    names = [f"p{int(round(p * 100))}" for p in percentiles]
    if exact:
        q = exact_quantiles(df.select(x.alias("_x")), "_x", list(percentiles))
        q = q.agg(*[F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(n)
                    for p, n in zip(percentiles, names)])
    else:
        arr = F.percentile_approx(x, list(percentiles), 10000)
        q = df.agg(arr.alias("_q")).select(*[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    # Both sides are single rows: a one-row broadcast join on a constant key.
    return (base.withColumn("_k", F.lit(0))
                .join(F.broadcast(q.withColumn("_k", F.lit(0))), "_k").drop("_k"))


def median(df: DataFrame, col: str, exact: bool = True) -> DataFrame:
    """Median (exact by default, distributed)."""
    if exact:
        # a global aggregate: one row, NULL where no value is
        return exact_quantiles(df, col, [0.5]).agg(F.max("q").alias("median"))
    return df.agg(F.percentile_approx(col, 0.5, 10000).alias("median"))


def mean(df: DataFrame, col: str) -> DataFrame:
    """A20."""
    return df.agg(F.avg(col).alias("mean"))


def last_non_null(df: DataFrame, col: str, id_col: str = "id",
                  order_col: str = "fetch_date") -> DataFrame:
    """Each client's last non-NULL value (pandas ``groupby().last()``)."""
    return df.groupBy(id_col).agg(
        F.expr(f"max_by(`{col}`, `{order_col}`) FILTER (WHERE `{col}` IS NOT NULL)").alias(col))


def equal_width_histogram(df: DataFrame, col: str, bins: int = 100) -> DataFrame:
    """Equal-width bins between min and max; the last bin is closed.

    One pass for (min, max), joined as one row, then a grouped count.
    """
    x = F.col(col).cast("double")
    rng = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi")).withColumn("_k", F.lit(0))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.least(F.floor((x - F.col("_lo")) / width), F.lit(bins - 1)).cast("int") + 1
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(b)
    j = (df.where(x.isNotNull()).withColumn("_k", F.lit(0))
           .join(F.broadcast(rng), "_k"))
    return (j.groupBy(b.alias("bin"))
             .agg(F.count(F.lit(1)).alias("n"),
                  F.first(F.col("_lo") + (b - 1) * width).alias("bin_start")))


def normal_quantile(p: float) -> float:
    """Inverse standard normal CDF (driver-side constant for a fixed grid)."""
    from statistics import NormalDist
    return NormalDist().inv_cdf(p)


def qq_grid(points: int = 99) -> list[tuple[float, float]]:
    return [(i / (points + 1), normal_quantile(i / (points + 1))) for i in range(1, points + 1)]


def qq_points(df: DataFrame, col: str, points: int = 99) -> DataFrame:
    """(p, theoretical normal quantile, sample quantile) on a fixed grid.

    Re-aimed from one point per row to a grid, so the output is bounded.
    """
    grid = qq_grid(points)
    q = exact_quantiles(df.select(F.col(col).cast("double").alias("_x")), "_x",
                        [p for p, _ in grid])
    zmap = F.create_map(*[x for p, z in grid for x in (F.lit(p), F.lit(z))])
    return q.select("p", zmap[F.col("p")].alias("theoretical"), F.col("q").alias("sample"))


def qq_fit(df: DataFrame, col: str, points: int = 99) -> DataFrame:
    """Least-squares line of sample on theoretical quantiles, and r."""
    pts = qq_points(df, col, points)
    return pts.agg(F.regr_slope("sample", "theoretical").alias("slope"),
                   F.regr_intercept("sample", "theoretical").alias("intercept"),
                   F.corr("sample", "theoretical").alias("r"))


# --- A24-A29: label statistics ----------------------------------------------

def labels_long(df: DataFrame, targets: Sequence[str], row_cols: Sequence[str],
                name: str = "target", value: str = "y") -> DataFrame:
    """Wide label columns to long (row..., target, y)."""
    return df.select(*row_cols, F.explode(F.array(*[
        F.struct(F.lit(t).alias(name), F.col(t).alias(value)) for t in targets])).alias("_l")
    ).select(*row_cols, f"_l.{name}", f"_l.{value}")


def label_rates(long: DataFrame, min_rate: float | None = None) -> DataFrame:
    """Acquisition rate per target, optionally only those above ``min_rate``."""
    r = long.groupBy("target").agg(F.avg("y").alias("rate"))
    return r if min_rate is None else r.where(F.col("rate") > min_rate)


def varying_labels(long: DataFrame) -> DataFrame:
    """Targets with more than one distinct value (fit only these)."""
    return (long.groupBy("target").agg(F.count_distinct("y").alias("n_values"))
                .where(F.col("n_values") > 1))


def penetration(df: DataFrame, products: Sequence[str], min_percent: float | None = None,
                id_col: str = "id") -> DataFrame:
    """% of clients holding each product at least once."""
    per = df.groupBy(id_col).agg(*[F.max(F.coalesce(F.col(p), F.lit(0))).alias(p)
                                   for p in products])
    u = unpivot_values(per, products, "product", "held")
    r = u.groupBy("product").agg((F.avg((F.col("held") != 0).cast("double")) * 100)
                                 .alias("percent"))
    return r if min_percent is None else r.where(F.col("percent") > min_percent)


def class_weights(long: DataFrame) -> DataFrame:
    """Rows / positives per target (NULL when a target has no positive)."""
    return long.groupBy("target").agg(
        (F.count(F.lit(1)) / F.nullif(F.sum("y"), F.lit(0))).alias("weight"))


def true_vs_predicted(scored: DataFrame) -> DataFrame:
    """True and predicted positives per target."""
    return scored.groupBy("target").agg(F.sum("y").cast("long").alias("n_true"),
                                        F.sum("yhat").cast("long").alias("n_pred"))


# --- A30: association -------------------------------------------

def binned(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bin code (1..bins) of a numeric column, as text."""
    x = F.col(col).cast("double")
    rng = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi")).withColumn("_k", F.lit(0))
    width = (F.col("_hi") - F.col("_lo")) / bins
    code = F.when(x.isNull(), F.lit(None)).when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(
        F.least(F.floor((x - F.col("_lo")) / width), F.lit(bins - 1)).cast("int") + 1)
    j = df.withColumn("_k", F.lit(0)).join(F.broadcast(rng), "_k")
    return j.withColumn(col, code.cast("string")).drop("_k", "_lo", "_hi")


def binned_all(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """``binned`` for several columns, with their ranges from one scan."""
    x = {c: F.col(c).cast("double") for c in cols}
    lo = {c: F.col(f"_r.lo_{c}") for c in cols}
    hi = {c: F.col(f"_r.hi_{c}") for c in cols}
    rng = df.agg(F.struct(*[f(x[c]).alias(f"{n}_{c}") for c in cols
                            for n, f in (("lo", F.min), ("hi", F.max))]).alias("_r"))
    code = {c: F.when(x[c].isNull(), F.lit(None)).when(hi[c] == lo[c], F.lit(1)).otherwise(
        F.least(F.floor((x[c] - lo[c]) / ((hi[c] - lo[c]) / bins)), F.lit(bins - 1)).cast("int") + 1)
        for c in cols}
    # one row of ranges
    return df.crossJoin(F.broadcast(rng)).withColumns(
        {c: code[c].cast("string") for c in cols}).drop("_r")


def value_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Dictionary of the columns: (i, place of the column; value as text; code), NULL left out.

    One aggregate over all columns gives the distinct values; the codes are unique numbers
    without any order, so no value passes the driver.
    """
    spark = df.sparkSession
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)])).alias("x"))
    values = values.select("x.*").where(F.col("value").isNotNull()).distinct()
    path = scratch_dir(spark, "value-codes")
    values.withColumn("code", F.monotonically_increasing_id()).write.partitionBy("i").parquet(path)
    return spark.read.schema("value string, code long, i int").parquet(path)


def coded(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One column ``codes``: an array with the code of each of ``cols``, NULL for NULL.

    A column of up to ``MAX_LITERAL_CODES`` values is looked up in a literal map, a larger one
    by ``lookup.checked_join``.
    """
    table = value_codes(df, cols)
    sizes = {r["i"]: r["count"] for r in table.groupBy("i").count().collect()}
    small = [i for i in range(len(cols)) if sizes.get(i, 0) <= MAX_LITERAL_CODES]
    literal: dict = {cols[i]: {} for i in small}
    for r in table.where(F.col("i").isin(small)).collect():
        literal[cols[r["i"]]][r["value"]] = r["code"]
    place = {c: f"_{i}" for i, c in enumerate(cols)}
    out = df.select(*[F.col(c).cast("string").alias(place[c]) for c in cols])
    for i, c in enumerate(cols):
        if c not in literal:
            own = table.where(F.col("i") == i).select(F.col("value").alias(place[c]), F.col("code").alias("_code"))
            out = checked_join(out, own, place[c]).withColumn(place[c], F.col("_code")).drop("_code")
    codes = [map_values(place[c], literal[c]) if literal.get(c) else
             F.lit(None).cast("long") if c in literal else F.col(place[c]) for c in cols]
    return out.select(F.array(*codes).alias("codes"))


def association(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Chi-square and Cramer's V for each feature pair (categorical codes).

    Values become numbers first (``coded``). Each row then gives its (pair, code, code) cells,
    which one grouped count adds up in the tasks before the shuffle; the cells are written, as
    four aggregates read them. chi2 = sum(o^2 / e) - n over non-empty cells, which equals the sum
    over all cells, so empty cells are never built. A pair in which no row has both values gives
    no row.
    """
    spark = df.sparkSession
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    # read twice, for the dictionaries and for the cells
    path = scratch_dir(spark, "associated")
    df.select(*[F.col(c).cast("string").alias(c) for c in cols]).write.parquet(path)
    df = spark.read.schema(", ".join(f"`{c}` string" for c in cols)).parquet(path)
    place = {c: i for i, c in enumerate(cols)}
    partners: dict = {}
    for a, b in dict.fromkeys(pairs):
        partners.setdefault(place[a], []).append(place[b])
    # (i, code), then (j, code) of the columns that i is paired with
    others = F.array(*[F.array(*[F.lit(j) for j in partners.get(i, [])]).cast("array<int>") for i in range(len(cols))])
    rows = coded(df, cols).select("codes", F.posexplode("codes").alias("i", "a")).where(F.col("a").isNotNull())
    rows = rows.select("codes", "i", "a", F.explode(F.get(others, F.col("i"))).alias("j"))
    rows = rows.select("i", "j", "a", F.get("codes", F.col("j")).alias("b")).where(F.col("b").isNotNull())
    path = scratch_dir(spark, "cells")
    rows.groupBy("i", "j", "a", "b").agg(F.count(F.lit(1)).alias("o")).write.parquet(path)
    # doubles: o * o * n passes the range of a long from some 2 million rows on
    cells = spark.read.parquet(path).withColumn("o", F.col("o").cast("double"))
    ra = cells.groupBy("i", "j", "a").agg(F.sum("o").alias("na"))
    rb = cells.groupBy("i", "j", "b").agg(F.sum("o").alias("nb"))
    # rows of a pair and its number of values on each side
    tot = ra.groupBy("i", "j").agg(F.sum("na").alias("n"), F.count(F.lit(1)).alias("r")).join(
        rb.groupBy("i", "j").agg(F.count(F.lit(1)).alias("c")), ["i", "j"])
    j = cells.join(ra, ["i", "j", "a"]).join(rb, ["i", "j", "b"]).join(F.broadcast(tot), ["i", "j"])
    chi = j.groupBy("i", "j", "n", "r", "c").agg(
        F.sum(F.col("o") * F.col("o") * F.col("n") / (F.col("na") * F.col("nb"))).alias("_s"))
    name = F.array(*[F.lit(c) for c in cols])
    chi = chi.select(F.concat_ws("|", F.get(name, F.col("i")), F.get(name, F.col("j"))).alias("pair"),
                     F.col("n").cast("long").alias("n"), "r", "c",
                     F.greatest(F.col("_s") - F.col("n"), F.lit(0.0)).alias("chi2"))
    k = F.least(F.col("r"), F.col("c")) - 1
    return chi.select("pair", "n", "chi2",
                      F.when(k > 0, F.sqrt(F.col("chi2") / F.col("n") / k)).alias("cramers_v"))


def hash_sample(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Fixed-size seeded sample: the n rows with the smallest md5(key, seed).

    The n-th smallest hash comes from radix selection; one filter then takes the rows: no
    ranking, sort or shuffle of the table.
    """
    from .running import md5_key
    from .selection import mark_smallest
    marked = mark_smallest(df, md5_key(list(key_cols), seed), lambda _, rows: n)
    return marked.where("_chosen").drop("_chosen")


def append_total(df: DataFrame, label_col: str, value_cols: Sequence[str],
                 label: str = "Total") -> DataFrame:
    """Append one total row (sum of each value column)."""
    total = df.agg(*[F.sum(c).alias(c) for c in value_cols]).select(
        F.lit(label).alias(label_col), *value_cols)
    return df.select(F.col(label_col).cast("string").alias(label_col), *value_cols) \
             .unionByName(total)

