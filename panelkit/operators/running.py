"""Running totals over a global order, without one task per group.

``Window.partitionBy(target).orderBy(score)`` puts every row of a target into a
single task; with one target holding a third of all rows that task holds a
third of the data. Instead the order value is cut into ``buckets`` ranges by
approximate quantiles (bounded sketch state), each range is summed by its own
window partition, and range offsets are added from a small table of range
totals. The result is exact: only the bucketing is approximate, and buckets
never split equal order values.

Used by the ROC / PR curves (M04-M08), exact quantiles (A18, A19, A23) and
seeded per-label ranking (R08).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def default_buckets(df: DataFrame) -> int:
    """Range buckets per key: the shuffle partition count, capped at four per
    task slot (more ranges than that add tasks, not parallelism)."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    slots = spark.sparkContext.defaultParallelism
    return max(4, min(n, 4 * slots))


def _bucket_of(value: Column, bounds: Column, descending: bool) -> Column:
    """Range id; NULL values have a range of their own, last if descending, else first
    (as the sort order has them)."""
    if descending:
        n, null = F.size(F.filter(bounds, lambda b: b > value)), F.lit(2**31 - 1)
    else:
        n, null = F.size(F.filter(bounds, lambda b: b < value)), F.lit(-1)
    return F.when(value.isNull(), null).otherwise(n)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys of which NULLs are equal."""
    cond = F.lit(True)
    for k in keys:
        right = right.withColumnRenamed(k, f"__{k}")
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(right, cond).drop(*[f"__{k}" for k in keys])


def with_buckets(df: DataFrame, keys: list[str], order_col: str, descending: bool,
                 buckets: int | None = None, accuracy: int = 10000) -> DataFrame:
    """Add ``_bkt``: a range id of ``order_col`` within each key, monotone in the order."""
    n = buckets or default_buckets(df)
    probs = [i / n for i in range(1, n)]
    v = F.col(order_col).cast("double")
    bounds = df.groupBy(*keys).agg(F.percentile_approx(v, probs, accuracy).alias("_bounds"))
    # One row per key; Spark broadcasts it only below its own size limit.
    joined = _join_null_safe(df, bounds, keys)
    return joined.withColumn("_bkt", _bucket_of(v, F.col("_bounds"), descending)).drop("_bounds")


def running_sums(df: DataFrame, keys: list[str], order_col: str, descending: bool,
                 values: list[str], tiebreak: list[Column] | None = None,
                 inclusive: bool = True, buckets: int | None = None,
                 prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<v>`` = sum of ``v`` over rows before (and at, if inclusive) each row.

    Rows are ordered by ``order_col`` (desc if ``descending``) then ``tiebreak``
    within each combination of ``keys``.
    """
    cols = list(df.columns)
    if not keys:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    b = with_buckets(df, keys, order_col, descending, buckets)
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    order = [o] + list(tiebreak or [])
    end = Window.currentRow if inclusive else -1
    w_in = (Window.partitionBy(*keys, "_bkt").orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, end))
    inner = b.select("*", *[F.coalesce(F.sum(v).over(w_in), F.lit(0)).alias(f"_in_{v}")
                            for v in values])
    totals = b.groupBy(*keys, "_bkt").agg(*[F.sum(v).alias(f"_bt_{v}") for v in values])
    w_blk = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_bkt", *[
        F.coalesce(F.sum(f"_bt_{v}").over(w_blk), F.lit(0)).alias(f"_off_{v}") for v in values])
    out = _join_null_safe(inner, offsets, keys + ["_bkt"])
    return out.select(*cols,
                      *[(F.col(f"_in_{v}") + F.col(f"_off_{v}")).alias(f"{prefix}{v}")
                        for v in values])


def exact_quantiles(df: DataFrame, value: str, probs: list[float],
                    keys: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (``quantile_cont``), distributed.

    Without keys by radix selection (``selection``). With keys, values are first counted per distinct value (a hot value collapses to one
    row), then ranked with ``running_sums``; each requested position picks the
    value whose cumulative range covers it. Returns (keys..., p, q).
    """
    from pyspark import StorageLevel

    from .selection import quantiles
    keys = list(keys or [])
    if not keys:
        return quantiles(df, value, probs)
    # Distinct values with their counts: read by the bounds, the range windows
    # and the totals, so they are kept (at most one row per distinct value).
    counts = (df.where(F.col(value).isNotNull())
                .groupBy(*keys, F.col(value).cast("double").alias("_v"))
                .agg(F.count(F.lit(1)).alias("_n"))).persist(StorageLevel.MEMORY_AND_DISK)
    ranked = running_sums(counts, keys, "_v", False, ["_n"], buckets=buckets)
    ranked = ranked.select(*keys, "_v", (F.col("cum__n") - F.col("_n")).alias("_lo"),
                           F.col("cum__n").alias("_hi"))
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    req = totals.select(*keys, F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"),
                        "_total")
    req = req.select(*keys, "p", (F.col("p") * (F.col("_total") - 1)).alias("_h"))
    req = req.select(*keys, "p", "_h", F.floor("_h").alias("_i0"), F.ceil("_h").alias("_i1"))
    # Requests are (keys x len(probs)) rows: broadcast is size-bounded. One range
    # join finds the values covering both neighbouring positions of each request.
    r = F.broadcast(req.alias("r"))
    x = ranked.alias("x")
    cond = (F.col("x._lo") <= F.col("r._i1")) & (F.col("r._i0") < F.col("x._hi"))
    for k in keys:
        cond = cond & (F.col(f"x.{k}") == F.col(f"r.{k}"))
    hit = x.join(r, cond).select(*[F.col(f"r.{k}").alias(k) for k in keys], "r.p", "r._h",
                                 "r._i0", "r._i1", "x._v", "x._lo", "x._hi")

    def covers(i):
        return (F.col("_lo") <= F.col(i)) & (F.col(i) < F.col("_hi"))

    out = hit.groupBy(*keys, "p", "_h", "_i0").agg(
        F.max(F.when(covers("_i0"), F.col("_v"))).alias("_q0"),
        F.max(F.when(covers("_i1"), F.col("_v"))).alias("_q1"))
    frac = F.col("_h") - F.col("_i0")
    return out.select(*keys, "p", (F.col("_q0") + frac * (F.col("_q1") - F.col("_q0"))).alias("q"))


def seeded_rank(df: DataFrame, keys: list[str], row_cols: list[str], seed: int,
                salt: str = "") -> DataFrame:
    """Add ``rank`` (1..n within keys) by an md5 of the row key and the seed.

    The same order is produced by ``row_number() over (partition by keys order
    by md5(...))`` in SQL; ranks come from ``running_sums`` so a large key never
    sits in one task.
    """
    h = md5_key(row_cols, seed, salt)
    d = df.withColumn("_h", h).withColumn(
        "_hn", F.conv(F.substring("_h", 1, 15), 16, 10).cast("long")).withColumn("_one", F.lit(1))
    r = running_sums(d, keys, "_hn", False, ["_one"], tiebreak=[F.col("_h")])
    return r.withColumnRenamed("cum__one", "rank").drop("_h", "_hn", "_one")


def md5_key(row_cols: list[str], seed: int, salt: str = "") -> Column:
    parts = []
    for i, c in enumerate(row_cols):
        if i:
            parts.append(F.lit(":"))
        parts.append(F.col(c).cast("string"))
    parts += [F.lit(":" + salt + str(seed))]
    return F.md5(F.concat(*parts))


def md5_sql(row_cols: list[str], seed: int, salt: str = "") -> str:
    """SQL twin of ``md5_key``."""
    items = []
    for i, c in enumerate(row_cols):
        if i:
            items.append("':'")
        items.append(f"CAST({c} AS VARCHAR)")
    items.append(f"':{salt}{seed}'")
    return f"md5(concat({', '.join(items)}))"
