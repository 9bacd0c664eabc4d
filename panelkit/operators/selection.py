"""Radix selection: the value at a rank, by a few histograms instead of a sort (R06, R08, M13,
A18, A19, A23).

A pass cuts each range that holds a wanted rank into cells by an order-preserving formula, and one
aggregation with map-side partial sums counts the cells (with their smallest and largest
value). The cell of the rank becomes the next range, tightened to the values in it, until it
holds one value. No row is sorted or shuffled: an exchange moves cells, at most
``MAX_CELLS`` a pass and task. The driver keeps the ranges only, one per wanted rank, of which
there are at most ``MAX_RANKS`` (checked).

Doubles are cut by their distance from the range's start, longs by a whole number of steps, so 60-bit
hashes need four passes of 2^16 cells or fewer. NULLs and NaN have no rank.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_CELLS = 1 << 16
MAX_RANKS = 20_000


@dataclass(frozen=True)
class Found:
    """The value at a rank, the rows below it and the rows equal to it."""

    value: float | int
    below: int
    equal: int


def _cell(v: Column, lo: Column, hi: Column, cells: int, whole: bool) -> Column:
    if whole:
        return F.expr(f"(_v - _lo) div ((_hi - _lo) div {cells} + 1)")
    # halves, so the width of any range is finite; a range too narrow for that has two cells
    width = hi / 2 - lo / 2
    part = F.least(F.floor((v / 2 - lo / 2) / width * F.lit(float(cells))), F.lit(cells - 1).cast("long"))
    return F.when(width > 0, part).otherwise((v > lo).cast("long"))


def ranked_values(df: DataFrame, value: Column, ranks: Callable[[tuple, int], Sequence[int]],
                  keys: Sequence[str] = ()) -> dict[tuple, dict[int, Found]] | None:
    """{key: {rank: Found}} for the 0-based ranks that ``ranks(key, rows)`` asks for.

    None if the keys or ranks are more than ``MAX_RANKS``: the caller then takes the distributed
    ranking instead.
    """
    spark, keys = df.sparkSession, list(keys)
    rows = df.select(*keys, value.alias("_v"))
    whole = isinstance(rows.schema["_v"].dataType, (T.LongType, T.IntegerType))
    rows = rows.withColumn("_v", F.col("_v").cast("long" if whole else "double")).where(F.col("_v").isNotNull())
    if not whole:
        rows = rows.where(~F.isnan("_v"))
    bounds = rows.groupBy(*keys).agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count(F.lit(1)).alias("n"))
    bounds = [r for r in bounds.limit(MAX_RANKS + 1).collect() if r.n]
    out: dict[tuple, dict[int, Found]] = {}
    open_, n_ranks = [], 0  # (key, lo, hi, rows below, wanted ranks)
    for r in bounds:
        key = tuple(r[k] for k in keys)
        wanted = sorted({k for k in ranks(key, r.n) if 0 <= k < r.n})
        n_ranks += len(wanted)
        out[key] = {}
        if wanted and r.lo == r.hi:
            out[key].update({k: Found(r.lo, 0, r.n) for k in wanted})
        elif wanted:
            open_.append((key, r.lo, r.hi, 0, wanted))
    if len(bounds) > MAX_RANKS or n_ranks > MAX_RANKS:
        return None
    fields = [rows.schema[k] for k in keys]
    number = T.LongType() if whole else T.DoubleType()
    of = [f"_of{i}" for i in range(len(keys))]
    schema = T.StructType([T.StructField(o, f.dataType) for o, f in zip(of, fields)]
                          + [T.StructField("_in", T.LongType()), T.StructField("_at", T.LongType()), T.StructField("_id", T.LongType()),
                             T.StructField("_lo", number), T.StructField("_hi", number)])
    rows = rows.withColumn("_range", F.lit(0).cast("long")).withColumn("_cell", F.lit(0).cast("long"))
    parent = [(0, 0)] * len(open_)
    while open_:
        cells = max(16, min(MAX_CELLS, MAX_CELLS * 16 // len(open_)))
        table = spark.createDataFrame([(*key, *p, i + 1, lo, hi) for i, ((key, lo, hi, _, _), p) in enumerate(zip(open_, parent))], schema)
        same = (F.col("_range") == F.col("_in")) & (F.col("_cell") == F.col("_at"))
        for k, o in zip(keys, of):
            same = same & F.col(k).eqNullSafe(F.col(o))
        # ranges are at most MAX_RANKS rows
        inside = rows.join(F.broadcast(table), same)
        rows = inside.select(*keys, "_v", F.col("_id").alias("_range"), _cell(F.col("_v"), F.col("_lo"), F.col("_hi"), cells, whole).alias("_cell"))
        counts = rows.groupBy("_range", "_cell").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy("_range").orderBy("_cell"))
        asked = spark.createDataFrame([(i + 1, k - below) for i, (_, _, _, below, ranks_) in enumerate(open_) for k in ranks_], "_asked long, _rank long")
        hit = counts.withColumn("upto", upto).join(F.broadcast(asked), (F.col("_range") == F.col("_asked")) & (F.col("_rank") < F.col("upto"))
                                                   & (F.col("_rank") >= F.col("upto") - F.col("n")))
        cells_hit: dict[tuple[int, int], list] = {}
        for r in hit.collect():
            cells_hit.setdefault((r["_range"], r["_cell"]), [r.lo, r.hi, r.upto - r.n, r.n, []])[4].append(r["_rank"])
        before, open_, parent = open_, [], []
        for (i, cell), (lo, hi, under, n, some) in cells_hit.items():
            key, _, _, below, _ = before[i - 1]
            wanted = [k + below for k in some]
            if lo == hi:
                out[key].update({k: Found(lo, below + under, n) for k in wanted})
            else:
                open_.append((key, lo, hi, below + under, wanted))
                parent.append((i, cell))
    return out


def quantiles(df: DataFrame, value: str, probs: Sequence[float]) -> DataFrame:
    """(p, q): exact linear-interpolation quantiles (``quantile_cont``); no rows without values."""
    total = 0

    def ranks(_, n):
        nonlocal total
        total = n
        return [r for p in probs for r in (int(p * (n - 1) // 1), -int(-(p * (n - 1)) // 1))]

    found = ranked_values(df, F.col(value).cast("double"), ranks)
    rows = []
    for by_rank in (found or {}).values():
        for p in probs:
            at = p * (total - 1)
            low, high = int(at // 1), -int(-at // 1)
            q0, q1 = by_rank[low].value, by_rank[high].value
            rows.append((float(p), q0 + (at - low) * (q1 - q0)))
    return df.sparkSession.createDataFrame(rows, "p double, q double")


def mark_smallest(df: DataFrame, order: Column, wanted: Callable[[tuple, int], int], keys: Sequence[str] = ()) -> DataFrame | None:
    """All rows with ``_chosen``: whether a row is among the ``wanted(key, rows)`` smallest of its key
    by ``order``, a text of hexadecimal digits (md5).

    The threshold is selected on the first 15 digits; only where fewer rows than have the same 15
    digits are wanted are those few ranked by the whole text (equal texts are interchangeable).
    """
    spark, keys = df.sparkSession, list(keys)
    rows = df.withColumn("_text", order).withColumn("_number", F.conv(F.substring("_text", 1, 15), 16, 10).cast("long"))
    sizes: dict[tuple, int] = {}

    def last(key, n):
        sizes[key] = max(0, min(n, wanted(key, n)))
        return [sizes[key] - 1]

    found = ranked_values(rows, F.col("_number"), last, keys)
    if found is None:
        return None
    of = [f"_of{i}" for i in range(len(keys))]
    schema = T.StructType([T.StructField(o, rows.schema[k].dataType) for o, k in zip(of, keys)]
                          + [T.StructField(c, T.LongType()) for c in ("_last", "_need", "_equal")])
    data = []
    for key, by_rank in found.items():
        for k, f in by_rank.items():
            data.append((*key, f.value, k + 1 - f.below, f.equal))
    table = spark.createDataFrame(data, schema)
    same = F.lit(True)
    for k, o in zip(keys, of):
        same = same & F.col(k).eqNullSafe(F.col(o))
    marked = rows.join(F.broadcast(table), same, "left")  # one row per key, checked
    tied = (F.col("_number") == F.col("_last")) & (F.col("_need") < F.col("_equal"))
    chosen = F.coalesce(F.col("_number") <= F.col("_last"), F.lit(False))
    names = [F.col(f"`{c}`") for c in df.columns]
    if all(need >= equal for *_, need, equal in data):
        return marked.select(*names, chosen.alias("_chosen"))
    w = Window.partitionBy(*keys, "_last").orderBy("_text")
    some = marked.where(tied).withColumn("_chosen", F.row_number().over(w) <= F.col("_need"))
    return marked.where(~F.coalesce(tied, F.lit(False))).select(*names, chosen.alias("_chosen")).unionByName(some.select(*names, "_chosen"))
