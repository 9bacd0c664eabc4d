"""Client-history operators: labels, transitions, splits, client filters.

All row-level windows use one spec, ``partitionBy(id).orderBy(fetch_date)``,
so Spark shuffles by ``id`` once and sorts once for all product columns. A
client has at most one row per period, so no client key is hot.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import null_count
from ..schema import NAN_THRESHOLD, TARGET_PREFIX
from . import bitmask
from .running import md5_key


def client_window(id_col: str = "id", order_col: str = "fetch_date"):
    """W: one client's rows in period order (the reference used file order, X1)."""
    return Window.partitionBy(id_col).orderBy(order_col)


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("id", "fetch_date")) -> DataFrame:
    """Keys that several rows have, with their number (``n``); NULL is a key of its own. Partial
    counts first, so a key of very many rows is one row per task in the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def check_keys(df: DataFrame, keys: Sequence[str] = ("id", "fetch_date")) -> None:
    """Raise ValueError when a key repeats; labels need one row per client and period."""
    some = duplicate_keys(df, keys).limit(5).collect()  # five examples for the message
    if some:
        raise ValueError("repeated keys, such as " + ", ".join(str(tuple(r[k] for k in keys)) + f" x {r['n']}" for r in some))


def lead_products(df: DataFrame, products: Sequence[str], suffix: str = "_next",
                  id_col: str = "id", order_col: str = "fetch_date") -> DataFrame:
    """Next row's value of every product column."""
    w = client_window(id_col, order_col)
    return df.select("*", *[F.lead(p).over(w).alias(p + suffix) for p in products])


def lag_products(df: DataFrame, products: Sequence[str], suffix: str = "_prev",
                 id_col: str = "id", order_col: str = "fetch_date") -> DataFrame:
    """Previous row's value of every product column."""
    w = client_window(id_col, order_col)
    return df.select("*", *[F.lag(p).over(w).alias(p + suffix) for p in products])


def acquisition_label(cur: Column, nxt: Column) -> Column:
    """1 when the product is 0 now and 1 in the next row; NULL compares as 0."""
    return F.coalesce(((cur == 0) & (nxt == 1)).cast("int"), F.lit(0))


def add_targets(df: DataFrame, products: Sequence[str], prefix: str = TARGET_PREFIX,
                id_col: str = "id", order_col: str = "fetch_date",
                next_period: str | None = None) -> DataFrame:
    """W01 + W03 (+ P05): ``target__<p>`` for every product, and ``_has_next``.

    By default the next *row* is the next period, gaps included (the
    reference's behaviour, X2). ``next_period="month"`` / ``"day"`` counts an
    acquisition only when the next row is exactly one month / day later.
    """
    w = client_window(id_col, order_col)
    consecutive = None
    if next_period == "month":
        consecutive = F.lead(order_col).over(w) == F.add_months(F.col(order_col), 1)
    elif next_period == "day":
        consecutive = F.lead(order_col).over(w) == F.date_add(F.col(order_col), 1)
    elif next_period is not None:
        raise ValueError("next_period must be None, 'month' or 'day'")
    cols = []
    for p in products:
        label = acquisition_label(F.col(p), F.lead(p).over(w))
        if consecutive is not None:
            label = F.when(F.coalesce(consecutive, F.lit(False)), label).otherwise(F.lit(0))
        cols.append(label.alias(prefix + p))
    has_next = F.lead(id_col).over(w).isNotNull().alias("_has_next")
    return df.select("*", *cols, has_next)


def drop_last_row(df: DataFrame, id_col: str = "id", order_col: str = "fetch_date") -> DataFrame:
    """Drop each client's last row (no next period to label)."""
    if "_has_next" in df.columns:
        return df.where(F.col("_has_next")).drop("_has_next")
    w = client_window(id_col, order_col)
    return (df.withColumn("_has_next", F.lead(id_col).over(w).isNotNull())
              .where(F.col("_has_next")).drop("_has_next"))


def target_columns(df: DataFrame, prefix: str = TARGET_PREFIX) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def any_target(targets: Sequence[str]) -> Column:
    return F.greatest(*[F.col(t) for t in targets]) if len(targets) > 1 else F.col(targets[0])


def clients_without_acquisition(df: DataFrame, targets: Sequence[str],
                                id_col: str = "id") -> DataFrame:
    """Ids whose label rows are all 0 (per-client partial aggregation)."""
    return (df.groupBy(id_col).agg(F.max(any_target(targets)).alias("_any"))
              .where(F.col("_any") == 0).select(id_col))


def drop_ids(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Anti-join; AQE picks broadcast or sort-merge from runtime sizes."""
    return df.join(ids, id_col, "left_anti")


def drop_clients_without_acquisition(df: DataFrame, targets: Sequence[str],
                                     id_col: str = "id", use_window: bool = True) -> DataFrame:
    """Remove clients with no acquisition at all (run after W04).

    The window form reuses the existing partitioning by ``id`` (no shuffle);
    the anti-join form (J01) is the reference's literal shape.
    """
    if use_window:
        w = Window.partitionBy(id_col)
        return (df.withColumn("_any", F.max(any_target(targets)).over(w))
                  .where(F.col("_any") > 0).drop("_any"))
    return drop_ids(df, clients_without_acquisition(df, targets, id_col), id_col)


def build_labels(df: DataFrame, products: Sequence[str], drop_inactive: bool = False,
                 prefix: str = TARGET_PREFIX, id_col: str = "id",
                 order_col: str = "fetch_date", next_period: str | None = None) -> DataFrame:
    """W01 + W03 + W04 (+ W05 when ``drop_inactive``): the labelled panel."""
    out = drop_last_row(add_targets(df, products, prefix, id_col, order_col, next_period),
                        id_col, order_col)
    if drop_inactive:
        out = drop_clients_without_acquisition(out, [prefix + p for p in products], id_col)
    return out


def split_by_date(df: DataFrame, split_date: str, order_col: str = "fetch_date"):
    """(train, test) = (<= date, > date). On a table partitioned by the date
    column both filters prune files."""
    d = F.to_date(F.lit(split_date))
    return df.where(F.col(order_col) <= d), df.where(F.col(order_col) > d)


def since(df: DataFrame, start_date: str, order_col: str = "fetch_date") -> DataFrame:
    """P10: drop periods before the train window."""
    return df.where(F.col(order_col) >= F.to_date(F.lit(start_date)))


def between_dates(df: DataFrame, start: str, end: str, order_col: str = "fetch_date") -> DataFrame:
    """Bounded window, both ends included."""
    return df.where(F.col(order_col).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def label_and_split(df: DataFrame, products: Sequence[str], split_date: str,
                    drop_inactive: bool = True, id_col: str = "id",
                    order_col: str = "fetch_date"):
    """Labels, last-row drop, optional inactive-client drop, then the split."""
    labelled = build_labels(df, products, drop_inactive, TARGET_PREFIX, id_col, order_col)
    return split_by_date(labelled, split_date, order_col)


def keep_few_nulls(df: DataFrame, threshold: int = NAN_THRESHOLD,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with fewer than ``threshold`` NULL cells (exactly 10 drops)."""
    cols = list(columns or df.columns)
    return df.where(null_count(cols) < threshold)


def keep_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Equality filter; NULL rows drop."""
    return df.where(F.col(column) == F.lit(value))


def clean(df: DataFrame, threshold: int = NAN_THRESHOLD, alive_col: str = "ind_deceased",
          alive_value: str = "N", columns: Sequence[str] | None = None) -> DataFrame:
    """P06 then P07 (the reference's cleaning step, outside the model, X7)."""
    return keep_equal(keep_few_nulls(df, threshold, columns), alive_col, alive_value)


def product_changes(df: DataFrame, products: Sequence[str], id_col: str = "id",
                    order_col: str = "fetch_date") -> DataFrame:
    """Difference to the previous row, per product (NULL for first rows)."""
    w = client_window(id_col, order_col)
    return df.select(id_col, order_col,
                     *[(F.col(p) - F.lag(p).over(w)).alias(p + "_diff") for p in products])


def count_changes(df: DataFrame, products: Sequence[str], id_col: str = "id",
                  order_col: str = "fetch_date") -> DataFrame:
    """Number of changes (any, +1, -1) over all products and rows, from bit masks."""
    t = bitmask.transition_counts(df, products, id_col, order_col)
    return t.select((F.col("n01") + F.col("n10")).alias("n_changes"), F.col("n01").alias("n_up"), F.col("n10").alias("n_down"))


def transitions_long(df: DataFrame, products: Sequence[str], id_col: str = "id",
                     order_col: str = "fetch_date") -> DataFrame:
    """(id, fetch_date, product, prev, cur) for every consecutive pair of rows."""
    lagged = lag_products(df.select(id_col, order_col, *products), products, "_prev",
                          id_col, order_col)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(p).alias("product"), F.col(p + "_prev").alias("prev"),
                 F.col(p).alias("cur")) for p in products])).alias("t")
    return lagged.select(id_col, order_col, pairs).select(id_col, order_col, "t.*")


def transition_table(df: DataFrame, products: Sequence[str], id_col: str = "id",
                     order_col: str = "fetch_date") -> DataFrame:
    """Counts of 0->0, 0->1, 1->0, 1->1 and their share of the comparable
    cells (A08: non-NULL cells minus each client's first non-NULL row per
    product), the reference's denominator. Without NULL gaps this equals the
    number of consecutive pairs.
    """
    t = bitmask.transition_counts(df, products, id_col, order_col)
    cells = F.explode(F.array(*[F.struct(F.lit(x).alias("prev"), F.lit(y).alias("cur"), F.col(f"n{x}{y}").alias("n"))
                                for x in (0, 1) for y in (0, 1)])).alias("t")
    rows = t.select(cells, "comparable_cells").where("t.n > 0")
    return rows.select("t.prev", "t.cur", "t.n", (F.col("t.n") / F.col("comparable_cells")).alias("share"))


def period_totals(df: DataFrame, products: Sequence[str],
                  order_col: str = "fetch_date") -> DataFrame:
    """Per-period product totals, long form (product, period, total)."""
    long = df.select(order_col, F.explode(F.array(*[
        F.struct(F.lit(p).alias("product"), F.col(p).alias("v")) for p in products])).alias("x"))
    return (long.groupBy("x.product", order_col)
                .agg(F.sum("x.v").cast("long").alias("total")))


def period_total_changes(df: DataFrame, products: Sequence[str],
                         order_col: str = "fetch_date") -> DataFrame:
    """Change of each product total vs the previous period; first = 0,
    negatives = 0 (P14). The window runs per product over period totals only."""
    t = period_totals(df, products, order_col)
    w = Window.partitionBy("product").orderBy(order_col)
    d = F.coalesce(F.col("total") - F.lag("total").over(w), F.lit(0))
    return t.select("product", order_col, "total", d.alias("change"),
                    F.when(d > 0, d).otherwise(F.lit(0)).alias("gain"))


def downsample_inactive(df: DataFrame, products: Sequence[str], keep_fraction: float = 0.2,
                        seed: int = 42, id_col: str = "id") -> DataFrame:
    """Keep every active client and a seeded ``keep_fraction`` of clients
    that never hold a product. The choice is by md5 of (id, seed), so it is
    repeatable and the same in SQL."""
    w = Window.partitionBy(id_col)
    flags = [F.coalesce(F.col(p), F.lit(0)) for p in products]
    held = F.max(F.greatest(*flags) if len(flags) > 1 else flags[0]).over(w)
    keep = (F.col("_held") > 0) | (F.substring(md5_key([id_col], seed), 1, 8) >= F.lit(
        hex_threshold(1.0 - keep_fraction)))
    return df.withColumn("_held", held).where(keep).drop("_held")


def hex_threshold(frac: float) -> str:
    """8-hex-digit lower bound: md5 prefixes >= it are a ``1 - frac`` share."""
    import math
    return format(min(16 ** 8 - 1, math.ceil(frac * 16 ** 8)), "08x")
