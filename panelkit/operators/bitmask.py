"""Product flags of a panel row as two bit masks.

``held`` has bit i set where product i is 1, ``known`` where it is not NULL. A next or previous
row is then one ``lead`` or ``lag`` of a mask, labels and transitions are ``&`` and ``~`` over
all products at once, and totals are ``bit_count``: whatever the number of products (62 at most),
the client shuffle moves 16 bytes of flags a row, and a client's state has a few longs
instead of seven buffers per product. Flags are 0, 1 or NULL, as declared.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a client that a 20-bit lane can count; a client has one row per period.
LANE_BITS = 20
LANES = 3


def _or_all(parts: Sequence[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out.bitwiseOR(p)
    return out


def _checked(products: Sequence[str]) -> list[str]:
    products = list(products)
    if not 0 < len(products) <= 62:
        raise ValueError("a mask holds 1 to 62 products")
    return products


def held_mask(products: Sequence[str]) -> Column:
    return _or_all([F.when(F.col(p) == 1, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
                    for i, p in enumerate(_checked(products))])


def known_mask(products: Sequence[str]) -> Column:
    return _or_all([F.when(F.col(p).isNotNull(), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
                    for i, p in enumerate(_checked(products))])


def every(products: Sequence[str]) -> Column:
    """The mask of all products."""
    return F.lit((1 << len(_checked(products))) - 1).cast("long")


def pack(df: DataFrame, products: Sequence[str], keep: Sequence[str] = ("id", "fetch_date")) -> DataFrame:
    """Key columns and the two masks; only these go on to a shuffle."""
    return df.select(*keep, held_mask(products).alias("held"), known_mask(products).alias("known"))


def bit(mask: Column, i: int) -> Column:
    return F.shiftright(mask, i).bitwiseAND(F.lit(1).cast("long")).cast("int")


def unpack(mask: Column, products: Sequence[str], prefix: str = "", known: Column | None = None) -> list[Column]:
    """One 0/1 column per product; NULL where ``known`` has no bit."""
    out = []
    for i, p in enumerate(_checked(products)):
        flag = bit(mask, i)
        out.append((flag if known is None else F.when(bit(known, i) == 1, flag)).alias(prefix + p))
    return out


def _client(id_col: str, order_col: str):
    return Window.partitionBy(id_col).orderBy(order_col)


def label_masks(packed: DataFrame, id_col: str = "id", order_col: str = "fetch_date") -> DataFrame:
    """W01 + W03 + W04: ``acquired`` has the products that are 0 now and 1 in the client's next row;
    rows without a next one go. A NULL compares as no acquisition."""
    w = _client(id_col, order_col)
    now = F.col("known").bitwiseAND(F.bitwise_not("held"))
    return (packed.withColumn("_next", F.lead("held").over(w)).where(F.col("_next").isNotNull())
            .withColumn("acquired", now.bitwiseAND(F.col("_next"))).drop("_next"))


def drop_inactive(labelled: DataFrame, id_col: str = "id") -> DataFrame:
    """Clients without any acquisition go; no further shuffle."""
    w = Window.partitionBy(id_col)
    return labelled.withColumn("_any", F.bit_or("acquired").over(w)).where(F.col("_any") != 0).drop("_any")


def build_labels(df: DataFrame, products: Sequence[str], inactive: bool = True, carry: Sequence[str] = (), prefix: str = "target__",
                 id_col: str = "id", order_col: str = "fetch_date") -> DataFrame:
    """The labelled panel: keys, ``carry``, the flags, and one label per product.

    Only keys, ``carry`` and masks are shuffled; flags and labels are unpacked afterwards.
    """
    packed = pack(df, products, [id_col, order_col, *[c for c in carry if c not in (id_col, order_col)]])
    labelled = label_masks(packed, id_col, order_col)
    if inactive:
        labelled = drop_inactive(labelled, id_col)
    rest = [c for c in labelled.columns if c not in ("held", "known", "acquired")]
    return labelled.select(*rest, *unpack(F.col("held"), products, known=F.col("known")), *unpack(F.col("acquired"), products, prefix))


def transition_counts(df: DataFrame, products: Sequence[str], id_col: str = "id", order_col: str = "fetch_date") -> DataFrame:
    """One row: n00, n01, n10, n11 over consecutive rows of a client with both values known, and
    the comparable cells (A08: known cells that are not a client's first of the product)."""
    w = _client(id_col, order_col)
    prev = pack(df, products, [id_col, order_col]).select(
        "held", "known", F.lag("held").over(w).alias("was_held"), F.lag("known").over(w).alias("was_known"),
        F.bit_or("known").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("seen"))
    both = F.col("known").bitwiseAND(F.col("was_known"))
    was, now = F.col("was_held"), F.col("held")
    not_was, not_now = F.bitwise_not(was), F.bitwise_not(now)

    def total(mask: Column) -> Column:
        return F.coalesce(F.sum(F.bit_count(mask).cast("long")), F.lit(0).cast("long"))

    return prev.agg(*[total(both.bitwiseAND(a).bitwiseAND(b)).alias(f"n{x}{y}")
                      for x, a in ((0, not_was), (1, was)) for y, b in ((0, not_now), (1, now))],
                    total(F.col("known").bitwiseAND(F.col("seen"))).alias("comparable_cells"))


def _lanes(mask: Column, n: int) -> list[Column]:
    """Bits of a mask spread to lanes of 20 bits, three in a long, so sums count each product."""
    one = F.lit(1).cast("long")
    return [_or_all([F.shiftleft(F.shiftright(mask, i).bitwiseAND(one), LANE_BITS * k)
                     for k, i in enumerate(range(at, min(n, at + LANES)))]) for at in range(0, n, LANES)]


def _lane(name: str, i: int) -> Column:
    return F.shiftright(F.col(f"{name}{i // LANES}"), LANE_BITS * (i % LANES)).bitwiseAND(F.lit((1 << LANE_BITS) - 1).cast("long"))


def client_masks(df: DataFrame, products: Sequence[str], id_col: str = "id", order_col: str = "fetch_date") -> DataFrame:
    """Per client: total of held flags, ones and known cells of each product in lanes, the first and
    last known value of each product, and the products that are ever / always 1 or ever known."""
    n = len(_checked(products))
    w = _client(id_col, order_col)
    before = F.bit_or("known").over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.bit_or("known").over(w.rowsBetween(1, Window.unboundedFollowing))
    none = F.lit(0).cast("long")
    rows = pack(df, products, [id_col, order_col]).select(
        id_col, "held", "known", F.coalesce(before, none).alias("before"), F.coalesce(after, none).alias("after"))
    held, known = F.col("held"), F.col("known")
    return rows.groupBy(id_col).agg(
        F.sum(F.bit_count(held).cast("long")).alias("total"), F.bit_or(known).alias("any_known"), F.bit_or(held).alias("any_one"),
        F.bit_and(held.bitwiseOR(F.bitwise_not(known))).alias("all_one"),
        F.bit_or(held.bitwiseAND(F.bitwise_not(F.col("before")))).alias("first"),
        F.bit_or(held.bitwiseAND(F.bitwise_not(F.col("after")))).alias("last"),
        *[F.sum(x).alias(f"s{j}") for j, x in enumerate(_lanes(held, n))],
        *[F.sum(x).alias(f"c{j}") for j, x in enumerate(_lanes(known, n))])


def client_summary(df: DataFrame, products: Sequence[str], id_col: str = "id", order_col: str = "fetch_date") -> DataFrame:
    """A03-A07 (the columns of ``profile.client_product_summary``) from one client shuffle."""
    products = _checked(products)
    per = client_masks(df, products, id_col, order_col)
    means = [F.when(_lane("c", i) > 0, _lane("s", i) / _lane("c", i)).otherwise(F.lit(0.0)) for i in range(len(products))]
    mean_sum = means[0]
    for m in means[1:]:
        mean_sum = mean_sum + m
    complete = F.col("any_known") == every(products)
    constant = F.col("any_one").bitwiseAND(F.bitwise_not("all_one")) == 0
    per = per.select("total", mean_sum.alias("mean_sum"), (complete & (F.col("first") == F.col("last"))).alias("same_ends"),
                     (complete & constant).alias("unchanged"))
    return per.agg(
        F.avg("total").alias("mean_periods_held"), F.avg("mean_sum").alias("mean_products"),
        F.avg((F.col("mean_sum") <= 1).cast("double")).alias("share_le_one"), F.avg((F.col("total") == 0).cast("double")).alias("share_never"),
        F.avg(F.col("same_ends").cast("double")).alias("share_same_ends"), F.avg(F.col("unchanged").cast("double")).alias("share_unchanged"))


def totals(df: DataFrame, products: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., product, total), from one aggregation of masks without exploding rows;
    NULL for a product without a known cell."""
    products = _checked(products)
    sums = [F.sum(F.when(bit(F.col("known"), i) == 1, bit(F.col("held"), i))).cast("long").alias(p) for i, p in enumerate(products)]
    wide = pack(df, products, list(by)).groupBy(*by).agg(*sums)
    return wide.unpivot(list(by), products, "product", "total")
