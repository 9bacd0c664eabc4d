"""Mixing sources to target weights (operator 3): Efraimidis-Spirakis sampling.

Every document gets the key -ln(u) / w: u in (0, 1) from a hash of its id and text, w its
quality weight. A source gives floor(target / size) complete epochs of all its documents;
what is left of its target is a fraction of an epoch: its documents in ascending order of
the key as long as their prefix sum of words stays within the rest, and then the one
document of the others whose size comes nearest to the words still missing, if taking it
brings the source nearer.

Targets: the sources, sorted by code point with null last, weigh 1, 2, 3, 1, 2, 3, ... and
share the mix; no target goes beyond ``max_epochs`` times its source's size, and the excess
is shared again by weight among the others until none is above.

Prefix sums run in two steps: each source is cut into key ranges, about equally full, in
numbers that follow the number of rows; sums per range, then a window inside each range.
A source with a third of all rows is many ranges. Only tables with one row per source or
range pass one window group; source totals go to the driver (one row per source).

Cases: null or empty text has size 0, and its ``taken`` is 0; a source whose documents
are all empty has target 0; an empty table gives no rows; repeated rows are drawn like
others (ties end by the hash of the text; equal rows are interchangeable); extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm._common import materialise, slices, strings

WEIGHTS = (1.0, 2.0, 3.0)
MAX_EPOCHS = 3
#: Rows of one key range, about; and the least number of ranges of a source.
RANGE_ROWS = 20_000
LEAST_RANGES = 128

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def sizes_and_weights(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and its quality weight: the share of letter bytes among the
    bytes that are no white space, from 0.05 to 1."""
    texts = strings(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    at = offsets - offsets[0]
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    inner = at[:-1][(at[:-1] < len(data))]
    first[inner] = ~space[inner]

    def per_text(flags):
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[at[1:]] - sums[at[:-1]]

    words, full, letters = per_text(first), per_text(~space), per_text(_ALPHA[data])
    return words, np.maximum(0.05, letters / np.maximum(full, 1))


def share_targets(sizes: list[int], weights: list[float], max_epochs: float = MAX_EPOCHS,
                  total: float | None = None) -> list[float]:
    """Targets by weight, capped at ``max_epochs`` times the size, the excess reshared."""
    total = float(sum(sizes)) if total is None else float(total)
    caps = [max_epochs * float(s) for s in sizes]
    target, open_, left = [0.0] * len(sizes), list(range(len(sizes))), total
    while open_:
        share = left / sum(weights[k] for k in open_)
        above = [k for k in open_ if share * weights[k] > caps[k]]
        if not above:
            for k in open_:
                target[k] = share * weights[k]
            break
        for k in above:
            target[k] = caps[k]
            left -= caps[k]
        open_ = [k for k in open_ if k not in above]
    return target


def draw(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS,
         seed: int = 13, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """The draw: one row per document with how often the mix takes it.

    Columns: doc_id, text_hash, source, size, quality, key, source_size, target, copies,
    taken.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.col(f"`{source_col}`").cast("string").alias("source"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))

    def measure(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words, quality = sizes_and_weights(part.column("text"))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "text_hash": part.column("text_hash"),
                    "source": part.column("source"), "size": words, "quality": quality})

    measured = rows.mapInArrow(measure, "doc_id long, text_hash long, source string, size long, quality double")
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash", F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    measured = materialise(measured.withColumn("key", -F.log(u) / F.col("quality")), "mixing-sizes")

    # one row per source: sizes of the sources, their weights and targets
    sources = sorted(measured.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect(),
                     key=lambda r: (r.source is None, (r.source or "").encode()))
    if not sources:
        return measured.select("*", F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"),
                               F.lit(0).cast("long").alias("copies"), F.lit(0).cast("long").alias("taken"))
    targets = share_targets([r["size"] for r in sources],
                            [weights[k % len(weights)] for k in range(len(sources))], max_epochs)
    plan = spark.createDataFrame(
        [(r.source, r["size"], t, int(t // r["size"]) if r["size"] else 0,
          max(LEAST_RANGES, -(-r.n // RANGE_ROWS))) for r, t in zip(sources, targets)],
        "source string, source_size long, target double, epochs long, ranges int")
    plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))

    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    plan = plan.withColumnRenamed("source", "of")
    # the plan has one row per source, the groups of the collect above
    keyed = measured.join(F.broadcast(plan), same("source", "of")).drop("of")
    # 1 - exp(-key) runs over (0, 1) in the order of the keys, about evenly for weights near one
    keyed = keyed.withColumn("part", F.floor((1 - F.exp(-F.col("key"))) * F.col("ranges")).cast("int"))
    sums = keyed.groupBy("source", "part").agg(F.sum("size").alias("in_part"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("of"), F.col("part").alias("of_part"),
                       F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("base"))
    inside = (Window.partitionBy("source", "part").orderBy("key", "doc_id", "text_hash", "size")
              .rowsBetween(Window.unboundedPreceding, 0))
    keyed = keyed.withColumn("inside", F.sum("size").over(inside))
    keyed = keyed.join(sums, same("source", "of") & (F.col("part") == F.col("of_part"))).drop("of", "of_part")
    drawn = keyed.withColumn("upto", F.col("base") + F.col("inside"))
    drawn = drawn.withColumn("in_rest", (F.col("upto") <= F.col("rest")) & (F.col("size") > 0))
    drawn = materialise(drawn.drop("inside", "base", "ranges"), "mixing-drawn")

    # the closing document: of those left out, the one nearest to the words still missing
    got = drawn.groupBy("source").agg(F.sum(F.when(F.col("in_rest"), F.col("size")).otherwise(0)).alias("got"),
                                      F.first("rest").alias("rest"))
    gap = got.select(F.col("source").alias("of"), (F.col("rest") - F.col("got")).alias("gap"))
    left = drawn.where(~F.col("in_rest") & (F.col("size") > 0)).join(F.broadcast(gap), same("source", "of"))
    left = left.where(F.abs(F.col("gap") - F.col("size")) < F.col("gap"))
    closing = left.groupBy("source").agg(F.min(F.struct(
        F.abs(F.col("gap") - F.col("size")).alias("miss"), "key", "doc_id", "text_hash", "size")).alias("c"))
    closing = closing.select(F.col("source").alias("of"), F.col("c.key").alias("c_key"),
                             F.col("c.doc_id").alias("c_id"), F.col("c.text_hash").alias("c_hash"))
    out = drawn.join(F.broadcast(closing), same("source", "of"), "left").drop("of")  # one row per source
    closes = (F.col("key") == F.col("c_key")) & F.col("doc_id").eqNullSafe(F.col("c_id")) & \
        (F.col("text_hash") == F.col("c_hash"))
    # of repeated equal rows at the end of the draw at most one closes it
    one = Window.partitionBy("source", "part", "key", "doc_id", "text_hash").orderBy("size")
    out = out.withColumn("nth", F.when(closes & ~F.col("in_rest"), F.row_number().over(one)))
    first = F.min("nth").over(Window.partitionBy("source", "part", "key", "doc_id", "text_hash"))
    out = out.withColumn("more", F.when(F.col("in_rest"), 1).when(F.col("nth") == first, 1).otherwise(0))
    out = out.withColumn("copies", F.when(F.col("size") > 0, F.col("epochs") + F.col("more")).otherwise(0).cast("long"))
    return out.select("doc_id", "text_hash", "source", "size", "quality", "key", "source_size", "target",
                      "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the draw takes it."""
    ids, texts = options.get("id_col", "doc_id"), options.get("text_col", "text")
    times = draw(docs, **options).groupBy("doc_id", "text_hash", "source").agg(
        F.max("copies").alias("_hi"), F.sum("copies").alias("_all"), F.count("*").alias("_rows"))
    times = times.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
                         F.col("source").alias("_source"), "_all", "_rows")
    source = options.get("source_col", "source")
    joined = docs.join(times, F.col(f"`{ids}`").cast("long").eqNullSafe(F.col("_id"))
                       & F.xxhash64(F.col(f"`{texts}`").cast("string")).eqNullSafe(F.col("_hash"))
                       & F.col(f"`{source}`").cast("string").eqNullSafe(F.col("_source")))
    # equal rows share the copies drawn for them; the first of them take one more
    same = Window.partitionBy("_id", "_hash", "_source").orderBy("_all")
    joined = joined.withColumn("_nth", F.row_number().over(same))
    joined = joined.withColumn("_n", F.floor(F.col("_all") / F.col("_rows"))
                               + F.when(F.col("_nth") <= F.col("_all") % F.col("_rows"), 1).otherwise(0))
    joined = joined.where(F.col("_n") > 0).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
