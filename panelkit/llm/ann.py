"""Approximate nearest neighbours (operator 8): multiprobe p-stable hashing.

Each of ``TABLES`` tables hashes a vector with M functions floor((a.x + b) / W), a Gaussian
and b uniform. A neighbour at distance r lies in each cell beside the query's own with a
probability that a, b and r give; a query visits the cells of a table from the most to the
least probable one until their probabilities add up to what the wanted success needs per
table. The rows of the visited cells are ranked by their exact distance, ten per cell are
kept, and the cells and tables are merged. A query with fewer than ``k`` found visits all rows.

Fit: r is the 0.9 quantile of the k-th nearest distance inside a sample of ``SAMPLE`` rows
(those with the smallest hashes of their ids), W a multiple of r, and M follows the number
of rows so that cells keep about ``CELL_ROWS`` rows. Only the sample reaches the driver. All
rows are indexed. Distances in a sample are larger than in the table, so the estimate errs
to more probes.

Scale: a row is shuffled once per table. Cells with more than ``MAX_CELL`` rows are split
into parts of that size, and a probe visits all parts, each in its own round. The queries that
visit a part, or that visit all rows, are dealt to blocks of about ``MAX_ASKED``, so each task
holds one part and one block; nothing is capped.

Cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do
those of another length than most; of rows that repeat a query's id, the smallest vector asks,
and none of them is a candidate of it; other repeated rows count once by id with their nearest
vector; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm._common import materialise, mix64

TABLES = 4
SUCCESS = 0.96
SAMPLE = 4096
CELL_ROWS = 128
MAX_CELL = 2048
MAX_ASKED = 1024
START_ROWS = 1024
GROWTH = 16
WIDTH = 1.8


class PStableTables:
    """Hash functions of all tables and the probing order of a query."""

    def __init__(self, dims: int, functions: int, width: float, radius: float, tables: int = TABLES,
                 success: float = SUCCESS, seed: int = 5):
        own = np.random.default_rng(seed)
        self.a = own.standard_normal((tables, functions, dims))
        self.b = own.random((tables, functions)) * width
        self.width, self.radius = width, radius
        self.per_table = 1.0 - (1.0 - success) ** (1.0 / tables)

    def places(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells (n, tables, functions) and the place inside each, from 0 to 1."""
        x = (np.einsum("nd,tmd->ntm", vectors, self.a) + self.b) / self.width
        cells = np.floor(x)
        return cells.astype(np.int64), x - cells

    @staticmethod
    def keys(cells: np.ndarray) -> np.ndarray:
        """One 64-bit key for each row of cells."""
        out = np.zeros(cells.shape[:-1], np.uint64)
        with np.errstate(over="ignore"):
            for k in range(cells.shape[-1]):
                out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + cells[..., k].astype(np.uint64))
        return out.astype(np.int64)

    def probes(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Moves of one table and their estimated success, best first, up to the wanted sum."""
        options = []
        for x in inside.tolist():
            edge = [0.5 * math.erf((d - x) * self.width / (self.radius * math.sqrt(2.0))) for d in range(-3, 5)]
            options.append(sorted(((edge[k + 1] - edge[k], k - 3) for k in range(7)), reverse=True))
        first = (0,) * len(options)
        heap = [(-math.prod(o[0][0] for o in options), first)]
        seen, total, out, success = {first}, 0.0, [], []
        while heap and total < self.per_table:
            p, at = heapq.heappop(heap)
            total -= p
            out.append([options[k][j][1] for k, j in enumerate(at)])
            success.append(-p)
            for k, j in enumerate(at):
                if j < 6 and options[k][j + 1][0] > 1e-9:
                    to = at[:k] + (j + 1,) + at[k + 1:]
                    if to not in seen:
                        seen.add(to)
                        heapq.heappush(heap, (p / options[k][j][0] * options[k][j + 1][0], to))
        return np.array(out, np.int64), np.array(success)


def nearest_in(rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """(query position, row position, distance) of the k nearest rows of each query."""
    step = max(1, (1 << 21) // max(1, rows.size))
    for low in range(0, len(queries), step):
        part = queries[low:low + step]
        d = np.sqrt(((rows[None, :, :] - part[:, None, :]) ** 2).sum(axis=2))
        for q in range(len(part)):
            some = np.flatnonzero(ids != query_ids[low + q])
            own = d[q, some]
            if len(some) > k:
                edge = np.partition(own, k - 1)[k - 1]
                some = some[own <= edge]
                own = d[q, some]
            order = np.lexsort((ids[some], own))[:k]
            yield low + q, some[order], own[order]


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as doubles."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                          F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad)
                      & F.exists("v", lambda x: x != 0))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def fit(rows: DataFrame, n_rows: int, k: int, dims: int, seed: int = 5, success: float = SUCCESS) -> PStableTables:
    """Radius and width from a sample of SAMPLE rows, functions from the number of rows."""
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(SAMPLE).collect()
    x = np.array([r.v for r in sample])
    some = x[:min(len(x), 256)]
    d = np.sqrt(np.maximum((some ** 2).sum(1)[:, None] + (x ** 2).sum(1) - 2 * some @ x.T, 0))
    d.sort(axis=1)
    radius = float(np.quantile(d[:, min(k, len(x) - 1)], 0.9)) or float(np.linalg.norm(x, axis=1).max()) * 1e-3
    functions = max(2, round(math.log(max(n_rows, 1) / CELL_ROWS + 1) / math.log(2.9)))
    return PStableTables(dims, functions, WIDTH * radius, radius, seed=seed, success=success)


def search(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           seed: int = 5, success: float = SUCCESS) -> DataFrame:
    """The k nearest rows found of each query row: query_id, rank, vec_id, score (distance).

    ``is_query`` is a condition on the column ``vec_id``.
    """
    spark = vectors.sparkSession
    empty = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, id_col, vec_col)
    common = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").limit(1).collect()
    if not common:
        return spark.createDataFrame([], empty)
    dims, n_rows = common[0]["dims"], common[0]["count"]
    rows = materialise(rows.where(F.size("v") == dims), "ann-rows")
    tables = fit(rows, n_rows, k, dims, seed, success)
    n_tables = len(tables.b)

    def index(batches):
        for batch in batches:
            keys = tables.keys(tables.places(_matrix(batch.column("v")))[0])
            for t in range(n_tables):
                yield pa.RecordBatch.from_pydict({"t": pa.array([t] * len(keys), pa.int32()), "cell": keys[:, t],
                                                  "vec_id": batch.column("vec_id"), "v": batch.column("v")})

    indexed = materialise(rows.mapInArrow(index, "t int, cell long, vec_id long, v array<double>"), "ann-index")
    asking = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))

    def probe(batches):
        for batch in batches:
            x = _matrix(batch.column("v"))
            cells, inside = tables.places(x)
            for q in range(len(x)):
                for t in range(n_tables):
                    moves, success = tables.probes(inside[q, t])
                    keys, first = np.unique(tables.keys(cells[q, t] + moves), return_index=True)
                    yield pa.RecordBatch.from_pydict({
                        "t": pa.array([t] * len(keys), pa.int32()), "cell": keys, "success": success[first],
                        "query_id": pa.array([batch.column("vec_id")[q].as_py()] * len(keys), pa.int64())})

    sizes = indexed.groupBy("t", "cell").count().withColumn("parts", F.ceil(F.col("count") / MAX_CELL).cast("int"))
    sizes = materialise(sizes, "ann-cells")
    placed = indexed.join(sizes.drop("count"), ["t", "cell"])
    placed = materialise(placed.select("t", "cell", _dealt("vec_id", F.col("parts")).alias("part"), "vec_id", "v"), "ann-placed")
    visits = asking.mapInArrow(probe, "t int, cell long, success double, query_id long").join(sizes, ["t", "cell"])
    visits = visits.withColumn("part", _all("parts")).withColumn("rows", F.col("count") / F.col("parts"))
    # rows that the more probable visits of the query have seen
    before = Window.partitionBy("query_id").orderBy(F.desc("success"), "t", "cell", "part").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.sum("rows").over(before), F.lit(0.0)) / START_ROWS
    step = F.when(seen < 1, 0).otherwise(1 + F.floor(F.log(seen) / math.log(GROWTH))).cast("int")
    visits = materialise(visits.select("t", "cell", "part", "query_id", step.alias("round")), "ann-visits")
    asked = asking.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    found = spark.createDataFrame([], empty)
    key = ["t", "cell", "part", "block"]
    # a handful of rounds: the logarithm of the rows visited
    for step in sorted(r["round"] for r in visits.select("round").distinct().collect()):
        now = visits.where(F.col("round") == step).drop("round")
        # parts that no query visits are not needed
        parts = now.groupBy("t", "cell", "part").count()
        parts = materialise(parts.select("t", "cell", "part", F.ceil(F.col("count") / MAX_ASKED).cast("int").alias("blocks")), "ann-visited")
        stored = placed.join(parts, ["t", "cell", "part"])
        stored = stored.select("t", "cell", "part", _all("blocks").alias("block"), "vec_id", "v")
        now = now.join(parts, ["t", "cell", "part"])
        now = now.select("t", "cell", "part", _dealt("query_id", F.col("blocks")).alias("block"), "query_id")
        last = found.where(F.col("rank") == k).select("query_id", F.col("score").alias("edge"), F.col("vec_id").alias("edge_id"))
        now = now.join(asked.join(last, "query_id", "left"), "query_id")
        found = materialise(_merge(found.drop("rank").unionByName(_ranked(stored, now, key, k)), k), "ann-found")

    # queries with fewer than k found visit all rows, in parts
    few = asked.join(found.groupBy("query_id").count(), "query_id", "left")
    few = materialise(few.where(F.coalesce("count", F.lit(0)) < min(k, n_rows - 1)).select("query_id", "q"), "ann-few")
    n_few = few.count()
    if not n_few:
        return found
    over = {"parts": F.lit(-(-n_rows // MAX_CELL)), "blocks": F.lit(-(-n_few // MAX_ASKED))}
    stored = rows.withColumns(over).select(_dealt("vec_id", F.col("parts")).alias("part"), _all("blocks").alias("block"), "vec_id", "v")
    rest = few.withColumns(over).select(_all("parts").alias("part"), _dealt("query_id", F.col("blocks")).alias("block"), "query_id", "q",
                                        F.lit(None).cast("double").alias("edge"), F.lit(None).cast("long").alias("edge_id"))
    rest = _merge(_ranked(stored, rest, ["part", "block"], k), k)
    return found.join(few.select("query_id"), "query_id", "left_anti").unionByName(rest)


def _dealt(id_col: str, n):
    return F.pmod(F.xxhash64(id_col), n).cast("int")


def _all(n: str):
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def _ranked(stored: DataFrame, visits: DataFrame, key: list[str], k: int) -> DataFrame:
    """The k nearest rows of each visit; only those before the row (edge, edge_id) where one is given."""
    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        q_at, ids, d = [], [], []
        if left.num_rows and right.num_rows:
            own = left.column("vec_id").to_numpy()
            asks = right.column("query_id").to_numpy()
            edge = right.column("edge").fill_null(float("inf")).to_numpy()
            edge_id = right.column("edge_id").fill_null(0).to_numpy()
            for q, at, dist in nearest_in(_matrix(left.column("v")), own, _matrix(right.column("q")), asks, k):
                better = (dist < edge[q]) | ((dist == edge[q]) & (own[at] < edge_id[q]))
                at, dist = at[better], dist[better]
                q_at.append(np.full(len(at), asks[q]))
                ids.append(own[at])
                d.append(dist)
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        return pa.table({"query_id": cat(q_at, np.int64), "vec_id": cat(ids, np.int64), "score": cat(d, np.float64)})

    return stored.groupBy(*key).cogroup(visits.groupBy(*key)).applyInArrow(
        rank, "query_id long, vec_id long, score double")


def _merge(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
