"""Packing along a space-filling curve (operator 7).

1. Each document is encoded; its ids are hashed into a signed bag of ``HASH_DIMS`` counters,
   damped by a square root, scaled to length one and projected to ``CURVE_DIMS`` dimensions
   with a fixed random matrix. The cell of the projection on a Hilbert curve is its key.
2. Documents are range-sorted by (key, doc_id, text hash). Copies share a key and are still
   spread over tasks by the further columns.
3. A running count of ids inside each range plus the totals of the ranges before it gives
   each document its place in one gapless stream along the curve. The stream is cut every
   ``length`` ids: all sequences are full, only the last one is padded.

The ids travel once through the range shuffle, compressed per document. Between the steps
tables are written to the shared scratch folder. One row per range goes through a single
window. Memory of a task: one slice of texts; one document's ids at least.

Cases: null or empty text is the end id alone; repeated rows are packed as often as they
occur; an empty table gives no rows; other columns are ignored. A document longer than a
sequence is cut into several pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm._common import doc_texts, materialise, mix64, slices
from panelkit.llm.tokens import default_tokenizer, encoder

HASH_DIMS = 256
CURVE_DIMS = 4
CURVE_BITS = 12
LENGTH = 4096

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of integer points (n, dims), each below 2**bits.

    The point is brought from axes to the curve's transposed form, from the highest bit
    down, undoing the reflections and exchanges of each level; the bits of all axes are
    then interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            high = (x[d] >> level) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high, low, swap)
            if d:
                x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> level) & 1)
    return key


class CurveKeys:
    """Hilbert keys of documents given by their ids."""

    def __init__(self, seed: int = 7, hash_dims: int = HASH_DIMS, dims: int = CURVE_DIMS,
                 bits: int = CURVE_BITS):
        self.hash_dims, self.bits = hash_dims, bits
        self.matrix = np.random.default_rng(seed).standard_normal((hash_dims, dims))

    def keys(self, docs: list[np.ndarray]) -> np.ndarray:
        bags = np.zeros((len(docs), self.hash_dims))
        for k, ids in enumerate(docs):
            h = mix64(ids)
            sign = 1.0 - 2.0 * ((h >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
            bags[k] = np.bincount((h % np.uint64(self.hash_dims)).astype(np.int64), weights=sign,
                                  minlength=self.hash_dims)
        bags = np.sign(bags) * np.sqrt(np.abs(bags))
        norm = np.sqrt((bags ** 2).sum(axis=1, keepdims=True))
        # a projection of a unit vector is about normal; this maps it evenly onto (0, 1)
        place = 1.0 / (1.0 + np.exp(-1.702 * (bags / np.maximum(norm, 1e-12)) @ self.matrix))
        cells = np.minimum((place * (1 << self.bits)).astype(np.int64), (1 << self.bits) - 1)
        return hilbert_keys(cells, self.bits)


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, length: int = LENGTH,
         id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` ids, with the ids of each piece.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    """
    path = tokenizer or default_tokenizer()

    def encode(batches):
        import zstandard

        enc, curve, zip_ = encoder(path), CurveKeys(seed), zstandard.ZstdCompressor(level=1)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, firsts = enc.encode(part.column("text"))
                own = [np.concatenate((ids[firsts[i]:firsts[i + 1]], end)) for i in range(part.num_rows)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "h": part.column("h"),
                    "curve": curve.keys(own), "n": pa.array(map(len, own), pa.int64()),
                    "ids": pa.array((zip_.compress(x.astype("<u4").tobytes()) for x in own), pa.binary())})

    rows = doc_texts(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    table = "doc_id long, h long, curve long, n long, ids binary"
    encoded = materialise(rows.mapInArrow(encode, table), "packing-ids")

    def place(batches):
        from pyspark import TaskContext

        pid, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            begin = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_pydict({
                "pid": pa.array([pid] * len(n), pa.int32()), "begin": begin,
                "doc_id": batch.column("doc_id"), "n": batch.column("n"), "ids": batch.column("ids")})

    order = [F.col("curve"), F.col("doc_id").asc_nulls_first(), F.col("h")]
    placed = materialise(
        encoded.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(place, "pid int, begin long, doc_id long, n long, ids binary"), "packing-places")
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (placed.groupBy("pid").agg(F.sum("n").alias("n"))  # one row per range
              .select("pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))

    def cut(batches):
        import zstandard

        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids, at, first = unzip.decompress(row["ids"]), row["base"] + row["begin"], 0
                while first < row["n"]:
                    take = min(row["n"] - first, length - (at + first) % length)
                    out.append((row["doc_id"], first, take,
                                zlib.crc32(ids[4 * first:4 * (first + take)]), row["n"],
                                (at + first) // length, (at + first) % length))
                    first += take
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in columns], names=[f.split()[0] for f in PIECES.split(", ")])

    # the table of ranges has one row per task of the range shuffle: bounded by its partitions
    return placed.join(F.broadcast(ranges), "pid").mapInArrow(cut, PIECES)
