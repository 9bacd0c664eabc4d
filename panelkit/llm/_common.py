"""Helpers shared by the training-data operators.

Scratch tables always go to the folder named in ``spark.checkpoint.dir``; that cuts
lineage with a written table, so a lost executor costs one re-run task and not the
whole chain. Nothing here keeps state on a machine-local folder.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import scratch_dir

#: Text bytes handled at once inside a task; one longer text is handled alone.
SLICE_BYTES = 2 << 20
#: Bytes of a batch between Spark and a Python worker, where the session sets no limit of its own. Spark's
#: own limit (64 MB) is held several times over, in the JVM's buffers and in Python, for each task.
ARROW_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed (tests, local runs)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    small_batches(spark)


def small_batches(spark: SparkSession) -> None:
    """Batches of at most ``ARROW_BATCH`` bytes (and one row more) to the Python workers."""
    key, limit = ARROW_BATCH
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, limit)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def doc_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only (doc_id, text), so further columns of any name cannot clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Parts of a batch whose ``column`` holds about ``limit`` bytes each (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at, base = 0, 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, stop - at)
        base, at = int(ends[stop - 1]), stop


def strings(column: pa.Array) -> pa.Array:
    """The column as large strings with null as empty text, in buffers of its own: some Arrow
    functions (``ascii_lower``) read past a slice."""
    if column.offset:
        column = column.take(pa.array(np.arange(len(column))))
    return pc.fill_null(column.cast(pa.large_string()), "")


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts in a row, and the number in each text."""
    parts = pc.ascii_split_whitespace(texts)
    words = parts.flatten()
    owner = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        words, owner = words.filter(pa.array(full)), owner[full]
    return words, np.bincount(owner, minlength=len(texts)).astype(np.int64)


def coded(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct values of an array and the code of each entry."""
    d = values.dictionary_encode()
    return d.dictionary, d.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Exclusive prefix sums with the total at the end."""
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def gather(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the concatenated runs [start, start + len)."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lens), lens) + np.arange(total, dtype=np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads the bits of each value."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def delta_bytes(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as the distances between them, the bytes of one order in a row: the
    high ones are zeros, which the shuffle compresses."""
    return np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_delta_bytes(raw: bytes) -> np.ndarray:
    far = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(far, dtype=np.uint64)


def filesystem(uri: str):
    """Arrow file system and path of a URI that every executor can open."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = uri[len("file:"):]
        uri = "/" + uri.lstrip("/")
    return fs.FileSystem.from_uri(uri)


def output_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared scratch folder for files written by tasks."""
    path = scratch_dir(spark, name)
    system, local = filesystem(path)
    system.create_dir(local, recursive=True)
    return path


def join(folder: str, name: str) -> str:
    return os.path.join(folder, name)


def few_rows(df: DataFrame, limit: int) -> bool:
    """Whether a table has at most ``limit`` rows; the size check before a broadcast."""
    return df.limit(limit + 1).count() <= limit


def wanted_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
