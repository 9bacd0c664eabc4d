"""Token files (operator 10): independent zstandard frames with a trailing seek table.

File layout, after the public seekable zstandard format:

* one or more zstandard frames per document, each holding at most ``frame_tokens`` ids as
  little-endian unsigned 32-bit integers;
* a skippable frame with the document table (doc_id, null flag, number of ids);
* a skippable frame with the seek table: compressed size, decompressed size and the low 32
  bits of XXH64 of the decompressed bytes for every frame, then the frame count, a
  descriptor byte and the magic number.

A reader fetches the tail, then only the frames of the documents it wants, and checks each
frame against its checksum.

Write: documents are range-partitioned and sorted by ``doc_id`` (null first; equal ids by a
hash of the text, so that one repeated id still spreads), every task streams its range into
one file under a name of its own and reports it in a manifest that Spark commits. A task run
again writes another file; only files in the manifest count. Memory of a task: one slice of
text and a few numbers per document.

Cases: null or empty text gives the end id alone; repeated rows are written as often as they
occur; an empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm._common import doc_texts, filesystem, join, materialise, output_folder, slices
from panelkit.llm.tokens import default_tokenizer, encoder

# Fixed values of the public seekable zstandard format.
SKIPPABLE_DOCS = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_TOKENS = 1 << 16
MANIFEST = "pid int, path string, n_docs long, n_tokens long, n_bytes long"


class TokenFileWriter:
    """Streams documents into one file; ``sink`` is any object with ``write``."""

    def __init__(self, sink, level: int = 1, frame_tokens: int = FRAME_TOKENS):
        import zstandard

        self.sink, self.frame_tokens = sink, frame_tokens
        self.zip = zstandard.ZstdCompressor(level=level)
        self.frames: list[bytes] = []
        self.doc_ids, self.nulls, self.sizes = [], [], []
        self.n_bytes = 0

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.n_bytes += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        import xxhash

        for at in range(0, max(len(ids), 1), self.frame_tokens):
            raw = ids[at:at + self.frame_tokens].astype("<u4").tobytes()
            packed = self.zip.compress(raw)
            self.frames.append(struct.pack("<III", len(packed), len(raw),
                                           xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self._put(packed)
        self.doc_ids.append(0 if doc_id is None else doc_id)
        self.nulls.append(doc_id is None)
        self.sizes.append(len(ids))

    def close(self) -> None:
        body = struct.pack("<QI", len(self.doc_ids), self.frame_tokens)
        body += np.array(self.doc_ids, "<i8").tobytes() + np.array(self.nulls, "u1").tobytes()
        body += np.array(self.sizes, "<u8").tobytes()
        self._put(struct.pack("<II", SKIPPABLE_DOCS, len(body)) + body)
        entries = b"".join(self.frames) + struct.pack("<III", len(body) + 8, 0, 0)
        foot = struct.pack("<IBI", len(self.frames) + 1, CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self._put(struct.pack("<II", SKIPPABLE_SEEK, len(entries) + len(foot)) + entries + foot)


class TokenFileReader:
    """Random access to one token file; ``source`` is seekable and has ``read``."""

    def __init__(self, source, size: int):
        import zstandard

        self.source, self.unzip = source, zstandard.ZstdDecompressor()
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("no seek table")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.packed, self.raw, self.sums = table[:, 0], table[:, 1], table[:, 2]
        self.begin = np.cumsum(self.packed) - self.packed
        body = self._at(int(self.begin[-1]) + 8, int(self.packed[-1]) - 8)
        count, self.frame_tokens = struct.unpack("<QI", body[:12])
        at = 12 + 8 * count
        ids, nulls = np.frombuffer(body[12:at], "<i8"), np.frombuffer(body[at:at + count], "u1")
        self.sizes = np.frombuffer(body[at + count:], "<u8").astype(np.int64)
        self.doc_ids = [None if z else int(i) for i, z in zip(ids, nulls)]
        per_doc = np.maximum(1, -(-self.sizes // self.frame_tokens))
        self.first_frame = np.cumsum(per_doc) - per_doc
        self.n_frames = per_doc

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def frame(self, k: int) -> bytes:
        import xxhash

        raw = self.unzip.decompress(self._at(int(self.begin[k]), int(self.packed[k])),
                                    max_output_size=int(self.raw[k]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"checksum of frame {k} differs")
        return raw

    def frames_of(self, doc: int):
        """The decompressed frames of the document at one position of the file."""
        for k in range(int(self.first_frame[doc]), int(self.first_frame[doc] + self.n_frames[doc])):
            yield self.frame(k)

    def ids(self, doc: int) -> np.ndarray:
        return np.frombuffer(b"".join(self.frames_of(doc)), "<u4")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 1,
                      id_col: str = "doc_id", text_col: str = "text", level: int = 1,
                      frame_tokens: int = FRAME_TOKENS) -> DataFrame:
    """Encode every document and write its ids; returns the committed manifest of files."""
    path = tokenizer or default_tokenizer()
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = doc_texts(docs, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        enc, out = encoder(path), None
        for batch in batches:
            for part in slices(batch, "text"):
                if out is None:
                    name = join(folder, f"tokens-{pid:06d}-{uuid.uuid4().hex}.zst")
                    system, local = filesystem(name)
                    sink = system.open_output_stream(local, compression=None, buffer_size=1 << 20)
                    out = TokenFileWriter(sink, level, frame_tokens)
                ids, firsts = enc.encode(part.column("text"))
                for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    out.add(doc_id, np.append(ids[firsts[i]:firsts[i + 1]], np.uint32(end_id)))
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({
                "pid": pa.array([pid], pa.int32()), "path": [name], "n_docs": [len(out.sizes)],
                "n_tokens": [int(sum(out.sizes))], "n_bytes": [out.n_bytes]})

    return materialise(rows.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document read back: doc_id, start, n_tokens, ids_crc32, path, position.

    ``start`` counts the ids of all documents before it in the whole set of files.
    """
    n_files = manifest.count()
    base = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("pid", "path", "n_bytes", F.coalesce(F.sum("n_tokens").over(base),
                                                                 F.lit(0)).alias("base"))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, local = filesystem(row["path"])
                with system.open_input_file(local) as source:
                    got = TokenFileReader(source, row["n_bytes"])
                    sums, counts = [], []
                    for k in range(len(got.sizes)):
                        crc = n = 0
                        for raw in got.frames_of(k):
                            crc, n = zlib.crc32(raw, crc), n + len(raw) // 4
                        sums.append(crc)
                        counts.append(n)
                counts = np.array(counts, np.int64)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(got.doc_ids, pa.int64()),
                    "start": row["base"] + np.cumsum(counts) - counts, "n_tokens": counts,
                    "ids_crc32": pa.array(sums, pa.int64()), "path": [row["path"]] * len(counts),
                    "position": pa.array(range(len(counts)), pa.int32())})

    return files.repartition(max(1, n_files), "pid").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, path string, position int")


def token_files(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files into a new shared folder and read every document back."""
    folder = output_folder(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id, id_col, text_col))
