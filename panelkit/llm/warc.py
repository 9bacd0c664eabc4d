"""WARC writing and reading over a chunked record table (operator 4).

1. ``chunk_table``: every page's payload (its html in UTF-8) becomes rows (record, chunk
   number, data) of at most ``chunk_bytes``; each row carries the digest of the payload up
   to its end, so the last row has the payload's SHA-256.
2. Of equal payloads of at least ``least_bytes`` the smallest page_id is the response, the
   others revisit it; the table of digests is pre-aggregated before its shuffle.
3. ``write_archives``: the chunks of a record meet in one task, in order, and are streamed
   into a gzip member; no task holds a whole payload. A row before the first chunk brings the
   headers, so chunks are shuffled once and never joined.
   Every task writes one file of its own name; a manifest committed by Spark lists the
   files that count, so a task run again does no harm.
4. ``read_archives``: each file is read member by member in blocks; digests and lengths are
   recomputed from the payload bytes and held against the headers.

Cases: null html is an empty payload; null page_id is written as ``null``, comes after all
ids when the response is chosen, and revisits of null are not made (all such rows are
responses); rows that repeat the smallest page_id of a group are all responses; a null url
gives no target header, control characters in it are percent-encoded; an empty table gives
an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm._common import filesystem, join, materialise, output_folder

CHUNK_BYTES = 256 << 10
LEAST_REVISIT_BYTES = 100
#: Payload bytes of one archive file, about.
FILE_BYTES = 128 << 20

# Fixed values of the public WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = ("page_id long, url string, record long, chunk_no int, last boolean, data binary, "
          "upto_bytes long, upto_digest string")
MANIFEST = "path string, n_records long, n_bytes long"


def chunk_table(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, id_col: str = "page_id",
                url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(record, chunk_no) rows of all payloads with running length and digest."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                        F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("binary"), F.lit(b"")).alias("html"),
                        F.monotonically_increasing_id().alias("record"))

    def cut(batches):
        names = [f.split()[0] for f in CHUNKS.split(", ")]
        for batch in batches:
            out, held = [], 0
            for k in range(batch.num_rows):
                payload = memoryview(batch.column("html")[k].as_buffer())
                head = tuple(batch.column(c)[k].as_py() for c in ("page_id", "url", "record"))
                digest, n = hashlib.sha256(), len(payload)
                for no, at in enumerate(range(0, max(n, 1), chunk_bytes)):
                    data = bytes(payload[at:at + chunk_bytes])
                    digest.update(data)
                    end = at + len(data)
                    out.append((*head, no, end == n, data, end, digest.copy().hexdigest()))
                    held += len(data)
                    if held > (4 << 20):
                        yield _chunks(out, names)
                        out, held = [], 0
            if out:
                yield _chunks(out, names)

    return rows.mapInArrow(cut, CHUNKS)


def _chunks(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def record_types(chunks: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Per record: page_id, url, payload_bytes, payload_digest, record_type and refers_to."""
    whole = chunks.where("last").select("record", "page_id", "url", F.col("upto_bytes").alias("payload_bytes"),
                                        F.col("upto_digest").alias("payload_digest"))
    groups = (whole.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest")
              .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
              .select(F.col("payload_digest").alias("digest"), "first_id"))
    typed = whole.join(groups, F.col("payload_digest") == F.col("digest"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return typed.select("record", "page_id", "url", "payload_bytes", "payload_digest",
                        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                        F.when(revisit, F.col("first_id")).alias("refers_to"))


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record_head(row: dict, date: str) -> bytes:
    """The WARC and HTTP headers of a record, without the payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            + f"Content-Length: {row['payload_bytes']}\r\n\r\n".encode())
    full = row["record_type"] == "response"
    lines = [VERSION, f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_uri(row['page_id'])}",
             f"WARC-Date: {date}"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"]))
    if not full:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_uri(row['refers_to'])}"]
    lines += [f"WARC-Payload-Digest: sha256:{row['payload_digest']}", "Content-Type: application/http;msgtype=response",
              f"Content-Length: {len(http) + (row['payload_bytes'] if full else 0)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z",
                   chunk_bytes: int = CHUNK_BYTES, least_bytes: int = LEAST_REVISIT_BYTES,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   level: int = 1) -> DataFrame:
    """Write one WARC record per page; returns the committed manifest of archive files."""
    chunks = materialise(chunk_table(pages, chunk_bytes, id_col, url_col, html_col), "warc-chunks")
    # one shuffle: the head of a record comes as row -1 before its chunks
    heads = record_types(chunks, least_bytes)
    head = F.struct("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    heads = heads.select("record", F.lit(-1).alias("chunk_no"), F.lit(False).alias("last"),
                         F.lit(None).cast("binary").alias("data"), head.alias("head"))
    rows = chunks.select("record", "chunk_no", "last", "data", F.lit(None).cast(heads.schema["head"].dataType).alias("head"))
    rows = rows.unionByName(heads)
    total = chunks.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    n_files = max(int(total // FILE_BYTES) + 1, chunks.rdd.getNumPartitions())
    rows = rows.repartition(n_files, "record").sortWithinPartitions("record", "chunk_no")

    def write(batches):
        sink, n_bytes, n_records, zip_, full = None, 0, 0, None, False
        for batch in batches:
            numbers, lasts = batch.column("chunk_no").to_pylist(), batch.column("last").to_pylist()
            for k in range(batch.num_rows):
                if sink is None:
                    name = join(folder, f"part-{uuid.uuid4().hex}.warc.gz")
                    system, local = filesystem(name)
                    sink = system.open_output_stream(local, compression=None, buffer_size=1 << 20)
                pieces = []
                if numbers[k] == -1:
                    row = batch.column("head")[k].as_py()
                    full, zip_ = row["record_type"] == "response", zlib.compressobj(level, zlib.DEFLATED, 31)
                    pieces.append(zip_.compress(record_head(row, date)))
                elif full:
                    pieces.append(zip_.compress(batch.column("data")[k].as_buffer()))
                if lasts[k]:
                    pieces.append(zip_.compress(b"\r\n\r\n") + zip_.flush())
                    n_records += 1
                for data in pieces:
                    sink.write(data)
                    n_bytes += len(data)
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "n_records": [n_records], "n_bytes": [n_bytes]})

    return materialise(rows.mapInArrow(write, MANIFEST), "warc-manifest")


class _Block:
    """Bytes of a gzip-member file, decompressed block by block."""

    def __init__(self, source, block: int = 256 << 10):
        self.source, self.block, self.raw, self.data, self.unzip = source, block, b"", b"", None

    def more(self) -> bool:
        """Fetch further bytes into ``data``; False at the end of the file."""
        while True:
            if not self.raw:
                self.raw = self.source.read(self.block)
                if not self.raw:
                    return False
            if self.unzip is None or self.unzip.eof:
                self.unzip = zlib.decompressobj(31)
            got = self.unzip.decompress(self.raw, self.block)
            self.raw = self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail
            if got:
                self.data += got
                return True

    def head(self) -> bytes | None:
        """Up to and with the next empty line; None at the end of the file."""
        while (at := self.data.find(b"\r\n\r\n")) < 0:
            if not self.more():
                return None
        out, self.data = self.data[:at + 4], self.data[at + 4:]
        return out

    def take(self, n: int):
        """The next ``n`` bytes, in parts."""
        while n:
            if not self.data and not self.more():
                raise ValueError("archive ends inside a record")
            part, self.data = self.data[:n], self.data[n:]
            n -= len(part)
            yield part


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return dict(x.split(": ", 1) for x in lines[1:] if ": " in x)


def records(source):
    """Records of one archive: (headers, payload length, SHA-256, bytes of the payload read)."""
    file = _Block(source)
    while (head := file.head()) is not None:
        fields = _fields(head)
        http = file.head()
        payload = _fields(http).get("Content-Length")
        digest, n = hashlib.sha256(), 0
        for part in file.take(int(fields["Content-Length"]) - len(http)):
            digest.update(part)
            n += len(part)
        for _ in file.take(4):
            pass
        named = fields["WARC-Payload-Digest"].split(":", 1)[1]
        if fields["WARC-Type"] == "response" and (digest.hexdigest() != named or n != int(payload)):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its headers")
        yield fields, int(payload), named, n


def _page(uri: str | None) -> int | None:
    text = None if uri is None else uri[len("<urn:page:"):-1]
    return None if text in (None, "null") else int(text)


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, url, path."""
    n_files = manifest.count()

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, local = filesystem(path)
                out = {k: [] for k in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")}
                with system.open_input_stream(local, compression=None) as source:
                    for fields, size, digest, _ in records(source):
                        for k, v in zip(out, (_page(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"],
                                              _page(fields.get("WARC-Refers-To")), fields.get("WARC-Target-URI"))):
                            out[k].append(v)
                n = len(out["page_id"])
                yield pa.RecordBatch.from_pydict({
                    "page_id": pa.array(out["page_id"], pa.int64()), "payload_bytes": pa.array(out["payload_bytes"], pa.int64()),
                    "payload_digest": pa.array(out["payload_digest"], pa.string()), "record_type": pa.array(out["record_type"], pa.string()),
                    "refers_to": pa.array(out["refers_to"], pa.int64()), "url": pa.array(out["url"], pa.string()),
                    "path": pa.array([path] * n, pa.string())})

    return manifest.select("path").repartition(max(1, n_files), "path").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, url string, path string")


def warc_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the archives into a new shared folder and read every record back."""
    return read_archives(write_archives(pages, output_folder(pages.sparkSession, "warc"), **options))
