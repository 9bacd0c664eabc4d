"""Alignment of two tokenizers over a corpus (operator 11): pair counts by minimal perfect hashing.

Every text, with a space before it, is encoded by A (byte-level BPE) and B (pieces with byte
fallback, which put that space themselves). Byte offsets where tokens of both end cut them into
groups; two occurrences whose ranges end together are a link. No token is empty, so each offset
gives one link, that of the last tokens of its group.

Neither tokenizer joins bytes over a space that follows a printable character: A's own split ends
there, and no piece of B holds a space after another character (checked when the file is
opened; else whole texts are encoded). Texts are cut at such spaces, each distinct segment is
encoded and aligned once per worker (a bounded table), and texts are put together from it.

Counts, in passes over tables that Spark deals out:

1. texts are aligned in blocks of about ``BLOCK_BYTES``; a block keeps each text's segments, its
   distinct pairs, and their counts. Pairs fall into ``BUCKETS`` buckets by their B id.
2. the distinct pairs of a bucket, merged as a tree over the blocks, get a minimal perfect hash:
   levels of bits that only one key hits, the index being the rank of its bit. The keys are kept
   in index order, so each lookup is verified.
3. each part of the blocks adds its counts into a dense vector indexed by the hash; the vectors
   of a bucket are summed as a tree, and the highest count of each B id is marked.
4. blocks look their pairs up in their buckets, the answers return to the block, and its texts
   are aligned again, from segments to links, to add them up.

A bucket has at most |A| x |B| / ``BUCKETS`` keys whatever the corpus; nothing is broadcast or
collected, and one task holds one block, or one bucket and ``FAN`` parts of it.

Cases: null and empty texts, and texts whose joined bytes differ from a space and the text under
either tokenizer (U+2581 itself, say), have no tokens: zeros and ''. Rows that repeat an id are
documents of their own, a null id is reported as null, an empty table gives no rows, further
columns are left out. A very long text is one block.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm._common import coded, doc_texts, gather, materialise, mix64, slices, starts_of, strings
from panelkit.llm.tokens import _byte_letters

BLOCK_BYTES = 2 << 20
BUCKETS = 128
#: Blocks of one part of a bucket, and partial results merged by one task.
FAN = 256
#: Segments and bytes of segments kept by one Python worker.
CACHED_SEGMENTS = 300_000
CACHED_BYTES = 16 << 20
#: Sizes of the level bit arrays, as a multiple of the keys that are left.
GAMMA = 2.0
#: The byte-level splitting rule of A's library, in public use with this kind of file (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))


# --- minimal perfect hash ---------------------------------------------------------------

def _level_places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = mix64(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1))
    return (h % np.uint64(size)).astype(np.int64)


def build_hash(keys: np.ndarray, gamma: float = GAMMA) -> list[np.ndarray]:
    """Bit arrays (bool) of the levels for distinct keys; a level's size is its length."""
    levels, left = [], keys
    while len(left):
        size = max(1, int(gamma * len(left)))
        at = _level_places(left, len(levels), size)
        hits = np.bincount(at, minlength=size)
        levels.append(hits == 1)
        left = left[hits[at] != 1]
    return levels


def hash_index(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Index of each key, 0 to n - 1; -1 where a key certainly was not among those hashed."""
    out = np.full(len(keys), -1, np.int64)
    left, base = np.arange(len(keys)), 0
    for k, bits in enumerate(levels):
        if not len(left):
            break
        at = _level_places(keys[left], k, len(bits))
        hit = bits[at]
        rank = np.cumsum(bits) - 1
        out[left[hit]] = base + rank[at[hit]]
        base += int(rank[-1]) + 1 if len(bits) else 0
        left = left[~hit]
    return out


def _pack(levels: list[np.ndarray]) -> tuple[bytes, list[int]]:
    return b"".join(np.packbits(b).tobytes() for b in levels), [len(b) for b in levels]


def _unpack(bits: bytes, sizes: list[int]) -> list[np.ndarray]:
    out, at = [], 0
    for n in sizes:
        width = (n + 7) // 8
        out.append(np.unpackbits(np.frombuffer(bits, np.uint8, width, at), count=n).astype(bool))
        at += width
    return out


def verified_index(levels: list[np.ndarray], table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in ``table`` (keys in index order); an unknown key is an error."""
    at = hash_index(levels, keys)
    if len(at) and (at.min() < 0 or (table[at] != keys).any()):
        raise ValueError("a pair is not among those hashed")
    return at


# --- alignment in a task ----------------------------------------------------------------

def split_segments(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Segments of texts that start with a space, and the number in each text.

    Cuts stand before a space whose left neighbour is a printable ASCII character, one of U+00C0
    to U+07FF, or one of U+2010 to U+2027: none of these is white space to any tokenizer.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    base = int(offsets[0])
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[base:offsets[-1]]
    begins = offsets - base
    at = np.flatnonzero(data == 0x20)
    at = at[at > 2]
    left, second, third = data[at - 1], data[at - 2], data[at - 3]
    plain = (left > 0x20) & (left < 0x7F)
    two = (left >= 0x80) & (second >= 0xC3) & (second <= 0xDF)
    dash = (third == 0xE2) & (second == 0x80) & (left >= 0x90) & (left <= 0xA7)
    cuts = np.union1d(at[plain | two | dash], begins[:-1])
    places = np.append(cuts, len(data)).astype(np.int64)
    parts = pa.Array.from_buffers(pa.large_string(), len(cuts), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))])
    return parts, np.diff(np.searchsorted(cuts, begins[:-1]), append=len(cuts))


class Tokens:
    """Bytes of each id of a tokenizer, laid out for numpy."""

    def __init__(self, of_id: dict[int, bytes]):
        n = max(of_id) + 1
        self.of_id = [of_id.get(i, b"") for i in range(n)]
        self.lens = np.fromiter(map(len, self.of_id), np.int64, n)
        self.at = starts_of(self.lens)[:-1]
        self.data = np.frombuffer(b"".join(self.of_id), np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        return self.data[gather(self.at[ids], self.lens[ids])]


class _Pool:
    """Lists of ids by slot."""

    def __init__(self):
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def add(self, lists: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.start = np.concatenate([self.start, len(self.ids) + starts_of(sizes)[:-1]])
        self.size = np.concatenate([self.size, sizes])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))])

    def get(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.ids[gather(self.start[slots], self.size[slots])].astype(np.int64), self.size[slots]


class Aligner:
    """Tokens, groups and links of segments, by a bounded table of the segments already encoded.

    Segments of ASCII and Latin letters, digits and marks go to ``tiktoken`` with the vocabulary of
    A's file, if the ids of that follow the order of its merges: the two libraries then do the
    same (held against each other in ``tests/llm``), and it is several times faster.
    """

    PLAIN = re.compile("[\x20-\x7e\n\t\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")

    def __init__(self, byte_path: str, piece_path: str, cached: int = CACHED_SEGMENTS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        back = {letter: bytes([b]) for b, letter in _byte_letters().items()}
        vocabulary = {i: b"".join(back.get(c, c.encode()) for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.a_tokens = Tokens(vocabulary)
        self.quick = self._quick(byte_path, vocabulary)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_tokens = Tokens({i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                for i, p in enumerate(names)})
        self.cuttable = not any(re.search("[^▁]▁", p) for p in names)
        if max(len(self.a_tokens.of_id), len(names)) > 65536:
            raise ValueError("ids must be below 65536")
        # ids as text before a comma, the bar between A and B, and the end of a group
        ids = range(max(len(self.a_tokens.of_id), len(names)))
        self.n_ids = len(ids)
        self.names = pa.array([f"{i}{mark}" for mark in ",|;" for i in ids], pa.large_string())
        self.limit = cached
        self._clear()

    @staticmethod
    def _quick(path: str, vocabulary: dict[int, bytes]):
        """A tiktoken encoding with A's rules and vocabulary; None where the file differs."""
        import tiktoken

        with open(path) as f:
            file = json.load(f)
        split, model = file["pre_tokenizer"] or {}, file["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        base = len(vocabulary) - len(pairs)
        in_order = all(model["vocab"].get(x + y) == base + k for k, (x, y) in enumerate(pairs))
        usual = (split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and base == 256
                 and file["normalizer"] is None and not model.get("ignore_merges") and not model.get("dropout"))
        if not (usual and in_order):
            return None
        return tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks={b: i for i, b in vocabulary.items()}, special_tokens={})._core_bpe.encode_ordinary

    def _clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.held = 0
        self.a_pool, self.b_pool = _Pool(), _Pool()

    def encode_a(self, parts: list[str]) -> list[list[int]]:
        out: list = [None] * len(parts)
        hard = []
        for k, s in enumerate(parts):
            if self.quick is not None and self.PLAIN.fullmatch(s):
                out[k] = self.quick(s)
            else:
                hard.append(k)
        for at in range(0, len(hard), 4096):
            some = hard[at:at + 4096]
            for k, e in zip(some, self.a.encode_batch_fast([parts[k] for k in some], add_special_tokens=False)):
                out[k] = e.ids
        return out

    def encode_b(self, parts: list[str]) -> list[list[int]]:
        return self.b.encode([s[1:] for s in parts], num_threads=1) if parts else []

    def _learn(self, parts: list[str]) -> None:
        self.slot.update(zip(parts, range(len(self.slot), len(self.slot) + len(parts))))
        self.held += sum(map(len, parts))
        for at in range(0, len(parts), 65536):
            self.a_pool.add(self.encode_a(parts[at:at + 65536]))
            self.b_pool.add(self.encode_b(parts[at:at + 65536]))

    def align(self, raw: np.ndarray, sizes: np.ndarray, a, n_a, b, n_b):
        """Of strings (bytes in a row, sizes) and their ids: which of them both tokenizers give back;
        and for these in a row the number of groups, their links, and the groups as text, each
        with a semicolon after it."""
        good = np.ones(len(sizes), bool)
        for ids, n, tokens in ((a, n_a, self.a_tokens), (b, n_b, self.b_tokens)):
            sums = starts_of(tokens.lens[ids])
            ends = starts_of(n)
            good &= sums[ends[1:]] - sums[ends[:-1]] == sizes
        for ids, n, tokens in ((a, n_a, self.a_tokens), (b, n_b, self.b_tokens)):
            same = tokens.join(ids[np.repeat(good, n)]) == raw[np.repeat(good, sizes)]
            if not same.all():
                which = np.flatnonzero(good)
                good[which[np.unique(np.repeat(np.arange(len(which)), sizes[good])[~same])]] = False
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b = n_a[good], n_b[good]
        ends_a, ends_b = np.cumsum(self.a_tokens.lens[a]), np.cumsum(self.b_tokens.lens[b])
        total = int(ends_a[-1]) if len(ends_a) else 0
        mark = np.zeros(total + 1, np.uint8)
        mark[ends_a] = 1
        mark[ends_b] += 2
        last_a, last_b = mark[ends_a] == 3, mark[ends_b] == 3
        links = a[last_a] * 65536 + b[last_b]
        of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b  # group of each token
        per_a, per_b = starts_of(np.bincount(of_a)), starts_of(np.bincount(of_b))
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + per_b[of_a]] = a + self.n_ids * last_a
        order[np.arange(len(b)) + per_a[of_b + 1]] = b + 2 * self.n_ids * last_b
        text = self.names.take(pa.array(order))
        groups = starts_of(last_a)[starts_of(n_a)]
        places = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1)[starts_of(n_a + n_b)] if len(text) else np.zeros(len(n_a) + 1, np.int64)
        strings_ = pa.Array.from_buffers(pa.large_string(), len(n_a), [None, pa.py_buffer(places.copy()), text.buffers()[2] or pa.py_buffer(b"")])
        return good, np.diff(groups), links, strings_

    def block(self, texts: pa.Array) -> dict:
        """Alignment of non-empty texts: per text the columns of the result that need no counts,
        its segments, and per distinct segment its links."""
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
        if self.cuttable:
            parts, counts = split_segments(spaced)
        else:
            parts, counts = spaced, np.ones(len(texts), np.int64)
        distinct, codes = coded(parts)
        names = distinct.to_pylist()
        missing = [s for s in names if s not in self.slot]
        if len(self.slot) + len(missing) > self.limit or self.held > CACHED_BYTES:
            self._clear()
            missing = names
        if missing:
            self._learn(missing)
        slots = np.fromiter(map(self.slot.__getitem__, names), np.int64, len(names))
        (a, n_a), (b, n_b) = self.a_pool.get(slots), self.b_pool.get(slots)
        good, per_segment, links, groups = self.align(*_raw(distinct), a, n_a, b, n_b)
        first = starts_of(counts)
        bad = np.add.reduceat((~good[codes]).astype(np.int64), first[:-1]) > 0
        kept = np.repeat(~bad, counts)
        codes, owners = (np.cumsum(good) - 1)[codes[kept]], np.repeat(np.arange(len(texts)), counts)[kept]
        n_a, n_b = n_a[good], n_b[good]
        if bad.any():
            # segments that differ may still add up to the text: the text itself decides
            some = spaced.filter(pa.array(bad))
            lists = [self.encode_a(some.to_pylist()), self.encode_b(some.to_pylist())]
            sizes = [np.fromiter(map(len, x), np.int64, len(x)) for x in lists]
            ids = [np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in zip(lists, sizes)]
            right, more, more_links, more_groups = self.align(*_raw(some), ids[0], sizes[0], ids[1], sizes[1])
            owners = np.append(owners, np.flatnonzero(bad)[right])
            codes = np.append(codes, len(per_segment) + np.arange(len(more)))
            order = np.argsort(owners, kind="stable")
            codes, owners = codes[order], owners[order]
            per_segment, links = np.append(per_segment, more), np.append(links, more_links)
            n_a, n_b = np.append(n_a, sizes[0][right]), np.append(n_b, sizes[1][right])
            groups = pa.concat_arrays([groups, more_groups])
        per_text = np.bincount(owners, minlength=len(texts))
        at = starts_of(per_text)
        totals = np.zeros((len(texts), 3), np.int64)
        for k, n in enumerate((n_a, n_b, per_segment)):
            sums = starts_of(n[codes])
            totals[:, k] = sums[at[1:]] - sums[at[:-1]]
        line = groups.take(pa.array(codes))
        places = np.frombuffer(line.buffers()[1], np.int64, len(line) + 1) if len(line) else np.zeros(1, np.int64)
        data = memoryview(line.buffers()[2] or b"") if len(line) else b""
        sha = [hashlib.sha256(data[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(places[at[:-1]].tolist(), places[at[1:]].tolist())]
        return {"totals": totals, "sha": sha, "codes": codes, "per_text": per_text, "links": links, "per_segment": per_segment}


def _raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of strings in a row, and the size of each."""
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    return np.frombuffer(array.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]], np.diff(offsets)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """The aligner of this Python worker for two tokenizer files."""
    key = (byte_path, piece_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(byte_path, piece_path)
    return _ALIGNERS[key]


def bucket_of(keys: np.ndarray) -> np.ndarray:
    """Bucket of each pair, by its B id: the pairs of a B id meet."""
    return (mix64((keys % 65536).astype(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)


def _ints(array: np.ndarray, kind=np.int64) -> bytes:
    return np.ascontiguousarray(array, kind).tobytes()


def _array(value, kind=np.int64) -> np.ndarray:
    return np.frombuffer(value.as_py() if hasattr(value, "as_py") else value, kind)


# --- the passes -------------------------------------------------------------------------

def align_corpus(docs: DataFrame, tokenizers: tuple[str, str] | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per document: its tokens, groups and links, the links that are the best of their B id over
    the corpus, the sum of its links' counts, and the digest of its groups."""
    a_path, b_path = tokenizers or default_tokenizers()
    blocks = materialise(_blocks(doc_texts(docs, id_col, text_col), a_path, b_path), "align-blocks")
    parts = max(1, -(-blocks.count() // FAN))
    pieces = _pieces(blocks, parts)
    hashed = materialise(_hashes(pieces, parts), "align-hashes")
    counted = materialise(_counts(pieces, hashed, parts), "align-counts")
    return _second_pass(blocks, _lookups(pieces, counted, parts))


def pair_counts(docs: DataFrame, tokenizers: tuple[str, str] | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The table of pairs behind ``align_corpus``: a_id, b_id, links, best (of its B id)."""
    a_path, b_path = tokenizers or default_tokenizers()
    blocks = materialise(_blocks(doc_texts(docs, id_col, text_col), a_path, b_path), "align-blocks")
    parts = max(1, -(-blocks.count() // FAN))
    pieces = _pieces(blocks, parts)
    counted = _counts(pieces, materialise(_hashes(pieces, parts), "align-hashes"), parts)

    def rows(batches):
        for batch in batches:
            for keys, vector, best in zip(*(batch.column(c) for c in ("keys", "counts", "best"))):
                k = _array(keys)
                yield pa.RecordBatch.from_arrays([pa.array(k // 65536), pa.array(k % 65536), pa.array(_array(vector)),
                                                  pa.array(_array(best, np.bool_))], names=["a_id", "b_id", "links", "best"])

    return counted.mapInArrow(rows, "a_id long, b_id long, links long, best boolean")


def _blocks(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    schema = ("block long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, sha array<string>, "
              "per_text binary, codes binary, per_segment binary, link_of binary, keys binary, counts binary, buckets binary")

    def align(batches):
        from pyspark import TaskContext

        tool = aligner(a_path, b_path)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                texts = strings(part.column("text"))
                full = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
                n = len(texts)
                totals, sha, per_text = np.zeros((n, 3), np.int64), np.full(n, "", object), np.zeros(n, np.int64)
                got = {"codes": np.zeros(0, np.int64), "links": np.zeros(0, np.int64), "per_segment": np.zeros(0, np.int64)}
                if full.any():
                    got = tool.block(texts.filter(pa.array(full)))
                    totals[full], sha[full], per_text[full] = got["totals"], got["sha"], got["per_text"]
                keys, link_of = np.unique(got["links"], return_inverse=True)
                bucket = bucket_of(keys)
                order = np.argsort(bucket, kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                keys, link_of = keys[order], place[link_of]
                uses = np.bincount(got["codes"], minlength=len(got["per_segment"]))  # of each segment
                counts = np.bincount(link_of, weights=np.repeat(uses, got["per_segment"]), minlength=len(keys))
                lists = [pa.array([totals[:, k]], pa.list_(pa.int64())) for k in range(3)]
                binary = [per_text.astype(np.int32), got["codes"].astype(np.int32), got["per_segment"].astype(np.int32),
                          link_of.astype(np.int32), keys, counts.astype(np.int64), np.bincount(bucket, minlength=BUCKETS)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())), *lists,
                     pa.array([sha.tolist()], pa.list_(pa.string())), *(pa.array([x.tobytes()], pa.binary()) for x in binary)],
                    names=[c.split()[0] for c in schema.split(", ")])
                block += 1
                del got, texts
                pa.default_memory_pool().release_unused()  # else kept for later, beside the JVM's heap

    return rows.mapInArrow(align, schema)


def _pieces(blocks: DataFrame, parts: int) -> DataFrame:
    """A block's pairs by bucket: (bucket, part, block, keys, counts)."""
    def cut(batches):
        for batch in batches:
            for block, keys, counts, per_bucket in zip(*(batch.column(c) for c in ("block", "keys", "counts", "buckets"))):
                k, c, at = _array(keys), _array(counts), starts_of(_array(per_bucket))
                used = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([block.as_py()] * len(used), pa.int64()),
                     pa.array([_ints(k[at[b]:at[b + 1]]) for b in used], pa.binary()),
                     pa.array([_ints(c[at[b]:at[b + 1]]) for b in used], pa.binary())], names=["bucket", "block", "keys", "counts"])

    cut_up = blocks.select("block", "keys", "counts", "buckets").mapInArrow(cut, "bucket int, block long, keys binary, counts binary")
    return cut_up.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))


def _merge(rows: DataFrame, parts: int, merge, schema: str) -> DataFrame:
    """Rows of (bucket, part, ...) merged to one row a bucket: a tree of ``FAN`` rows a node."""
    while True:
        rows = rows.groupBy("bucket", "part").applyInArrow(merge, schema)
        if parts == 1:
            return rows
        parts = -(-parts // FAN)
        rows = rows.withColumn("part", F.pmod("part", F.lit(parts)).cast("int"))


def _hashes(pieces: DataFrame, parts: int) -> DataFrame:
    """Per bucket: the levels of its hash and its keys in index order."""
    def union(table: pa.Table) -> pa.Table:
        keys = np.unique(np.concatenate([_array(x) for x in table.column("keys")]))
        return pa.table({"bucket": table.column("bucket")[:1].cast(pa.int32()), "part": table.column("part")[:1].cast(pa.int32()),
                         "keys": pa.array([_ints(keys)], pa.binary())})

    def build(batches):
        for batch in batches:
            for bucket, keys in zip(batch.column("bucket"), batch.column("keys")):
                k = _array(keys)
                levels = build_hash(k)
                table = np.empty_like(k)
                table[hash_index(levels, k)] = k
                bits, sizes = _pack(levels)
                yield pa.RecordBatch.from_arrays([pa.array([bucket.as_py()], pa.int32()), pa.array([bits], pa.binary()), pa.array([sizes], pa.list_(pa.int64())),
                                                  pa.array([_ints(table)], pa.binary())], names=["bucket", "bits", "sizes", "keys"])

    united = _merge(pieces.select("bucket", "part", "keys"), parts, union, "bucket int, part int, keys binary")
    return united.select("bucket", "keys").mapInArrow(build, "bucket int, bits binary, sizes array<long>, keys binary")


def _every_part(tables: DataFrame, parts: int) -> DataFrame:
    return tables.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))


def _counts(pieces: DataFrame, hashed: DataFrame, parts: int) -> DataFrame:
    """Per bucket: levels, keys, the summed dense vector of counts, and the best of each B id."""
    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        levels = _unpack(right.column("bits")[0].as_py(), right.column("sizes")[0].as_py())
        table = _array(right.column("keys")[0])
        vector = np.zeros(len(table), np.int64)
        for keys, counts in zip(left.column("keys"), left.column("counts")):
            vector[verified_index(levels, table, _array(keys))] += _array(counts)  # keys of a block are distinct
        return pa.table({"bucket": right.column("bucket")[:1], "part": right.column("part")[:1], "vector": pa.array([_ints(vector)], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        out = _array(table.column("vector")[0]).copy()
        for vector in table.column("vector")[1:]:
            out += _array(vector)
        return pa.table({"bucket": table.column("bucket")[:1], "part": table.column("part")[:1], "vector": pa.array([_ints(out)], pa.binary())})

    schema = "bucket int, part int, vector binary"
    partial = (pieces.select("bucket", "part", "keys", "counts").groupBy("bucket", "part")
               .cogroup(_every_part(hashed, parts).groupBy("bucket", "part")).applyInArrow(_where_used(add, schema), schema))
    summed = _merge(partial, parts, total, schema).select(F.col("bucket").alias("of"), F.col("vector").alias("counts"))

    def mark(batches):
        for batch in batches:
            best = []
            for keys, counts in zip(batch.column("keys"), batch.column("counts")):
                b, c = _array(keys) % 65536, _array(counts)
                top = np.zeros(65536, np.int64)
                np.maximum.at(top, b, c)
                best.append((c == top[b]).tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("bucket", "bits", "sizes", "keys", "counts")),
                                              pa.array(best, pa.binary())], names=["bucket", "bits", "sizes", "keys", "counts", "best"])

    joined = hashed.join(summed, F.col("bucket") == F.col("of")).drop("of")
    return joined.mapInArrow(mark, "bucket int, bits binary, sizes array<long>, keys binary, counts binary, best binary")


def _where_used(fn, schema: str):
    """A cogroup function for keys that both sides have; nothing where a part lacks a bucket."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    empty = pa.table({n: pa.array([], kinds[c.split()[1]]) for n, c in zip(names, schema.split(", "))})

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(left, right) if left.num_rows and right.num_rows else empty

    return run


def _lookups(pieces: DataFrame, counted: DataFrame, parts: int) -> DataFrame:
    """Answers to the pieces: (block, bucket, counts, best) in the order of the piece's keys."""
    schema = "block long, bucket int, counts binary, best binary"

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        levels = _unpack(right.column("bits")[0].as_py(), right.column("sizes")[0].as_py())
        table, counts = _array(right.column("keys")[0]), _array(right.column("counts")[0])
        best = _array(right.column("best")[0], np.bool_)
        at = [verified_index(levels, table, _array(keys)) for keys in left.column("keys")]
        return pa.table({"block": left.column("block"), "bucket": left.column("bucket"),
                         "counts": pa.array([_ints(counts[x]) for x in at], pa.binary()),
                         "best": pa.array([best[x].tobytes() for x in at], pa.binary())})

    return (pieces.select("bucket", "part", "block", "keys").groupBy("bucket", "part")
            .cogroup(_every_part(counted, parts).groupBy("bucket", "part")).applyInArrow(_where_used(look, schema), schema))


def _second_pass(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """The texts of each block aligned again, with the counts of their links."""
    names = [c.split()[0] for c in RESULT.split(", ")]

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left.column(c)[0].as_py() for c in left.column_names}
        order = np.argsort(right.column("bucket").to_numpy())
        counts = np.concatenate([_array(right.column("counts")[int(k)]) for k in order] or [np.zeros(0, np.int64)])
        best = np.concatenate([_array(right.column("best")[int(k)], np.bool_) for k in order] or [np.zeros(0, np.bool_)])
        per_segment, link_of = _array(row["per_segment"], np.int32), _array(row["link_of"], np.int32)
        codes, at = _array(row["codes"], np.int32), starts_of(_array(row["per_text"], np.int32))
        of_segment = starts_of(per_segment)
        sums = []
        for values in (best.astype(np.int64), counts):
            links = starts_of(values[link_of])
            texts = starts_of((links[of_segment[1:]] - links[of_segment[:-1]])[codes])
            sums.append(texts[at[1:]] - texts[at[:-1]])
        return pa.table([pa.array(row["ids"], pa.int64()), pa.array(row["n_a"], pa.int64()), pa.array(row["n_b"], pa.int64()),
                         pa.array(row["n_groups"], pa.int64()), pa.array(row["n_groups"], pa.int64()), pa.array(sums[0]), pa.array(sums[1]),
                         pa.array(row["sha"], pa.string())], names=names)

    columns = ("block", "ids", "n_a", "n_b", "n_groups", "sha", "per_text", "codes", "per_segment", "link_of")
    return blocks.select(*columns).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add_up, RESULT)
