"""Phrase collocations per language (operator 13): Toivonen's sampling with a negative border.

Pieces, words and phrases as in the contract of ``collocations``. A phrase can reach the count
only if its two parts that are one word shorter do.

1. A sample (one document of ``SAMPLE``, by a hash of id and text, so it grows with the corpus)
   proposes the phrases that reach a lowered count in it.
2. A full pass counts all words, and every longer phrase whose two shorter parts are proposed:
   the proposals and their negative border at once. The border is never written down: a phrase
   of the corpus is in it, or proposed, exactly if both parts are proposed.
3. Counted phrases that reach the count but were not proposed are border failures. They join the
   proposals, and a further pass counts what only now has both parts; until no failure is left.
4. A last pass counts the phrases that reached the count by two hashes, and finds the first block
   that has each; that block alone gives its text.

The words of the corpus are cut out once and written as coded blocks, which the passes read.

Passes 1 to 3 count 64-bit keys, which can only add up to too much where keys collide; pass 4
tells those apart by a second hash of 64 bits. Tasks know the proposals by a filter of
at most ``FILTER_WORDS`` 64-bit words (64 MB, the only thing broadcast; it is put together from
chunks that Spark merges). A filter lets some further phrases through, which are then
counted without need; it never stops a proposed one, and a filter holds all that an earlier one
of its size did. Each block of text (``BLOCK_BYTES``) counts its own phrases before anything is
shuffled, so a phrase is one row a block however frequent it is. Cuts and parts meet by joins;
the first 2000 of a language are taken from the first 2000 of hash parts of it.

Cases: null text is empty, null language is ``und``; empty texts add nothing; rows that repeat an
id are documents of their own; an empty table gives no rows; further columns are left out. Texts
longer than a block are cut where pieces end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm._common import coded, delta_bytes, few_rows, from_delta_bytes, materialise, mix64, slices, strings, wanted_partitions

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
SAMPLE = 16
BLOCK_BYTES = 4 << 20
#: Words of 64 bits in the filter of the proposals, at most; one holds four keys at 16 bits each.
FILTER_WORDS = 1 << 23
CHUNK = 1 << 13
#: Keys that a task holds before it sums or sends them.
HELD_KEYS = 1_000_000
#: Phrases that a task holds with both hashes before it sums or sends them.
HELD_PHRASES = 400_000
#: Languages whose word totals are sent to all executors, at most; beyond, they are joined.
BROADCAST_LANGS = 10_000

_KIND = np.zeros(256, np.uint8)  # part of a word, white space inside a piece, end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_ODD = np.random.default_rng(13).integers(1, 2 ** 63, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Filter:
    """A set of keys that may let others through: four bits of one 64-bit word for each key."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def places(keys: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix64(keys ^ _ODD[30])
        mask = np.zeros(len(keys), np.uint64)
        for k in range(4):
            mask |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
        return ((h >> np.uint64(32)) & np.uint64(n_words - 1)).astype(np.int64), mask

    def has(self, keys: np.ndarray) -> np.ndarray:
        at, mask = self.places(keys, len(self.words))
        return self.words[at] & mask == mask


class Block:
    """Words of some texts, and the keys of their phrases.

    ``codes`` are the words in order, as places in ``words`` (with their ``hashes``); ``first``
    tells where pieces begin, ``lang`` the language of each word, as a place in ``langs``.
    """

    def __init__(self, words, hashes: np.ndarray, codes: np.ndarray, first: np.ndarray, lang: np.ndarray, langs: list[str]):
        import xxhash

        self.words, self.distinct_hashes, self.codes, self.first, self.lang, self.langs = words, hashes, codes, first, lang, langs
        self.hashes = hashes[codes]
        self.piece = np.cumsum(first, dtype=np.int32)
        self.number = None  # of a stored block
        lang_hash = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in langs), np.uint64, len(langs))
        self.lang_hash = lang_hash[lang]

    @classmethod
    def of_texts(cls, texts: pa.Array, langs: pa.Array) -> "Block":
        import xxhash

        texts = strings(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        data = data | np.where((data >= 0x41) & (data <= 0x5A), np.uint8(0x20), np.uint8(0))
        kind = _KIND[data]
        full = kind == 0
        first = full.copy()
        first[1:] &= ~full[:-1]
        begins = offsets[:-1][offsets[:-1] < len(data)]
        first[begins] = full[begins]
        at = np.flatnonzero(first)
        places = np.append(np.cumsum(full, dtype=np.int32)[at] - 1, full.sum()).astype(np.int64)
        array = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(places), pa.py_buffer(data[full])])
        words, codes = coded(array)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))
        # a piece ends at a mark or with its text
        ends = np.flatnonzero(kind == 2)
        text = np.searchsorted(offsets, at, side="right") - 1
        piece = np.searchsorted(ends, at) + text
        distinct, lang = coded(langs.cast(pa.large_string()))
        return cls(words, hashes, codes, np.diff(piece, prepend=-1) != 0, lang[text], distinct.to_pylist())

    def store(self) -> pa.RecordBatch:
        run = np.flatnonzero(np.diff(self.lang, prepend=-1))  # languages change between texts only
        return pa.RecordBatch.from_arrays(
            [pa.array([x], pa.binary()) for x in (self.codes.astype(np.int32).tobytes(), np.packbits(self.first).tobytes(), self.distinct_hashes.tobytes(),
                                                  run.tobytes(), self.lang[run].astype(np.int32).tobytes())]
            + [pa.array([self.langs], pa.list_(pa.string())), pa.array([self.words.to_pylist()], pa.list_(pa.string()))],
            names=["codes", "first", "hashes", "run", "run_lang", "langs", "words"])

    @classmethod
    def load(cls, batch: pa.RecordBatch, k: int) -> "Block":
        codes = np.frombuffer(batch.column("codes")[k].as_py(), np.int32).astype(np.int64)
        first = np.unpackbits(np.frombuffer(batch.column("first")[k].as_py(), np.uint8), count=len(codes)).astype(bool)
        run = np.frombuffer(batch.column("run")[k].as_py(), np.int64)
        lang = np.repeat(np.frombuffer(batch.column("run_lang")[k].as_py(), np.int32).astype(np.int64), np.diff(run, append=len(codes)))
        words = batch.column("words")[k].values if "words" in batch.schema.names else None
        block = cls(words, np.frombuffer(batch.column("hashes")[k].as_py(), np.uint64), codes, first, lang, batch.column("langs")[k].as_py())
        block.number = batch.column("block")[k].as_py()
        return block

    def keys(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the phrases of ``m`` words at all places, and whether they lie in one piece.
        The lowest three bits of a key are its length."""
        n = max(len(self.hashes) - m + 1, 0)
        with np.errstate(over="ignore"):
            sums = self.lang_hash[:n] * _ODD[20] + _ODD[10 + m]
            for j in range(m):
                sums = sums + self.hashes[j:j + n] * _ODD[j]
        return (mix64(sums) & ~np.uint64(7)) | np.uint64(m), self.piece[:n] == self.piece[m - 1:m - 1 + n]

    def second(self, m: int, at: np.ndarray | None = None) -> np.ndarray:
        """Another hash of the phrases of ``m`` words at all places, or at those given."""
        if at is None:
            at = np.arange(max(len(self.hashes) - m + 1, 0))
        mixed = mix64(self.distinct_hashes)
        with np.errstate(over="ignore"):
            sums = mix64(self.lang_hash[at] ^ _ODD[21])
            for j in range(m):
                sums = sums * _ODD[22] + mixed[self.codes[at + j]]
        return sums

    def counted(self, known: Filter | None, before: Filter | None = None):
        """(m, places, keys) of the phrases with both parts in ``known`` and not both in ``before``;
        without ``known`` all phrases."""
        inside = earlier = None
        for m in range(1, LONGEST + 1):
            keys, whole = self.keys(m)
            able = whole if m == 1 or known is None else whole & inside[:-1] & inside[1:]
            new = able
            if before is not None:
                done = whole if m == 1 else whole & earlier[:-1] & earlier[1:]
                new = able & ~done
            at = np.flatnonzero(new)
            if len(at):
                yield m, at, keys[at]
            if m == LONGEST or not len(keys) or (known is not None and not able.any()):
                return
            if known is not None:
                inside = _has(known, keys, able)
            if before is not None:
                earlier = _has(before, keys, done)

    def phrases(self, at: np.ndarray, m: int) -> list[str]:
        """Texts of the phrases of ``m`` words at some places."""
        columns = [self.words.take(pa.array(self.codes[at + j])) for j in range(m)]
        return pc.binary_join_element_wise(*columns, " ").to_pylist() if m > 1 else columns[0].to_pylist()


def _has(known: Filter, keys: np.ndarray, where: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys), bool)
    at = np.flatnonzero(where)
    out[at] = known.has(keys[at])
    return out


def cut_long(text: str, limit: int = BLOCK_BYTES) -> list[str]:
    """A text in parts of about ``limit`` bytes that end where pieces end."""
    raw = text.encode()
    ends = np.flatnonzero(_KIND[np.frombuffer(raw, np.uint8)] == 2) + 1
    cuts, at = [0], 0
    while len(raw) - at > limit:
        k = int(np.searchsorted(ends, at + limit))
        if k == len(ends):
            break
        at = int(ends[k])
        cuts.append(at)
    return [raw[a:b].decode() for a, b in zip(cuts, [*cuts[1:], len(raw)])]


def _blocks(batches):
    for batch in batches:
        for part in slices(batch, "text", BLOCK_BYTES):
            texts, langs = part.column("text"), part.column("lang")
            if part.num_rows == 1 and texts[0].is_valid and len(texts[0].as_py()) > BLOCK_BYTES:
                for some in cut_long(texts[0].as_py()):
                    yield Block.of_texts(pa.array([some], pa.large_string()), langs)
            else:
                yield Block.of_texts(texts, langs)


_STORED = "codes binary, first binary, hashes binary, run binary, run_lang binary, langs array<string>, words array<string>, block long"


def _stored(texts: DataFrame) -> DataFrame:
    """The blocks of all texts, their words cut out once and coded, with a number of their own."""
    def store(batches):
        task = TaskContext.get().partitionId() << 32
        for k, block in enumerate(_blocks(batches)):
            yield block.store().append_column("block", pa.array([task + k]))

    return texts.mapInArrow(store, _STORED)


def _loaded(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield Block.load(batch, k)


def _key_counts(blocks: DataFrame, least: int, known=None, before=None) -> DataFrame:
    """(key, n) of the phrases counted ``least`` times or more."""
    parts = 4 * wanted_partitions(blocks.sparkSession)

    def count(batches):
        held, n_held = [], 0
        for block in _loaded(batches):
            for _, _, keys in block.counted(known and Filter(known.value), before and Filter(before.value)):
                held.append(np.unique(keys, return_counts=True))
                n_held += len(held[-1][0])
            if n_held > HELD_KEYS:
                held, n_held = [_summed(held)], 0
                n_held = len(held[0][0])
                if 2 * n_held > HELD_KEYS:
                    yield from _packed(*held.pop(), parts)
                    n_held = 0
        if held:
            yield from _packed(*_summed(held), parts)

    def total(table: pa.Table) -> pa.Table:
        keys, n = _summed([_unpacked(k, c) for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist())])
        often = n >= least
        return pa.table({"key": keys[often].view(np.int64), "n": n[often]})

    # a range of keys is one group; tasks have summed and packed their own
    packed = blocks.drop("words").mapInArrow(count, "part int, keys binary, counts binary")
    return packed.groupBy("part").applyInArrow(total, "key long, n long")


def _summed(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(x) for x in zip(*counts))
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(n, new) if len(new) else n


def _packed(keys: np.ndarray, n: np.ndarray, parts: int, **more: np.ndarray):
    """Sorted keys by range, and their counts in as few bytes as they need; ``more`` numbers of 64 bits as they are."""
    bounds = (np.arange(1, parts, dtype=object) * 2 ** 64 // parts).astype(np.uint64)
    at = np.r_[0, np.searchsorted(keys, bounds), len(keys)]
    used = np.flatnonzero(np.diff(at))
    out = []
    for p in used.tolist():
        k, c = keys[at[p]:at[p + 1]], n[at[p]:at[p + 1]]
        out.append((delta_bytes(k), c.astype(np.min_scalar_type(int(c.max()))).tobytes(), *(x[at[p]:at[p + 1]].tobytes() for x in more.values())))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(x, pa.binary()) for x in zip(*out))], names=["part", "keys", "counts", *more])


def _unpacked(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = len(counts) // (len(keys) // 8)
    return from_delta_bytes(keys), np.frombuffer(counts, f"<u{width}").astype(np.int64)


def _phrase_counts(blocks: DataFrame, least: int, wanted) -> DataFrame:
    """(key, second, f, block, place) of the phrases in the filter ``wanted`` that occur ``least`` times or more:
    ``block`` is the first block that has one, ``place`` a hash of the key and this block."""
    parts = 4 * wanted_partitions(blocks.sparkSession)

    def count(batches):
        known, held, n_held = Filter(wanted.value), [], 0
        for block in _loaded(batches):
            for m in range(1, LONGEST + 1):
                keys, whole = block.keys(m)
                at = np.flatnonzero(whole)
                at = at[known.has(keys[at])]
                if not len(at):
                    break
                held.append(_by_hashes(keys[at], block.second(m, at), np.ones(len(at), np.int64), np.full(len(at), block.number)))
                n_held += len(held[-1][0])
            if n_held > HELD_PHRASES:
                held = [_by_hashes(*map(np.concatenate, zip(*held)))]
                n_held = len(held[0][0])
                if 2 * n_held > HELD_PHRASES:
                    keys, second, n, of = held.pop()
                    yield from _packed(keys, n, parts, second=second, blocks=of)
                    n_held = 0
        if held:
            keys, second, n, of = _by_hashes(*map(np.concatenate, zip(*held)))
            yield from _packed(keys, n, parts, second=second, blocks=of)

    def total(table: pa.Table) -> pa.Table:
        some = [(*_unpacked(r["keys"], r["counts"]), np.frombuffer(r["second"], np.uint64), np.frombuffer(r["blocks"], np.int64))
                for r in table.drop_columns("part").to_pylist()]
        keys, n, second, of = map(np.concatenate, zip(*some))
        keys, second, n, of = _by_hashes(keys, second, n, of)
        often = n >= least
        keys, of = keys[often], of[often]
        return pa.table({"key": keys.view(np.int64), "second": second[often].view(np.int64), "f": n[often], "block": of, "place": _places(keys, of).view(np.int64)})

    packed = blocks.drop("words").mapInArrow(count, "part int, keys binary, counts binary, second binary, blocks binary")
    return packed.groupBy("part").applyInArrow(total, "key long, second long, f long, block long, place long")


def _by_hashes(keys: np.ndarray, second: np.ndarray, n: np.ndarray, blocks: np.ndarray):
    """(key, second, summed n, smallest block) of equal phrases, in key order."""
    order = np.lexsort((second, keys))
    keys, second = keys[order], second[order]
    new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (second[1:] != second[:-1])]) if len(keys) else np.zeros(0, np.int64)
    if not len(new):
        return keys, second, n, blocks
    return keys[new], second[new], np.add.reduceat(n[order], new), np.minimum.reduceat(blocks[order], new)


def _places(keys: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    """A hash of each key and its block."""
    with np.errstate(over="ignore"):
        return mix64(keys + mix64(np.asarray(blocks).astype(np.uint64).reshape(-1) ^ _ODD[23]))


def _filter(spark: SparkSession, keys: DataFrame, n_words: int):
    """The filter of the keys, sent to all executors: at most ``FILTER_WORDS`` 64-bit words."""
    def place(batches):
        for batch in batches:
            at, mask = Filter.places(batch.column("key").to_numpy().view(np.uint64), n_words)
            yield pa.RecordBatch.from_arrays([pa.array((at // CHUNK).astype(np.int32)), pa.array((at % CHUNK).astype(np.int32)), pa.array(mask.view(np.int64))],
                                             names=["chunk", "word", "mask"])

    def merge(table: pa.Table) -> pa.Table:
        words = np.zeros(min(CHUNK, n_words), np.uint64)
        np.bitwise_or.at(words, table.column("word").to_numpy(), table.column("mask").to_numpy().view(np.uint64))
        return pa.table({"chunk": table.column("chunk")[:1], "words": pa.array([words.tobytes()], pa.binary())})

    placed = keys.select("key").mapInArrow(place, "chunk int, word int, mask long")
    merged = placed.groupBy("chunk", "word").agg(F.bit_or("mask").alias("mask")).groupBy("chunk").applyInArrow(merge, "chunk int, words binary")
    words = np.zeros(n_words, np.uint64)
    for row in merged.toLocalIterator():
        part = np.frombuffer(row.words, np.uint64)
        words[row.chunk * CHUNK:row.chunk * CHUNK + len(part)] = part
    return spark.sparkContext.broadcast(words)


def _size(n_keys: int) -> int:
    return min(FILTER_WORDS, 1 << max(10, int(np.ceil(np.log2(max(1, n_keys) / 4)))))


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, sample: int = SAMPLE, id_col: str = "doc_id",
                     text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, m, phrase, f) of all phrases of up to five words that occur ``min_count`` times or
    more in their language, and (lang, n) of all languages."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    texts = materialise(_stored(rows.select("text", "lang")), "phrase-blocks")
    some = _stored(rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample)) == 0).select("text", "lang"))
    proposed = materialise(_key_counts(some, max(2, min_count // (2 * sample))).select("key"), "phrase-proposed")
    n_words = 2 * _size(proposed.count())  # room for the failures
    n_words = min(FILTER_WORDS, n_words)
    known, before, frequent = _filter(spark, proposed, n_words), None, None
    while True:
        counted = materialise(_key_counts(texts, min_count, known, before).select("key"), "phrase-counted")
        frequent = counted if frequent is None else frequent.unionByName(counted)
        # phrases of the greatest length have nothing above them
        failed = materialise(counted.where(F.expr(f"(key & 7) < {LONGEST}")).join(proposed, "key", "left_anti"), "phrase-failed")
        if failed.isEmpty():
            break
        proposed = materialise(proposed.unionByName(failed), "phrase-proposed")
        known, before = _filter(spark, proposed, n_words), known
    wanted = _filter(spark, frequent, _size(frequent.count()))
    counts = materialise(_phrase_counts(texts, min_count, wanted), "phrase-counts")
    chosen = _filter(spark, counts.select(F.col("place").alias("key")), _size(counts.count()))

    def name(batches):
        known, own, totals = Filter(wanted.value), Filter(chosen.value), {}
        for block in _loaded(batches):
            for x, n in zip(block.langs, np.bincount(block.lang, minlength=len(block.langs)).tolist()):
                totals[x] = totals.get(x, 0) + n
            held = _Held()
            for m in range(1, LONGEST + 1):
                keys, whole = block.keys(m)
                at = np.flatnonzero(whole)
                at = at[known.has(keys[at])]
                if not len(at):
                    break
                at = at[own.has(_places(keys[at], block.number))]
                if not len(at):
                    continue
                odd = held.add(block, m, at, keys[at], block.second(m, at))
                if len(odd):  # phrases whose keys collide are named one by one
                    second = block.second(m, odd)
                    _, first = np.unique(np.stack([keys[odd], second]), axis=1, return_index=True)
                    odd, second = odd[first], second[first]
                    yield _placed(_named([block.langs[x] for x in block.lang[odd].tolist()], [m] * len(odd), block.phrases(odd, m), [0] * len(odd)),
                                  keys[odd], second, block.number)
            at = 0
            for rows in held.rows():
                some = slice(at, at + rows.num_rows)
                yield _placed(rows, held.keys[some], held.second[some], block.number)
                at += rows.num_rows
        yield _placed(_named(list(totals), [0] * len(totals), [""] * len(totals), list(totals.values())), *np.zeros((2, len(totals)), np.uint64), -1)

    named = materialise(texts.mapInArrow(name, "lang string, m int, phrase string, f long, key long, second long, block long"), "phrase-texts")
    # the filter lets some further blocks name a phrase: only the first one counts
    found = counts.join(named.where("m > 0").drop("f"), ["key", "second", "block"]).select("lang", "m", "phrase", "f")
    return materialise(found, "phrase-named"), named.where("m = 0").groupBy("lang").agg(F.sum("f").alias("n"))


def _placed(rows: pa.RecordBatch, keys: np.ndarray, second: np.ndarray, block: int) -> pa.RecordBatch:
    more = [pa.array(keys.view(np.int64)), pa.array(second.view(np.int64)), pa.array(np.full(rows.num_rows, block, np.int64))]
    return pa.RecordBatch.from_arrays([*rows.columns, *more], names=[*rows.schema.names, "key", "second", "block"])


def _named(langs, lengths, phrases, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(lengths, pa.int32()), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())],
                                      names=["lang", "m", "phrase", "f"])


class _Held:
    """Counts by key, in key order, each with a second hash, its language and its text."""

    def __init__(self):
        self.keys, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.n, self.lang, self.text = (np.zeros(0, np.int64) for _ in range(3))
        self.langs: dict[str, int] = {}
        self.texts: list[pa.Array] = []
        self.n_texts = 0

    def add(self, block: Block, m: int, at: np.ndarray, keys: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts phrases of a block at places ``at``; gives back the places whose key another phrase has."""
        found, first, group = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, found)
        inside = place < len(self.keys)
        old = np.zeros(len(found), bool)
        old[inside] = self.keys[place[inside]] == found[inside]
        own = second[first]
        own[old] = self.second[place[old]]
        same = second == own[group]
        counts = np.bincount(group[same], minlength=len(found))
        self.n[place[old]] += counts[old]
        new = np.flatnonzero(~old)
        if len(new):
            heads = at[first[new]]
            code = np.array([self.langs.setdefault(x, len(self.langs)) for x in block.langs], np.int64)
            self.texts.append(pa.array(block.phrases(heads, m), pa.large_string()))
            keys_ = np.append(self.keys, found[new])
            order = np.argsort(keys_, kind="stable")
            self.keys = keys_[order]
            for name, more in (("second", own[new]), ("n", counts[new]), ("lang", code[block.lang[heads]]), ("text", self.n_texts + np.arange(len(new)))):
                setattr(self, name, np.append(getattr(self, name), more)[order])
            self.n_texts += len(new)
        return at[~same]

    def rows(self):
        texts = pa.chunked_array(self.texts, pa.large_string()).combine_chunks() if self.texts else pa.array([], pa.large_string())
        names = pa.array(list(self.langs), pa.string())
        for at in range(0, len(self.keys), 20_000):
            some = slice(at, at + 20_000)
            yield _named(names.take(pa.array(self.lang[some])), (self.keys[some] & np.uint64(7)).astype(np.int32),
                         texts.take(pa.array(self.text[some])).cast(pa.string()), self.n[some])


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, sample: int = SAMPLE, id_col: str = "doc_id",
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts (A-Z lower-cased) are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, pieces into words
    ``[^\\x20\\x09]+``. A phrase of 2 to 5 words with a >= ``min_count`` scores
    floor(1000 a n / (l r)) at its lowest-scoring cut (ties: the first); those inside a longer one
    that is as frequent are dropped.
    """
    found, totals = frequent_phrases(docs, min_count, sample, id_col, text_col, lang_col)
    spark = docs.sparkSession
    words = F.split("phrase", " ", -1)
    cut = found.where("m > 1").withColumn("w", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cut = cut.select("lang", "m", "phrase", F.col("f").alias("a"), "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("head"),
                     F.expr("array_join(slice(w, k + 1, m - k), ' ')").alias("tail"))
    part = [found.select(F.col("lang").alias(f"{x}_lang"), F.col("phrase").alias(f"{x}_phrase"), F.col("f").alias(x)) for x in ("l", "r")]
    cut = cut.join(part[0], (F.col("lang") == F.col("l_lang")) & (F.col("head") == F.col("l_phrase")))
    cut = cut.join(part[1], (F.col("lang") == F.col("r_lang")) & (F.col("tail") == F.col("r_phrase")))
    totals = totals.select(F.col("lang").alias("n_lang"), "n")
    cut = cut.join(F.broadcast(totals) if few_rows(totals, BROADCAST_LANGS) else totals, F.col("lang") == F.col("n_lang"))
    # whole decimals of 38 digits: a and n below 10^17 each, far beyond any corpus
    score = F.expr("cast(1000 * cast(a as decimal(18,0)) as decimal(20,0)) * cast(n as decimal(18,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    best = (cut.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("s"), F.first("m").alias("m"), F.first("a").alias("a"), F.first("n").alias("n")))
    best = materialise(best.select("lang", "phrase", "m", "a", "s.l", "s.r", "n", "s.score"), "phrase-scored")
    inner = F.expr("flatten(transform(sequence(2, m - 1), len -> transform(sequence(1, m - len + 1), i -> array_join(slice(w, i, len), ' '))))")
    longer = (found.where("m > 2").withColumn("w", words).select("lang", "f", F.explode(inner).alias("inside"))
              .groupBy(F.col("lang").alias("of_lang"), "inside").agg(F.max("f").alias("most")))
    kept = best.join(longer, (F.col("lang") == F.col("of_lang")) & (F.col("phrase") == F.col("inside")) & (F.col("most") * 100 >= F.col("a") * 100), "left_anti")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # the first of each hash part of a language, then of the language: no group of all its phrases
    parts = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(wanted_partitions(spark))))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
