"""Near duplicates by 64-bit fingerprints (operator 12): a Gray-order hierarchical index.

Fingerprint. Words of the lower-cased text (A-Z), shingles of ``GRAM`` words with repeats, joined
by one space (fewer words: the whole sequence); a bit is 1 if it is set in over half of the
shingles' XXH64 values (seed 42). Equal fingerprints are one entry of the index.

Index. Fingerprints are sorted by Gray rank (position in the reflected Gray sequence), so
neighbours differ in few bits. Every ``FAN`` neighbours make a node; a node holds the bits that
all below it share (a mask and a pattern), upper nodes likewise over nodes, and a lower node is
charged only for the bits its parent has not factored out. A search goes down level by level
with all its fingerprints at once, adds up the differences, and drops a node, with all below it,
when they exceed ``LIMIT``; at the leaves the sum is the distance.

Distribution. Of LIMIT + 1 = 3 runs of bits one is equal in two fingerprints that link. Each
fingerprint goes into three tables, rotated so that one run leads; the leading run is the first
upper node, and entries that differ in it need not meet, so tables are dealt by it. A leading
run with more than ``MAX_GROUP`` entries is dealt again by the runs of its other bits, in two
further steps; 19 or fewer bits are free then, so no group has more than 2^19 entries, however
many copies or near copies there are. Tasks take whole groups, sorted, in blocks of ``BLOCK``
entries, and give one row per linked entry (the smallest one of its part of the block), never
pairs; a last round of components joins these. Nothing is broadcast or collected.

Cases: null and empty texts and texts without words have fingerprint zero, which links like any
other. Rows that repeat an id are documents of their own; a null id is a document, reported as
component only where no id of the component is known; an empty table gives no rows; further
columns are left out. Very long texts are handled in slices of shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm._common import doc_texts, gather, materialise, slices, split_words, starts_of, strings
from panelkit.llm.components import components

GRAM = 3
SEED = 42
#: Differing bits of a link, at most.
LIMIT = 2
#: Children of a node.
FAN = 8
#: Entries of a leading run that one task may take.
MAX_GROUP = 32_768
#: Entries of one index in a task, unless a group has more.
BLOCK = 65_536
#: Searches that go down together.
BATCH = 2_048
#: Shingles whose bits are counted at once.
COUNTED = 65_536


def fingerprints(texts: pa.Array, gram: int = GRAM) -> np.ndarray:
    """The fingerprint of each text (uint64)."""
    import xxhash

    words, counts = split_words(pc.ascii_lower(strings(texts)))
    first = starts_of(counts)
    # all words in a row, a space after each: a shingle is one stretch of it
    line = pc.binary_join_element_wise(words.cast(pa.large_string()), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    places = np.frombuffer(line.buffers()[1], np.int64)[line.offset:line.offset + len(line) + 1] if len(line) else np.zeros(1, np.int64)
    data = (line.buffers()[2] or b"") if len(line) else b""
    data = data.to_pybytes() if hasattr(data, "to_pybytes") else data
    shingles = np.where(counts >= gram, counts - gram + 1, np.minimum(counts, 1))
    width = np.minimum(counts, gram)
    begin = gather(first[:-1], shingles)
    end = begin + np.repeat(width, shingles)
    owner = np.repeat(np.arange(len(counts)), shingles)
    ones = np.zeros((len(counts), 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(begin), COUNTED):
        b, e, who = places[begin[at:at + COUNTED]], places[end[at:at + COUNTED]] - 1, owner[at:at + COUNTED]
        h = np.fromiter((digest(data[x:y], SEED) for x, y in zip(b.tolist(), e.tolist())), np.uint64, len(b))
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        new = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        ones[who[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > shingles[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Nodes over distinct codes in Gray order; level 0 is the codes themselves."""

    def __init__(self, codes: np.ndarray, fan: int = FAN):
        self.fan = fan
        self.order = np.argsort(gray_rank(codes), kind="stable")
        everything = np.full(len(codes), ~np.uint64(0), np.uint64)
        self.levels = [(codes[self.order], everything)]  # (pattern, mask) of each node
        while len(self.levels[-1][0]) > fan:
            pattern, mask = self.levels[-1]
            first = np.arange(0, len(pattern), fan)
            ones, zeros = np.bitwise_and.reduceat(pattern, first), np.bitwise_and.reduceat(~pattern, first)
            shared = np.bitwise_and.reduceat(mask, first) & (ones | zeros)
            self.levels.append((ones & shared, shared))
        # the bits a node adds to those of its parent
        self.added = []
        for k, (_, mask) in enumerate(self.levels):
            above = self.levels[k + 1][1][np.arange(len(mask)) // fan] if k + 1 < len(self.levels) else np.uint64(0)
            self.added.append(mask & ~above)

    def _charge(self, level: int, query: np.ndarray, node: np.ndarray, so_far, limit: int):
        far = so_far + np.bitwise_count((query ^ self.levels[level][0][node]) & self.added[level][node]).astype(np.int64)
        return far, far <= limit

    def links(self, queries: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (q, k), q < k, of positions in Gray order that differ in ``limit`` bits or fewer."""
        codes = self.levels[0][0]
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        who, node = np.repeat(queries, n), np.tile(np.arange(n), len(queries))
        so_far, level = np.zeros(len(who), np.int64), top
        while True:
            span = self.fan ** level
            later = (node + 1) * span > who + 1  # a code after the query lies below
            who, node, so_far = who[later], node[later], so_far[later]
            far, near = self._charge(level, codes[who], node, so_far, limit)
            who, node, so_far = who[near], node[near], far[near]
            if level == 0:
                return who, node
            level -= 1
            first = node * self.fan
            width = np.minimum(self.fan, len(self.levels[level][0]) - first)
            node = gather(first, width)
            who, so_far = np.repeat(who, width), np.repeat(so_far, width)


def roots(codes: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in Gray order, and for each the position of the first one links reach."""
    index = GrayIndex(codes)
    n = len(codes)
    root = np.arange(n)
    for at in range(0, n, BATCH):
        a, b = index.links(np.arange(at, min(n, at + BATCH)), limit)
        while len(a):
            a, b = root[a], root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return index.order, root


def deal(path: np.ndarray, lead: np.ndarray, code: np.ndarray, steps: int = LIMIT + 1):
    """Each code ``steps`` times, each time with another run of its bits after the first ``lead``
    rotated to the front of them: (path, lead, code, source row)."""
    out = []
    for k in range(steps):
        free = 64 - lead
        begin, stop = free * k // steps, free * (k + 1) // steps
        low = np.where(lead > 0, (np.uint64(1) << (free % 64).astype(np.uint64)) - np.uint64(1), ~np.uint64(0))
        turn = begin.astype(np.uint64)
        back = np.where(begin > 0, (free - begin) % 64, 0).astype(np.uint64)
        rest = code & low
        turned = np.where(begin > 0, ((rest << turn) | (rest >> back)) & low, rest)
        out.append((path * steps + k, lead + stop - begin, (code & ~low) | turned, np.arange(len(code))))
    return [np.concatenate(x) for x in zip(*out)]


_TABLE = "path int, lead int, run long, code long, print long"


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of (path, lead, code, print) dealt by the runs of their free bits."""
    def run(batches):
        for batch in batches:
            path, lead, code, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("path", "lead", "code", "print"))
            path, lead, code, at = deal(path.astype(np.int64), lead.astype(np.int64), code.view(np.uint64))
            leading = code >> (64 - lead).astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(path, pa.int32()), pa.array(lead, pa.int32()), pa.array(leading.view(np.int64)), pa.array(code.view(np.int64)),
                 pa.array(own[at])], names=["path", "lead", "run", "code", "print"])

    return rows.select("path", "lead", "code", "print").mapInArrow(run, _TABLE)


def _searched(rows: DataFrame, limit: int) -> DataFrame:
    """(a, b): each linked entry and the first one that its links reach in its block."""
    def blocks(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < BLOCK:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            group = table.column("path").to_numpy().astype(np.int64), table.column("run").to_numpy()
            new = np.flatnonzero((group[0][1:] != group[0][:-1]) | (group[1][1:] != group[1][:-1])) + 1
            if len(new):  # the last group may go on
                yield table.slice(0, int(new[-1]))
                table = table.slice(int(new[-1]))
            held, n = table.to_batches(), table.num_rows
        if n:
            yield pa.Table.from_batches(held)

    def run(batches):
        for table in blocks(batches):
            paths = table.column("path").to_numpy()
            codes, own = table.column("code").to_numpy().view(np.uint64), table.column("print").to_numpy()
            for path in np.unique(paths):
                some = np.flatnonzero(paths == path)
                order, root = roots(codes[some], limit)
                prints = own[some][order]
                linked = np.flatnonzero(root != np.arange(len(root)))
                if len(linked):
                    yield pa.RecordBatch.from_arrays([pa.array(prints[linked]), pa.array(prints[root[linked]])], names=["a", "b"])

    return rows.repartition("path", "run").sortWithinPartitions("path", "run").mapInArrow(run, "a long, b long")


def links(prints: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(a, b) over distinct fingerprints (column print), enough of them to connect all that link.

    Only ``limit`` = 2 or fewer: three runs of bits are dealt.
    """
    if not 0 <= limit <= LIMIT:
        raise ValueError("three runs of bits find two differing bits at most")
    rows = materialise(_dealt(prints.select(F.lit(0).alias("path"), F.lit(0).alias("lead"), F.col("print").alias("code"), "print")), "simhash-tables")
    found = None
    for step in range(3):
        full = None
        if step < 2:  # after three steps the free bits bound a group
            full = materialise(rows.groupBy("path", "run").count().where(F.col("count") > MAX_GROUP)
                               .select(F.col("path").alias("_path"), F.col("run").alias("_run")), "simhash-full")
            full = None if full.isEmpty() else full
        same = None if full is None else (F.col("path") == F.col("_path")) & (F.col("run") == F.col("_run"))
        small = rows if full is None else rows.join(full, same, "left_anti")
        pairs = materialise(_searched(small, limit), "simhash-links")
        found = pairs if found is None else found.unionByName(pairs)
        if full is None:
            return found
        rows = materialise(_dealt(rows.join(full, same, "left_semi")), "simhash-tables")
    return found


def near_duplicates(docs: DataFrame, gram: int = GRAM, limit: int = LIMIT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    def describe(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                own = fingerprints(part.column("text"), gram)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(own.view(np.int64))], names=["doc_id", "print"])

    rows = materialise(doc_texts(docs, id_col, text_col).mapInArrow(describe, "doc_id long, print long"), "simhash-prints")
    classes = materialise(rows.groupBy("print").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    linked = components(links(classes, limit), "simhash-components")
    named = (classes.join(linked, F.col("print") == F.col("node"), "left")
             .select("print", "first_id", F.coalesce("label", "print").alias("label")))
    ids = named.groupBy("label").agg(F.min("first_id").alias("component_id")).withColumnRenamed("label", "of")
    named = named.join(ids, F.col("label") == F.col("of")).select(F.col("print").alias("own"), "component_id")
    out = rows.join(named, F.col("print") == F.col("own"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
