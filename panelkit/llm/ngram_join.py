"""Self-join on n-gram Jaccard similarity (operator 9): T-occurrence search with DivideSkip.

Search. For a document with n grams, a linked one shares at least T of them. Over the
inverted lists of its grams, the L longest lists are set apart; the short ones are merged
and counted, candidates with T - L occurrences stay, and the long lists are probed for
those candidates alone by binary search. The merge of the sorted short lists runs as one
numpy count over all of them, and the probes of all candidates as one binary search; L follows
the published rule T / (mu log M + 1), M the longest list. Candidates that reach the overlap
their own size needs are links.

Distribution. The lists are built per block of documents; blocks must hold every pair that
can link. Sizes fall into classes by the factor 1 / threshold, so linked sizes share a class
or are neighbours. On each of these levels linked sets differ in at most D elements. The hash
space is cut into ranges; each document gives one hash for each range that it has elements in,
and level. If one of a pair has elements in more than D ranges, the elements of at least one of
them are the same in both. A document with fewer repeats this with another hash; both of a
pair do so if neither has enough. Documents with equal
hashes form routing groups (connected components), which are searched block by block. The
smallest hashes of each document are joined first: documents that they connect count as one node
when all hashes meet, and do not give the same edge in range after range. No order by frequency is needed, so nothing about the corpus is broadcast, and frequent grams
alone never bring documents together.

Documents with the same set are one class; only classes are searched, with their number of
copies. Groups of more than ``BLOCK_DOCS`` classes are cut into blocks, those of more than
``WHOLE_BLOCKS`` by size level first, as linked sizes share a level or are neighbours; each pair
of blocks that can link is one task; a task gives one row per class (links counted, and the smallest class it is
connected to there), never pairs. A last round of components joins these.

Cases: texts without words and null texts have an empty set, link with nothing and are their
own component; texts with fewer words than a gram have one gram, the whole sequence; rows that
repeat an id count as documents of their own; a null id is a document, and is reported as
component only where no id of the component is known; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm._common import SLICE_BYTES, coded, doc_texts, few_rows, gather, materialise, mix64, slices, split_words, starts_of, strings
from panelkit.llm.components import components

GRAM = 3
THRESHOLD = (90, 100)
BLOCK_DOCS = 2048
BLOCK_GRAMS = 2_000_000
#: Blocks of a group up to which it is not cut by size.
WHOLE_BLOCKS = 3
#: Blocks of a level, more than there can be.
CELLS = 1 << 32
#: Representatives sent to all executors instead of a shuffle of the texts, at most.
BROADCAST_ROWS = 500_000
#: Differences from which ranges are hashed by two of three.
THREES_FROM = 8
#: Grams whose routes go to one range of the hash.
ROUTES_A_BUCKET = 1_000_000
#: Smallest routes of a document that are joined before all of them meet.
SKETCH = 8
MU = 0.5

_ODD = np.random.default_rng(11).integers(1, 2 ** 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_sets(texts: pa.Array, gram: int = GRAM) -> list[np.ndarray]:
    """Sorted distinct 64-bit gram hashes of each text, A-Z lower-cased."""
    import xxhash

    words, counts = split_words(pc.ascii_lower(strings(texts)))
    distinct, codes = coded(words)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))[codes]
    at = starts_of(counts)
    with np.errstate(over="ignore"):
        m = max(len(hashes) - gram + 1, 0)
        grams = np.zeros(m, np.uint64)
        for k in range(gram):
            grams += hashes[k:k + m] * _ODD[k]
        out = []
        for d, n in enumerate(counts.tolist()):
            if n >= gram:
                out.append(np.unique(grams[at[d]:at[d] + n - gram + 1]))
            elif n:
                short = np.uint64(n) * _ODD[gram]
                for k in range(n):
                    short += hashes[at[d] + k] * _ODD[k]
                out.append(np.array([short], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def unzipped_sets(texts: pa.ChunkedArray, rows: list[int], gram: int) -> list[np.ndarray]:
    """``gram_sets`` of some compressed texts, about ``SLICE_BYTES`` unpacked at once."""
    import zstandard

    unzip, out, held, size = zstandard.ZstdDecompressor(), [], [], 0
    for k in rows:
        held.append(unzip.decompress(texts[k].as_py()))
        size += len(held[-1])
        if size > SLICE_BYTES or k == rows[-1]:
            out += gram_sets(pa.array(held, pa.large_binary()).view(pa.large_string()), gram)
            held, size = [], 0
    return out


def class_keys(sets: list[np.ndarray]) -> list[bytes]:
    """A 128-bit key of each set."""
    out = []
    for s in sets:
        with np.errstate(over="ignore"):
            a = int(mix64(s).sum(dtype=np.uint64)) ^ len(s)
            b = int(mix64(s ^ _ODD[20]).sum(dtype=np.uint64))
        out.append(a.to_bytes(8, "big") + b.to_bytes(8, "big"))
    return out


def route_hashes(sets: list[np.ndarray], threshold: tuple[int, int] = THRESHOLD) -> list[np.ndarray]:
    """Routing hashes of each set (int64): linked sets have one in common."""
    num, den = threshold
    if 4 * num < 3 * den:
        raise ValueError("routing needs a threshold of 0.75 or more")
    factor = den / num * (1 + 1e-6)
    out: list[list[np.ndarray]] = [[] for _ in sets]
    sizes = np.array([len(s) for s in sets], np.int64)
    todo = [(d, s) for d, s in enumerate(sets) if len(s)]
    for down in (0, 1):
        pending, seed = todo, 0
        while pending:
            owners = np.array([d for d, _ in pending], np.int64)
            flat = np.concatenate([s for _, s in pending])
            lens = sizes[owners]
            level = np.floor(np.log(lens) / math.log(factor)).astype(np.int64) - down
            most = np.ceil(factor ** (level + 2))
            # |A ^ B| <= (|A| + |B|) (1 - t) / (1 + t)
            differ = np.floor(2 * most * (den - num) / (den + num) + 1e-9).astype(np.int64)
            # many differences: groups of three ranges, of which one has at most one difference
            threes = (differ >= THREES_FROM) & (5 * num >= 4 * den)  # below 0.8 too few elements for the ranges
            groups = differ // 2 + 2 + differ // 8
            ranges = np.where(threes, 3 * groups, differ + 1 + differ // (4 if 20 * num >= 17 * den else 2))
            who = np.repeat(np.arange(len(owners)), lens)
            if seed:
                flat = mix64(flat ^ _ODD[30 + seed % 30])
                flat = flat[np.lexsort((flat, who))]
            part = ((flat >> np.uint64(32)) * ranges[who].astype(np.uint64)) >> np.uint64(32)
            new = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (who[1:] != who[:-1])])
            base = starts_of(ranges)
            cell = base[who[new]] + part[new].astype(np.int64)
            filled, sums = np.zeros(base[-1], bool), np.zeros(base[-1], np.uint64)
            filled[cell], sums[cell] = True, np.add.reduceat(mix64(flat), new)
            with np.errstate(over="ignore"):
                tags = (level.astype(np.uint64) * _ODD[0] + np.uint64(seed) * _ODD[2] + ranges.astype(np.uint64) * _ODD[3])
                one = np.flatnonzero(filled & ~np.repeat(threes, ranges))
                at = np.repeat(np.arange(len(owners)), ranges)
                keys, of = [sums[one] + tags[at[one]] + (one - base[at[one]]).astype(np.uint64) * _ODD[1]], [at[one]]
                first = gather(base[:-1][threes], groups[threes] * 3)[::3]
                for x, y in ((0, 1), (0, 2), (1, 2)):
                    some = first[filled[first + x] | filled[first + y]]
                    place = (3 * (some - base[at[some]]) + x + y).astype(np.uint64)
                    keys.append(sums[some + x] + sums[some + y] + tags[at[some]] + place * _ODD[1] + _ODD[4])
                    of.append(at[some])
                keys, of = mix64(np.concatenate(keys)).astype(np.int64), np.concatenate(of)
            order = np.argsort(of, kind="stable")
            keys, cut = keys[order], starts_of(np.bincount(of, minlength=len(owners)))
            for k, d in enumerate(owners.tolist()):
                out[d].append(keys[cut[k]:cut[k + 1]])
            # enough: more ranges with elements than differences, or more groups with elements in two
            # ranges than can have two differences
            full = np.bincount(who[new], minlength=len(owners))
            good = filled[first].astype(int) + filled[first + 1] + filled[first + 2] >= 2
            full = np.where(threes, 2 * np.bincount(at[first[good]], minlength=len(owners)) - 1, full)
            pending = [pending[k] for k in np.flatnonzero(full <= differ)]
            seed += 1
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


class Lists:
    """Inverted lists of the sets of a block, each sorted."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.at = starts_of(self.sizes)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        new = np.r_[True, flat[1:] != flat[:-1]] if len(flat) else np.zeros(0, bool)
        self.n_grams = int(new.sum())
        self.begin = np.append(np.flatnonzero(new), len(flat))
        self.lens = np.diff(self.begin)
        del flat
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        self.docs = owner[order]  # in ascending order within a list
        self.codes = np.empty(len(order), np.int32)
        self.codes[order] = np.cumsum(new, dtype=np.int32) - 1
        # one key for each (document, gram), ascending as the sets are: the target of the binary probes
        self.keys = owner * np.int64(self.n_grams) + self.codes

    def search(self, q: int, threshold: tuple[int, int] = THRESHOLD, mu: float = MU) -> np.ndarray:
        """Documents after ``q`` that link with it: DivideSkip."""
        num, den = threshold
        n = int(self.sizes[q])
        own = self.codes[self.at[q]:self.at[q + 1]]
        own = own[np.argsort(self.lens[own], kind="stable")]
        least = -(-n * num // den)                 # of the overlap, over all sizes that can link
        longest = int(self.lens[own[-1]])
        apart = min(least - 1, int(least / (mu * math.log2(longest + 1) + 1)))
        short, long_ = own[:n - apart], own[n - apart:]
        merged = self.docs[gather(self.begin[short], self.lens[short])]
        counts = np.bincount(merged[merged > q], minlength=len(self.sizes))
        some = np.flatnonzero(counts >= max(1, least - apart))
        size = self.sizes[some]
        need = -(-num * (n + size) // (den + num))  # overlap that makes num / den of the union
        fits = (size * den >= n * num) & (n * den >= size * num) & (counts[some] + apart >= need)
        some, need = some[fits], need[fits]
        if not len(some):
            return some
        got = counts[some]
        if len(long_):
            wanted = (some[:, None] * self.n_grams + np.sort(long_)[None, :]).ravel()
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            got = got + (self.keys[at] == wanted).reshape(len(some), -1).sum(axis=1)
        return some[got >= need]


def links_in(sets: list[np.ndarray], side: np.ndarray, cross: bool, threshold: tuple[int, int] = THRESHOLD, within: int | None = None):
    """(q, linked) over a block; with ``cross`` only pairs of different sides, and those of side ``within``."""
    lists = Lists(sets)
    for q in range(len(sets)):
        some = lists.search(q, threshold)
        if cross:
            some = some[(side[some] != side[q]) | (side[q] == within)]
        if len(some):
            yield q, some


def jaccard_join(docs: DataFrame, gram: int = GRAM, threshold: tuple[int, int] = THRESHOLD,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, n_links, class_key, component_key, text_hash.

    ``n_links`` counts the other documents it links with, copies of equal sets included;
    ``class_key`` (null for empty sets) is the same for equal sets, ``component_key`` the
    smallest class of the component.
    """
    rows = doc_texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))

    def describe(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = gram_sets(part.column("text"), gram)
                keys = class_keys(sets)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "text_hash": part.column("text_hash"),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "sketch": sketches(route_hashes(sets, threshold)),
                    "node": nodes_of(keys), "cls": pa.array([key if len(s) else None for key, s in zip(keys, sets)], pa.binary())})

    described = materialise(rows.mapInArrow(
        describe, "doc_id long, text_hash long, n long, sketch array<long>, node long, cls binary"), "ngram-described")
    classes = materialise(
        described.where("cls is not null").groupBy("cls").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("node").alias("of_node"),
            F.min(F.struct("doc_id", "text_hash")).alias("rep")), "ngram-classes")

    # routing groups: the first node of each routing hash is the hub of the others. Routes are made where they
    # are packed; to keep them beside the documents would take more room than the texts
    total = described.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // ROUTES_A_BUCKET))
    early = components(_sketch_edges(described), "ngram-early")
    known = described.join(early.withColumnRenamed("node", "of"), (F.col("node") == F.col("of")) & (F.col("label") != F.col("of")))
    known = materialise(known.select(F.col("doc_id").alias("known_id"), F.col("text_hash").alias("known_hash"), "label").distinct(), "ngram-known")
    # size check, as for the representatives
    known_rows = F.broadcast(known) if few_rows(known, BROADCAST_ROWS) else known
    named = rows.join(known_rows, F.col("doc_id").eqNullSafe(F.col("known_id")) & F.col("text_hash").eqNullSafe(F.col("known_hash")), "left")

    def route(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = gram_sets(part.column("text"), gram)
                first = {key: k for k, key in enumerate(class_keys(sets)) if len(sets[k])}  # copies in a slice route once
                if first:
                    some = pa.array(list(first.values()))
                    nodes = pc.coalesce(part.column("label").take(some), pa.array(nodes_of(list(first)))).to_numpy(zero_copy_only=False)
                    yield pack_routes(route_hashes([sets[k] for k in first.values()], threshold), nodes, buckets)

    late = _stars(named.select("text", "label").mapInArrow(route, PACKED))
    groups = components(late.unionByName(early.select(F.col("node").alias("a"), F.col("label").alias("b"))), "ngram-groups")

    members = groups.join(classes, F.col("node") == F.col("of_node")).select("cls", F.col("label").alias("grp"), "copies", "n", "rep")
    def blocks_of(rows, *by):
        sums = rows.groupBy(*by).agg(F.count("*").alias("docs"), F.sum("n").alias("grams"))
        return sums.select(*[F.col(c).alias(f"of_{c}") for c in by], F.greatest(
            F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("long").alias("blocks"))

    # linked sizes lie on the same or neighbouring levels: a large group is cut into levels first
    members = members.join(blocks_of(members, "grp"), F.col("grp") == F.col("of_grp"))
    width = math.log(threshold[1] / threshold[0] * (1 + 1e-6))
    level = F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("long")
    members = materialise(members.withColumn("level", F.when(F.col("blocks") > WHOLE_BLOCKS, level).otherwise(F.lit(0).cast("long")))
                          .drop("of_grp", "blocks"), "ngram-levels")
    cells = blocks_of(members, "grp", "level").groupBy("of_grp").agg(  # a group has few levels: their number grows with the log of the sizes
        F.map_from_entries(F.collect_list(F.struct("of_level", "blocks"))).alias("cells"))
    members = members.join(cells, F.col("grp") == F.col("of_grp"))
    near = [F.coalesce(F.try_element_at("cells", F.col("level") + x), F.lit(0)).alias(c) for x, c in ((0, "here"), (-1, "below"), (1, "above"))]
    members = members.select("cls", "grp", "copies", "level", *near, "rep")
    members = materialise(members.select("cls", "grp", "copies", "level", "here", "below", "above", F.pmod(F.xxhash64("cls"), F.col("here")).alias("block"),
                                         F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash")), "ngram-members")
    # size check: the representatives go to all executors, or else both sides are shuffled
    reps = F.broadcast(members) if few_rows(members, BROADCAST_ROWS) else members
    texts = rows.join(reps, F.col("doc_id").eqNullSafe(F.col("rep_id")) & F.col("text_hash").eqNullSafe(F.col("rep_hash")))
    # cells (level, block) as one number; a cell's own pairs are found with the first cell above it
    pairs = F.expr(f"""concat(
        filter(transform(sequence(0L, here - 1), x -> struct(level * {CELLS} + least(x, block) as i, level * {CELLS} + greatest(x, block) as j)),
               p -> above = 0 or p.i <> p.j),
        if(above = 0, array(), transform(sequence(0L, greatest(above, 1) - 1), x -> struct(level * {CELLS} + block as i, (level + 1) * {CELLS} + x as j))),
        if(below = 0, array(), transform(sequence(0L, greatest(below, 1) - 1), x -> struct((level - 1) * {CELLS} + x as i, level * {CELLS} + block as j))))""")
    texts = texts.select("cls", "grp", "copies", (F.col("level") * CELLS + F.col("block")).alias("cell"), pairs.alias("pairs"), "text")

    # the texts travel, compressed: they take less room than the hashes of their grams
    def zipped(batches):
        import zstandard

        zip_ = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("cls", "grp", "copies", "cell", "pairs")]
                    + [pa.array(map(zip_.compress, part.column("text").cast(pa.binary()).to_pylist()), pa.binary())],
                    names=["cls", "grp", "copies", "cell", "pairs", "text"])

    blocks = texts.mapInArrow(zipped, "cls binary, grp long, copies long, cell long, pairs array<struct<i: long, j: long>>, text binary")
    blocks = blocks.withColumn("pair", F.explode("pairs")).select("cls", "grp", "copies", "cell", "pair.i", "pair.j", "text")

    def search(table: pa.Table) -> pa.Table:
        cls = table.column("cls").to_pylist()
        keep = list({c: k for k, c in enumerate(cls)}.values())  # repeated equal rows once
        keep.sort(key=lambda k: cls[k])
        cls = [cls[k] for k in keep]
        copies = table.column("copies").to_numpy()[keep]
        side = table.column("cell").to_numpy()[keep]
        sets = unzipped_sets(table.column("text"), keep, gram)
        root, n_links = list(range(len(cls))), np.zeros(len(cls), np.int64)

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        own = i if j == (i // CELLS + 1) * CELLS else None
        for q, some in links_in(sets, side, i != j, threshold, own):
            n_links[q] += copies[some].sum()
            n_links[some] += copies[q]
            for k in some.tolist():
                a, b = find(q), find(k)
                if a != b:
                    root[max(a, b)] = min(a, b)
        return pa.table({"cls": pa.array(cls, pa.binary()), "hub": pa.array([cls[find(k)] for k in range(len(cls))], pa.binary()),
                         "n_links": n_links})

    found = materialise(blocks.groupBy("grp", "i", "j").applyInArrow(search, "cls binary, hub binary, n_links long"), "ngram-found")
    linked = components(found.where("cls <> hub").select(F.col("cls").alias("a"), F.col("hub").alias("b")), "ngram-linked")
    n_links = found.groupBy("cls").agg(F.sum("n_links").alias("links")).select(F.col("cls").alias("link_cls"), "links")
    named = (classes.join(linked, F.col("cls") == F.col("node"), "left")
             .select("cls", "first_id", "copies", F.coalesce("label", "cls").alias("label")))
    ids = named.groupBy("label").agg(F.min("first_id").alias("component_id")).withColumnRenamed("label", "of")
    named = (named.join(ids, F.col("label") == F.col("of")).join(n_links, F.col("cls") == F.col("link_cls"), "left")
             .select(F.col("cls").alias("own"), "component_id", F.col("label").alias("component_key"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = described.select("doc_id", "text_hash", "n", "cls").join(named, F.col("cls") == F.col("own"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("cls").alias("class_key"), "component_key", "text_hash")


#: Columns of packed routes.
PACKED = "bucket long, routes binary, nodes binary, counts binary, edges binary"


def nodes_of(keys: list[bytes]) -> np.ndarray:
    """The first 8 bytes of class keys. Classes of one node share a routing group, no more."""
    return np.frombuffer(b"".join(keys), ">i8").reshape(-1, 2)[:, 0].astype(np.int64)


def sketches(routes: list[np.ndarray]) -> pa.Array:
    """The ``SKETCH`` smallest routes of each set."""
    least = [np.partition(r, SKETCH - 1)[:SKETCH] if len(r) > SKETCH else r for r in routes]
    flat = np.concatenate([*least, np.zeros(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(starts_of(np.array([len(r) for r in least], np.int64)).astype(np.int32)), pa.array(flat, pa.int64()))


def _sketch_edges(described: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the nodes of each route of the sketches."""
    routes = described.select("node", F.explode("sketch").alias("route")).distinct()
    shared = routes.groupBy("route").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b < most")
    return routes.withColumnRenamed("node", "a").join(shared.select("route", "b"), "route").where("a <> b").select("a", "b")


def _first_of_route(routes: np.ndarray, nodes: np.ndarray):
    """(routes once each in ascending order, smallest node of each, distinct (node, smallest node) pairs of the
    routes that several nodes have)."""
    order = np.lexsort((nodes, routes))
    routes, nodes = routes[order], nodes[order]
    first = np.r_[True, routes[1:] != routes[:-1]]
    hub = nodes[first][np.cumsum(first) - 1]
    other = nodes != hub
    return routes[first], nodes[first], np.unique(np.stack([nodes[other], hub[other]], axis=1), axis=0)


def pack_routes(routes: list[np.ndarray], nodes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The routes of a slice by range of the hash. Each route goes on once, held by its smallest node,
    as its low 5 bytes (equal low bytes in a range only make groups larger); the slice's own
    edges travel along."""
    flat = np.concatenate(routes).view(np.uint64)
    flat, owner, pairs = _first_of_route(flat, np.repeat(nodes, [len(r) for r in routes]))
    bucket = (flat >> np.uint64(32)).astype(np.int64) * buckets >> 32
    order = np.lexsort((owner, bucket))  # a node's routes of a bucket side by side
    flat, owner, bucket = flat[order], owner[order], bucket[order]
    low = flat.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].copy()
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    runs = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (bucket[1:] != bucket[:-1]), True])
    lens = np.diff(runs)
    pieces = -(-lens // 255)  # a run's length in bytes of its own
    counts = np.full(int(pieces.sum()), 255, np.uint8)
    counts[np.cumsum(pieces) - 1] = lens - 255 * (pieces - 1)
    held = np.repeat(owner[runs[:-1]], pieces)
    at = np.r_[0, np.cumsum(pieces)][np.searchsorted(runs, cuts)]
    n = len(cuts) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts[:-1]]),
         pa.array([low[cuts[k]:cuts[k + 1]].tobytes() for k in range(n)], pa.binary()),
         pa.array([held[at[k]:at[k + 1]].tobytes() for k in range(n)], pa.binary()),
         pa.array([counts[at[k]:at[k + 1]].tobytes() for k in range(n)], pa.binary()),
         pa.array([pairs[k::n].tobytes() for k in range(n)], pa.binary())],
        names=["bucket", "routes", "nodes", "counts", "edges"])


def _stars(packed: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the nodes of each shared route; routes of one node give none.

    A range holds some ``ROUTES_A_BUCKET`` routes at any size of the input, and a route of very
    many rows is one entry of each slice that has it. The nodes that the sketches connect are one
    node here, so they give no edges, however many ranges they share routes in.
    """
    def meet(table: pa.Table) -> pa.Table:
        routes, nodes, counts, edges = (b"".join(table.column(c).to_pylist()) for c in ("routes", "nodes", "counts", "edges"))
        low = np.zeros((len(routes) // 5, 8), np.uint8)
        low[:, :5] = np.frombuffer(routes, np.uint8).reshape(-1, 5)
        _, _, pairs = _first_of_route(low.view("<u8").ravel(), np.repeat(np.frombuffer(nodes, np.int64), np.frombuffer(counts, np.uint8)))
        both = np.concatenate([np.frombuffer(edges, np.int64).reshape(-1, 2), pairs])
        return pa.table({"a": both[:, 0], "b": both[:, 1]})

    return packed.groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def keep_one(docs: DataFrame, gram: int = GRAM, threshold: tuple[int, int] = THRESHOLD,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component (that of the smallest id), with the columns of ``docs``.

    Empty texts are no copies of each other and all stay. A component of null ids alone
    keeps the row with the smallest text hash.
    """
    joined = materialise(jaccard_join(docs, gram, threshold, id_col, text_col).where("n_links > 0"), "ngram-linked-docs")
    first = joined.groupBy("component_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("f"))  # null ids last
    same = F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("text_hash") == F.col("f.text_hash"))
    marked = joined.join(first.withColumnRenamed("component_key", "of"), F.col("component_key") == F.col("of"))
    gone = materialise(marked.where(~same).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "ngram-gone")
    twice = materialise(marked.where(same).groupBy("doc_id", "text_hash").count().where("count > 1")
                        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), "ngram-twice")

    def on(rows):  # size check: few rows go to all executors, else both sides are shuffled
        key = (F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("_id"))
               & (F.xxhash64(F.col(f"`{text_col}`").cast("string")) == F.col("_hash")))
        return (F.broadcast(rows) if few_rows(rows, BROADCAST_ROWS) else rows), key

    left = docs.join(*on(gone), "left_anti")
    if twice.isEmpty():
        return left
    # rows that repeat id and text of a kept one: one of each stays
    again, key = on(twice)
    nth = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(F.lit(0)))
    one = left.join(again, key).withColumn("_nth", nth).where("_nth = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
    return left.join(again, key, "left_anti").unionByName(one)
