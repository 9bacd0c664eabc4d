"""Suffix-array dedup (op 5) and n-gram join (op 9) against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelkit.llm import ngram_join, suffix_dedup
from panelkit.llm.components import components


def prose(own, n):
    return " ".join("".join(own.choice("abcdeé") for _ in range(own.randint(1, 6))) for _ in range(n))


def near_copies(seed=4):
    """Texts with copies, near copies, shared passages, and odd cases."""
    own = random.Random(seed)
    passage, rows = prose(own, 40), []
    for k in range(60):
        rows.append((k, prose(own, own.randint(1, 150)) + (" " + passage + " " + prose(own, 20) if k % 3 == 0 else "")))
    for k in range(40):
        words = rows[k % 7][1].split(" ")
        for _ in range(own.randint(0, 4)):
            words[own.randrange(len(words))] = prose(own, 1)
        rows.append((100 + k, " ".join(words)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one"), (204, "ONE"), (205, "one two"), (206, "x" * 3000),
             (207, "x" * 3000), (208, "ab" * 40), (50, rows[3][1]), (50, rows[3][1]), (None, rows[4][1]), (None, rows[9][1]),
             (209, rows[2][1].upper())]
    own.shuffle(rows)
    return rows


@given(st.lists(st.sampled_from([97, 98, 99, 0, 255]), max_size=80))
@settings(max_examples=300, deadline=None)
def test_suffix_order_is_the_suffix_array(values):
    text = bytes(values)
    assert suffix_dedup.suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_order_of_runs():
    for text in (b"", b"a", b"a" * 500, b"ab" * 300, b"ba" * 300, b"mississippi" * 9):
        assert suffix_dedup.suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute_removal(rows):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, sha)} straight from the definition."""
    big = float("inf")
    seen: dict[bytes, float] = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            w = b[i:i + 50]
            seen[w] = min(seen.get(w, big), big if d is None else d)
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if seen[b[i:i + 50]] < (big if d is None else d):
                gone[i:i + 50] = b"\1" * 50
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out[d, t] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(rest).hexdigest(), rest)
    return out


def test_removal_equals_brute_force(documents, monkeypatch):
    rows = near_copies()
    want = sorted((str(d), *v[:4]) for (d, _), v in ((r, brute_removal(rows)[r]) for r in rows))
    docs = documents(rows).repartition(5)
    got = suffix_dedup.removal_report(docs).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == want
    assert any(r.n_removed for r in got)
    # the ways beyond the size checks, and single strings of hot anchors, give the same
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ANCHORS", -1)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(suffix_dedup, "HOT_SLICES", 2)
    got = suffix_dedup.removal_report(docs).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == want


def test_anchors_with_many_contexts_are_dealt_by_strings(documents, monkeypatch):
    own = random.Random(8)
    phrase = "one and the same phrase of more than 36 bytes"  # 45 bytes, other surroundings each time

    def other(n):
        return "".join(own.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    rows = [(k, " ".join(other(60) + phrase for _ in range(4)) + other(60)) for k in range(60)]
    rows += [(100 + k, rows[k][1][30:200]) for k in range(20)]
    docs = documents(rows).repartition(3)
    groups, masks = [], suffix_dedup._masks

    def watched(contexts):
        found = {}
        for r in contexts.collect():
            for a in np.frombuffer(r.anchor, np.uint64).tolist():
                found[a] = found.get(a, 0) + 1
        groups.append(max(found.values()))
        return masks(contexts)

    monkeypatch.setattr(suffix_dedup, "_masks", watched)
    want = sorted((str(d), *v[:4]) for (d, _), v in ((r, brute_removal(rows)[r]) for r in rows))
    for most in (10 ** 6, 50):
        monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", most, raising=False)
        got = suffix_dedup.removal_report(docs).collect()
        assert sorted((str(r.doc_id), *r[1:]) for r in got) == want
    assert groups[0] >= 240 and groups[1] <= 50


def test_dedup_keeps_columns(documents):
    rows = near_copies()
    docs = documents(rows)
    want = brute_removal(rows)
    out = suffix_dedup.dedup(docs)
    assert out.columns == docs.columns
    got = sorted((str(r["doc_id"]), r["text"] or "", r["a.b"], r["text"] is None) for r in out.collect())
    assert got == sorted((str(d), want[d, t][4].decode("utf-8", "ignore"), "z", t is None) for d, t in rows)
    assert suffix_dedup.removal_report(documents([])).count() == 0


def shingles(text, gram):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= gram:
        return frozenset(tuple(words[k:k + gram]) for k in range(len(words) - gram + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def brute_join(rows, gram, num):
    sets = [shingles(t, gram) for _, t in rows]
    n, root = len(rows), list(range(len(rows)))
    links = [0] * n
    for a in range(n):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * i >= num * (len(sets[a]) + len(sets[b]) - i):
                links[a] += 1
                links[b] += 1
                ra, rb = root[a], root[b]
                root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    out = []
    for k, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if root[j] == root[k] and rows[j][0] is not None]
        out.append((str(d), len(sets[k]), str(min(ids) if ids else None), links[k]))
    return sorted(out)


def test_join_equals_brute_force(documents, monkeypatch):
    rows = near_copies()
    docs = documents(rows).repartition(4)
    for gram, num in ((3, 90), (5, 80), (2, 75)):
        got = ngram_join.jaccard_join(docs, gram, (num, 100)).collect()
        want = brute_join(rows, gram, num)
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in got) == want
    # blocks of a few documents and no broadcast give the same
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 3)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    got = ngram_join.jaccard_join(docs, 3, (90, 100)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in got) == brute_join(rows, 3, 90)
    assert ngram_join.jaccard_join(documents([])).count() == 0


def test_linked_sets_share_a_route():
    own = np.random.default_rng(2)
    for k in range(600):
        n = int(own.integers(1, 120 if k % 3 else 900))
        a = np.unique(own.integers(0, 2 ** 63, n).astype(np.uint64))
        b = a.copy()
        for _ in range(int(own.integers(0, 10 if k % 3 else 200))):
            b = np.delete(b, own.integers(len(b))) if own.random() < 0.5 and len(b) > 1 else np.append(b, np.uint64(own.integers(2 ** 63)))
        b = np.unique(b)
        i = len(np.intersect1d(a, b))
        for num in (90, 80, 75):
            if 100 * i >= num * (len(a) + len(b) - i):
                x, y = ngram_join.route_hashes([a, b], (num, 100))
                assert set(x.tolist()) & set(y.tolist())


def test_a_hot_route_is_one_entry_a_slice(spark):
    """Edges join the classes of each shared route, and no others; a route of one class alone comes back
    as nothing."""
    own = np.random.default_rng(8)
    name = int

    alone = [(name(10_000 + k), [int(x) for x in own.integers(-2 ** 63, 2 ** 63 - 1, 3)]) for k in range(100)]
    shared = [(name(k), [7, int(own.integers(-2 ** 63, 2 ** 63 - 1))]) for k in range(2000)] + [(name(1), [7])] * 50
    pairs = [(name(20_000 + k), [1000 + k // 3, 1000 + k // 3]) for k in range(60)] + [(name(30_000), [])]
    rows = alone + shared + pairs
    df = spark.createDataFrame(rows + [(name(40_000 + k % 2), list(range(5000, 6000))) for k in range(3)], "node long, routes array<long>")
    rows += [(name(40_000), list(range(5000, 6000))), (name(40_001), list(range(5000, 6000)))]

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 300):
                part = batch.slice(at, 300).to_pylist()
                yield ngram_join.pack_routes([np.array(r["routes"], np.int64) for r in part], np.array([r["node"] for r in part]), 40)

    edges = [(r.a, r.b) for r in ngram_join._stars(df.repartition(4).mapInArrow(pack, ngram_join.PACKED)).collect()]
    assert len(edges) == len(set(edges)) and all(a > b for a, b in edges)

    def reach(links):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b in links:
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
        return {x: find(x) for x in list(root)}

    hubs = {}
    for c, rs in sorted(rows):
        for r in rs:
            hubs.setdefault(r, c)
    assert reach(edges) == reach([(c, hubs[r]) for c, rs in rows for r in rs if hubs[r] != c])


def test_near_copies_give_few_edges(documents, monkeypatch):
    """Near copies share routes in many ranges of the hash, but give about one edge each, however many ranges there are."""
    own = np.random.default_rng(21)
    rows = []
    for g in range(12):
        base = [f"w{x}" for x in own.integers(0, 10 ** 6, 300)]
        for k in range(5):
            words = list(base)
            words[int(own.integers(300))] = f"x{g}y{k}"
            rows.append((len(rows), " ".join(words)))
    monkeypatch.setattr(ngram_join, "ROUTES_A_BUCKET", 300)
    late, stars = [], ngram_join._stars

    def counted(packed):
        late.append(stars(packed))
        return late[-1]

    monkeypatch.setattr(ngram_join, "_stars", counted)
    got = ngram_join.jaccard_join(documents(rows).repartition(4), 3, (90, 100)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in got) == brute_join(rows, 3, 90)
    # before the sketches: up to one for each node and range
    assert late[0].count() <= len(rows)


def test_divide_skip_finds_the_links_of_a_block():
    own = np.random.default_rng(6)
    sets = []
    for _ in range(60):
        base = sets[own.integers(len(sets))] if sets and own.random() < 0.6 else own.integers(0, 400, 40).astype(np.uint64)
        sets.append(np.unique(np.where(own.random(len(base)) < 0.06, own.integers(0, 400, len(base)).astype(np.uint64), base)))
    for mu in (0.01, 0.5, 5.0):
        lists = ngram_join.Lists(sets)
        for q in range(len(sets)):
            want = [k for k in range(q + 1, len(sets))
                    if 100 * len(np.intersect1d(sets[q], sets[k])) >= 90 * len(np.union1d(sets[q], sets[k]))]
            assert lists.search(q, mu=mu).tolist() == want


def test_keep_one_keeps_the_smallest_id(documents):
    rows = near_copies()
    out = ngram_join.keep_one(documents(rows), 3, (90, 100))
    assert out.columns == documents(rows).columns
    joined = brute_join(rows, 3, 90)
    want = {c for d, n, c, _ in joined if n}
    got = [str(r["doc_id"]) for r in out.collect() if shingles(r["text"], 3)]
    assert sorted(got) == sorted(want)
    assert sum(1 for r in out.collect() if not shingles(r["text"], 3)) == 3


def test_components_of_chains(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 99), (101, 99), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in components(links, "test").collect()}
    assert got == {**{k: 0 for k in range(41)}, 99: 99, 100: 99, 101: 99}


def test_suffix_arrays_side_by_side(monkeypatch):
    """The arrays of many texts at once are those of each text alone."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(suffix_dedup, "SIDE_BY_SIDE", 0)
    for letters in (1, 2, 4, 26):
        texts = [bytes(rng.integers(97, 97 + letters, rng.integers(1, 150)).astype(np.uint8)) for _ in range(40)]
        begin = np.cumsum([0] + [len(t) for t in texts])
        got = suffix_dedup.suffix_orders(np.frombuffer(b"".join(texts), np.uint8), begin)
        for k, t in enumerate(texts):
            assert (got[begin[k]:begin[k + 1]] - begin[k]).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_a_chained_group_is_cut_by_size(documents, monkeypatch):
    """Texts that are beginnings of one text chain into one group: sets go to blocks of near sizes only."""
    rows = [(k, " ".join(f"w{j}" for j in range(10 + 3 * k))) for k in range(120)]
    sent, plain = [], ngram_join.materialise

    def seen(df, name):
        out = plain(df, name)
        if name == "ngram-found":
            sent.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "materialise", seen)
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 6)
    got = ngram_join.jaccard_join(documents(rows), 3, (90, 100)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in got) == brute_join(rows, 3, 90)
    assert sent[0] <= 8 * len(rows)
    # any group cut by size, small ones too
    monkeypatch.setattr(ngram_join, "WHOLE_BLOCKS", 0)
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 2)
    rows = near_copies()
    got = ngram_join.jaccard_join(documents(rows), 5, (80, 100)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in got) == brute_join(rows, 5, 80)


def test_texts_travel_compressed_to_their_spans(documents):
    passage = "the same passage of more than fifty bytes stands here, in both texts of this test. "
    rows = [(1, passage * 40 + "one"), (2, "two é " + passage), (3, None), (4, ""), (5, "short")]
    docs = documents(rows)
    flagged = suffix_dedup._flagged(docs, "doc_id", "text", [])
    sizes = {r["__id"]: r.n for r in flagged.select("__id", F.length("__data").alias("n")).collect()}
    assert sizes[1] < len(rows[0][1]) / 5
    got = {r.doc_id: r for r in suffix_dedup.dedup(docs).collect()}
    assert {k: r.text for k, r in got.items()} == {1: rows[0][1], 2: "two é", 3: None, 4: "", 5: "short"}
    assert {(r.source, r["size"], r.key, r["a.b"]) for r in got.values()} == {("s", "x", "y", "z")}


def test_hashes_travel_as_distances():
    values = np.sort(np.random.default_rng(3).integers(0, 2 ** 64, 1000, dtype=np.uint64))
    values[1] = values[0]
    raw = suffix_dedup.delta_bytes(values)
    assert (suffix_dedup.from_delta_bytes(raw) == values).all()
    short = suffix_dedup._short(values)  # of 8 bytes two are always zero, a third for each 256 values
    assert not any(suffix_dedup.delta_bytes(short)[:-6 * 1000 or None][6 * 1000:]) and len(raw) == 8000


def test_batches_to_python_are_small(spark):
    rows = spark.range(0, 20_000, 1, 1).select(F.expr("repeat('x', 3000)").alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows]), "size": pa.array([batch.nbytes])})

    got = rows.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 20_000
    assert max(r["size"] for r in got) < 9 << 20
