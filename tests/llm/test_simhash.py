"""Fingerprints and the Gray-order index (op 12) against brute force."""

import random
import re

import numpy as np
import xxhash

from panelkit.llm import simhash
from panelkit.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def labels(prints, names):
    """The smallest name that links of two bits reach, by all pairs."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    label = np.array(names)
    while True:
        new = np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (new == label).all():
            return label
        label = new


def clusters(seed=0):
    own = np.random.default_rng(seed)
    out = [0, 1, 3, 7, 2 ** 64 - 1]
    for base in own.integers(0, 2 ** 63, 40, dtype=np.uint64).tolist():
        for _ in range(60):
            for k in own.integers(0, 64, own.integers(0, 4)).tolist():
                base ^= 1 << k if own.random() < 0.5 else 0
            out.append(base)
    return np.unique(np.array(out, np.uint64))


def test_gray_rank_is_the_reflected_sequence():
    codes = np.arange(64, dtype=np.uint64)
    gray = codes ^ (codes >> np.uint64(1))
    assert (simhash.gray_rank(gray) == codes).all()


def test_index_finds_all_pairs():
    codes = clusters()
    for some in (codes, codes[:1], codes[:9]):
        index = simhash.GrayIndex(some)
        a, b = index.links(np.arange(len(some)))
        ordered = some[index.order]
        near = np.triu(np.bitwise_count(ordered[:, None] ^ ordered[None, :]) <= 2, 1)
        assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(*(x.tolist() for x in np.nonzero(near))))
        order, root = simhash.roots(some)
        assert (root == labels(some[order], np.arange(len(some)))).all()


def test_upper_nodes_are_pruned():
    codes = np.unique(np.random.default_rng(3).integers(0, 2 ** 63, 20_000, dtype=np.uint64))
    index, charged = simhash.GrayIndex(codes), []
    inner = index._charge
    index._charge = lambda level, query, node, *rest: charged.append(len(node)) or inner(level, query, node, *rest)
    index.links(np.arange(0, 500))
    assert sum(charged) < 500 * len(codes) / 10


def test_dealt_runs_keep_every_link(spark, monkeypatch):
    codes = clusters(5)
    want = labels(codes, np.arange(len(codes)))
    prints = spark.createDataFrame([(int(v),) for v in codes.view(np.int64)], "print long")
    for most in (32_768, 20, 3):  # one, two and three steps
        monkeypatch.setattr(simhash, "MAX_GROUP", most)
        linked = {r.node: r.label for r in components(simhash.links(prints), "simhash-test").collect()}
        groups = {}
        for code, label in zip(codes.view(np.int64).tolist(), want.tolist()):
            groups.setdefault(linked.get(code, code), set()).add(label)
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.tolist()))


def test_near_duplicates(spark, documents):
    own = random.Random(9)
    vocabulary = ["".join(own.choice("abcdeÉ") for _ in range(own.randint(1, 6))) for _ in range(300)]
    rows = [(k, " ".join(own.choices(vocabulary, k=own.randint(1, 300)))) for k in range(1, 120)]
    for k in range(150):
        words = rows[own.randrange(40)][1].split(" ")
        words[own.randrange(len(words))] = "other"
        rows.append((500 + k, " ".join(words).upper() if k % 5 == 0 else "\t\n".join(words)))
    rows += [(900, None), (901, ""), (902, " \x0b\n"), (903, "one"), (904, "ONE two"), (905, "word " * 30_000), (906, "word " * 29_000),
             (7, rows[0][1]), (7, rows[0][1])]
    want = labels(np.array([fingerprint(t) for _, t in rows], np.uint64), [d for d, _ in rows])
    got = simhash.near_duplicates(documents(rows).repartition(4))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    expected = sorted((d, format(fingerprint(t), "016x"), int(c)) for (d, t), c in zip(rows, want))
    assert sorted(map(tuple, got.collect())) == expected
    assert len(set(want.tolist())) < len(rows) - 40


def test_null_ids_and_empty_table(spark, documents):
    rows = simhash.near_duplicates(documents([(None, "a b c"), (4, "a b c"), (None, "x y z w v")])).collect()
    assert sorted((r.doc_id is None, r.component_id is None, r.component_id) for r in rows if r.component_id) == [(False, False, 4), (True, False, 4)]
    assert [r.doc_id for r in rows if r.component_id is None] == [None]
    assert simhash.near_duplicates(documents([])).count() == 0
