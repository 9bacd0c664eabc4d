"""Collocations (op 13) against plain counting, and against SQL."""

import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa

from panelkit.llm import collocations as C
from panelkit.llm import queries

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def plain(rows, min_count, top):
    """The contract, phrase by phrase."""
    f, n = Counter(), Counter()
    for row in rows:
        lang = row[2] if row[2] is not None else "und"
        for words in pieces(row[1]):
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + m])) for m in range(1, 6) for i in range(len(words) - m + 1))
    f = {k: v for k, v in f.items() if v >= min_count}
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or any(b >= a and len(q) > len(p) and x == lang and any(q[i:i + len(p)] == p for i in range(len(q)))
                             for (x, q), b in f.items()):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


def corpus(seed=1, n=250):
    own = random.Random(seed)
    words = ["a", "B", "of", "the", "é", "x-y", "new", "york", "city", "'t", "日本"]
    fixed = ["new york city hall", "of the", "the the the the the the", "a b a b a"]
    rows = []
    for k in range(n):
        parts = [own.choice(fixed) if own.random() < 0.3 else own.choice(words) for _ in range(own.randint(1, 40))]
        text = "".join(p + own.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " "]) for p in parts)
        rows.append((k, text, own.choice(["en", "en", "en", "fr", None]), "s"))
    return rows + [(500, None, "en", "s"), (501, "", None, "s"), (502, "...", "zz", "s"), (3, rows[3][1], "en", "s"), (None, rows[4][1], "fr", "s")]


def test_matches_plain_counting(spark, documents, monkeypatch):
    rows = corpus()
    docs = documents(rows).repartition(5)
    want = plain(rows, 20, 30)
    assert {r[0] for r in want} == {"en", "fr", "und"}
    monkeypatch.setattr(C, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(C, "HELD_KEYS", 500)
    monkeypatch.setattr(C, "HELD_PHRASES", 40)
    for sample in (1, 16, 10_000):  # a whole, a usual and (nearly) no sample: border failures
        got = C.collocations(docs, 20, 30, sample)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == want, sample


def test_a_full_filter_changes_nothing(spark, documents, monkeypatch):
    rows = corpus(2, 120)
    monkeypatch.setattr(C, "_size", lambda n: 1)
    monkeypatch.setattr(C, "FILTER_WORDS", 1)
    assert sorted(map(tuple, C.collocations(documents(rows), 15, 50).collect())) == plain(rows, 15, 50)


def test_passes_count_once(spark):
    """What a later pass counts is what has both parts in the new filter and had not in the old."""
    block = C.Block.of_texts(pa.array(["a b c d a b c d. x a b"]), pa.array(["en"]))
    every = {m: set(keys.tolist()) for m, _, keys in block.counted(None)}
    words = np.array(sorted(every[1]), np.uint64)

    def filled(keys):
        out = C.Filter(np.zeros(1 << 12, np.uint64))
        at, mask = C.Filter.places(keys, 1 << 12)
        np.bitwise_or.at(out.words, at, mask)
        return out

    old, new = filled(words), filled(np.r_[words, np.array(sorted(every[2]), np.uint64)])
    first = {m: set(k.tolist()) for m, _, k in block.counted(old)}
    second = {m: set(k.tolist()) for m, _, k in block.counted(new, old)}
    assert first == {1: every[1], 2: every[2]} and second == {3: every[3]}


def test_large_numbers_and_long_texts(spark, documents):
    assert "".join(C.cut_long("abc. de, f" * 50, 30)) == "abc. de, f" * 50
    assert all(len(x) <= 36 for x in C.cut_long("abc. de, f" * 50, 30))
    assert C.cut_long("é" * 100, 10) == ["é" * 100] and C.cut_long("", 10) == [""]
    score = spark.sql("SELECT cast(1000 * cast(a as decimal(18,0)) as decimal(20,0)) * cast(n as decimal(18,0)) div "
                      "(cast(l as decimal(18,0)) * cast(r as decimal(18,0))) AS s FROM VALUES (3000000000000L, 9000000000000001L, 3000000000000L, 4000000000000L) t(a, n, l, r)")
    assert score.first().s == 1000 * 3000000000000 * 9000000000000001 // (3000000000000 * 4000000000000)


def test_empty_table(spark, documents):
    assert C.collocations(documents([])).count() == 0


def test_sql_twin(spark, sf_small):
    got = queries.QUERIES["op13_collocations"](spark, sf_small)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{Path(sf_small) / 'documents.parquet'}')")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.SQL['op13_collocations']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_packed_counts():
    own = np.random.default_rng(4)
    keys = np.unique(own.integers(0, 2 ** 64, 5000, dtype=np.uint64))
    keys = np.r_[np.uint64(0), keys, np.uint64(2 ** 64 - 1)]
    for most in (3, 300, 2 ** 33):
        n = own.integers(1, most, len(keys))
        for parts in (1, 7, 48):
            got = [C._unpacked(k, c) for b in C._packed(keys, n, parts) for k, c in zip(b.column("keys").to_pylist(), b.column("counts").to_pylist())]
            assert (np.concatenate([k for k, _ in got]) == keys).all() and (np.concatenate([c for _, c in got]) == n).all()
    assert list(C._packed(keys[:0], n[:0], 4)) == []



def test_colliding_keys_are_counted_apart():
    block = C.Block.of_texts(pa.array(["a b c a b d a"]), pa.array(["en"]))
    keys = np.zeros(len(block.codes), np.uint64) | np.uint64(1)  # all words collide
    held, at = C._Held(), np.arange(len(keys))
    odd = held.add(block, 1, at, keys, block.second(1))
    assert sorted(block.phrases(odd, 1)) == ["b", "b", "c", "d"] and [tuple(x.as_py() for x in r) for b in held.rows() for r in zip(*b.columns)] == [("en", 1, "a", 3)]
    again = held.add(block, 1, at, keys, block.second(1))
    assert sorted(block.phrases(again, 1)) == ["b", "b", "c", "d"] and held.n.tolist() == [6]


def test_a_phrase_is_named_once(spark, documents, monkeypatch):
    """However many blocks and tasks have a phrase, one of them gives its text; counts and texts stay those of plain counting."""
    rows = corpus()
    made = []
    monkeypatch.setattr(C, "BLOCK_BYTES", 3000)
    written = C.materialise

    def seen(df, name):
        out = written(df, name)
        made.append((name, df.columns, out))
        return out

    monkeypatch.setattr(C, "materialise", seen)
    found, totals = C.frequent_phrases(documents(rows).repartition(6), 20, 4)
    got = {(r.lang, r.phrase): r.f for r in found.collect()}
    texts = [out for _, columns, out in made if "phrase" in columns and "block" in columns]
    # before, each of the tasks gave the texts of all its phrases
    assert len(texts) == 1 and got and texts[0].where("m > 0").count() <= 1.05 * len(got) + 5
    assert texts[0].where("m > 0").groupBy("lang", "m", "phrase").count().where("count > 1").count() <= 0.05 * len(got) + 5
    words = Counter((row[2] or "und", " ".join(w[k:k + m])) for row in rows for w in pieces(row[1]) for m in range(1, 6) for k in range(len(w) - m + 1))
    assert got == {k: n for k, n in words.items() if n >= 20}
    assert {r.lang: r.n for r in totals.collect() if r.n} == {x: sum(len(w) for row in rows if (row[2] or "und") == x for w in pieces(row[1])) for x in ("en", "fr", "und")}
