"""Language profiles (op 2), mixing (op 3), WARC (op 4), quality rules (op 6), neighbours (op 8)."""

import hashlib
import io
import gzip
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from panelkit.llm import ann, language_id, mixing, quality, warc
from panelkit.llm._common import filesystem, output_folder

WORDS = {"aa": "the of and that with from this have".split(), "bb": "der die und nicht mit auch sich eine".split(),
         "cc": "él está niño más qué según aquí también".split()}


def talk(own, lang, n):
    return " ".join(own.choice(WORDS[lang]) for _ in range(n))


def test_languages_of_held_out_texts(documents):
    own = random.Random(5)
    rows = [(k, talk(own, lang, own.randint(3, 60)).upper() if k % 5 == 0 else talk(own, lang, 20), lang)
            for k, lang in ((k, own.choice(list(WORDS))) for k in range(300))]
    rows += [(900, None, "aa"), (901, "12 $$ 34", "aa"), (902, "", "bb"), (903, talk(own, "cc", 5000), None), (904, "x\x00y the", None),
             (904, "x\x00y the", None)]
    docs = documents(rows).repartition(3)
    model = language_id.fit(docs.where(language_id.fold(F.col("doc_id")) != 2))
    assert sorted(model) == sorted(WORDS)
    got = language_id.predict(docs, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    held = [r for r in rows[:300] if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert len(held) > 40 and np.mean([by[d].lang_pred == lang for d, _, lang in held]) > 0.98
    assert {r.doc_id for r in docs.where(language_id.fold(F.col("doc_id")) == 2).collect()} >= {d for d, _, _ in held}
    assert [by[d].lang_pred for d in (900, 901, 902, 903)] == ["und", "und", "und", "cc"]
    assert by[900].score == 0.0 and all(0.0 <= r.score <= 1.0 for r in got)
    none = language_id.fit(docs.where("false"))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}


def test_bundle_is_the_sum_of_bound_trigrams():
    space = language_id.LetterSpace(dims=64)
    text = "Ab, c!"
    got = space.bundles(["zz", text, "--"])
    letters = {c: space.turned[:, space.slot_of[ord(c) if c != " " else 0]] for c in "abc "}
    want = sum(letters[x][0] * letters[y][1] * letters[z][2] for x, y, z in zip(" ab c ", "ab c ", "b c "))
    assert np.allclose(got[1], want / np.linalg.norm(want), atol=1e-6) and not got[2].any()
    assert np.allclose(letters["a"][0], np.roll(letters["a"][2], 2))


def test_targets_are_capped_and_reshared():
    assert mixing.share_targets([10, 10, 100], [1, 2, 3]) == [22.5, 30.0, 67.5]
    got = mixing.share_targets([1, 50, 50], [3, 1, 1])
    assert got == [3.0, 49.0, 49.0]
    assert mixing.share_targets([0, 10], [1, 1]) == [0.0, 10.0]


def test_mix_comes_near_its_targets(documents):
    own = random.Random(8)
    rows = [(k, " ".join(["w"] * own.randint(0, 40)) + own.choice(["", " $$$ ###"]), "en", own.choice(["b", "a", "c", None, "é"]))
            for k in range(1500)]
    rows += [(3000 + k, "big " * 300, "en", "hot") for k in range(900)] + [(7000, None, "en", "void"), (7001, " ", "en", "void"), (None, "x y", "en", "a")]
    docs = documents(rows).repartition(5)
    out = mixing.draw(docs).toPandas()
    again = mixing.draw(docs.repartition(2)).toPandas()
    order = ["doc_id", "source", "size"]
    assert out.sort_values(order)["taken"].tolist() == again.sort_values(order)["taken"].tolist()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + count(t)
    assert sorted(out["size"]) == sorted(count(t) for _, t, _, _ in rows)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    targets = dict(zip(names, mixing.share_targets([sizes[s] for s in names], [(1, 2, 3)[k % 3] for k in range(len(names))])))
    assert (out.taken <= 3 * out["size"]).all() and (out.taken % out["size"].where(out["size"] > 0, 1) == 0).all()
    for s in names:
        own_rows = out[out.source.isna()] if s is None else out[out.source == s]
        assert (own_rows.source_size == sizes[s]).all() and np.allclose(own_rows.target, targets[s])
        assert abs(own_rows.taken.sum() - targets[s]) <= own_rows["size"].max()
        copies = own_rows[own_rows["size"] > 0].copies
        if len(copies):
            assert copies.max() - copies.min() <= 1  # complete epochs come first
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == out.copies.sum()
    assert mixing.draw(documents([])).count() == 0


def test_heavier_documents_come_first():
    texts = pa.array(["word words", "$$$ ###", None, "a $"])
    words, weights = mixing.sizes_and_weights(texts)
    assert words.tolist() == [2, 2, 0, 2] and weights.tolist() == [1.0, 0.05, 0.05, 0.5]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, record string, last int")


def test_warc_round_trip(spark):
    long = "<p>é</p>" * 200_000
    same = "<html>" + "s" * 100 + "</html>"
    rows = [(k, f"http://h/{k}", f"<html>{k}</html>" * (k % 20)) for k in range(60)]
    rows += [(100, None, None), (101, "http://a b\r\nX: y", ""), (102, "u", long), (103, "u", long), (104, "u", same), (99, "u", same),
             (105, "u", "short"), (106, "u", "short"), (99, "u", same), (None, "u", same), (None, "u", "n" * 200), (107, "u", "a\r\n\r\nb" * 30)]
    manifest = warc.write_archives(pages(spark, rows).repartition(4), output_folder(spark, "test-warc"), chunk_bytes=1000)
    out = warc.read_archives(manifest).collect()
    first = {}
    for d, _, h in rows:
        if d is not None:
            first[h or ""] = min(first.get(h or "", d), d)
    want = []
    for d, _, h in rows:
        b = (h or "").encode()
        again = len(b) >= 100 and first.get(h or "") is not None and first[h or ""] != d
        want.append((str(d), len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", str(first[h] if again else None)))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in out) == sorted(want)
    assert next(r.url for r in out if r.page_id == 101) == "http://a%20b%0D%0AX:%20y"
    text = b""
    for m in manifest.collect():  # plain gzip members, plain WARC records
        system, local = filesystem(m.path)
        text += gzip.GzipFile(fileobj=io.BytesIO(system.open_input_file(local).read())).read()
    assert text.count(b"WARC/1.1\r\n") == len(rows) and text.count(b"<p>\xc3\xa9</p>") == 200_000
    assert warc.warc_round_trip(pages(spark, [])).count() == 0


def test_chunks_carry_the_digest_so_far(spark):
    got = warc.chunk_table(pages(spark, [(1, "u", "abcdefg")]), chunk_bytes=3).orderBy("chunk_no").collect()
    assert [(r.chunk_no, bytes(r.data), r.upto_bytes, r.last) for r in got] == [(0, b"abc", 3, False), (1, b"def", 6, False), (2, b"g", 7, True)]
    assert [r.upto_digest for r in got] == [hashlib.sha256(b"abcdefg"[:n]).hexdigest() for n in (3, 6, 7)]


def brute_features(text):
    words, seen, dup = re.findall(r"[^\x20\x09-\x0D]+", text), set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    at = {}
    for k in range(len(words) - 7):
        at.setdefault(tuple(words[k:k + 8]), []).append(k)
    cover = {j for v in at.values() if len(v) > 1 for k in v for j in range(k, k + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def test_counts_equal_brute_force():
    own = random.Random(9)
    texts = ["", None, " \n \n", "a\n" * 50, "é # $ | " * 9, "x" * 5000]
    texts += ["".join(own.choice(["a ", "b ", "cé ", "\n", "\n\n", "# ", "\t", "\x0b", "a b a b a b a b "]) for _ in range(own.randint(0, 120))) for _ in range(200)]
    got = quality.text_features(pa.array(texts))
    for k, t in enumerate(texts):
        assert tuple(int(got[f][k]) for f in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute_features(t or "")


def test_binomial_bound_is_exact():
    for k, n, alpha in ((0, 30, 0.05), (3, 50, 0.01), (10, 400, 0.001)):
        p = quality.binomial_upper(k, n, alpha)
        tail = sum(np.exp(np.sum(np.log(np.arange(n - i + 1, n + 1))) - np.sum(np.log(np.arange(1, i + 1)))) * p ** i * (1 - p) ** (n - i)
                   for i in range(k + 1))
        assert abs(tail - alpha) < 1e-6
    assert abs(quality.binomial_upper(0, 30, 0.05) - (1 - 0.05 ** (1 / 30))) < 1e-9 and quality.binomial_upper(5, 5, 0.1) == 1.0


def test_rules_together_stay_within_the_risk():
    # good documents rejected by each rule, none of them by two rules; 5: 1.2 percent, 10: 0.3, else none
    n, lost = 10_000, {5: 120, 10: 30}
    row = {"stratum": "en", "good": n, "bad": 3000}
    for k, rule in enumerate(quality.RULES):
        for cut in quality.GRID:
            row[f"good_{rule}_{cut}"] = lost.get(cut, 0)
            row[f"bad_{rule}_{cut}"] = max(0, 900 + k - 10 * quality.GRID.index(cut))
    chosen = quality.choose_cutoffs([row])
    assert [r for _, r, _ in chosen] == list(quality.RULES)  # all rules stay on, with higher cutoffs
    together = sum(lost.get(cut, 0) for _, _, cut in chosen)
    alpha = quality.DELTA / (len(quality.RULES) * len(quality.GRID))
    assert quality.binomial_upper(together, n, alpha) <= quality.RISK
    # one rule alone has all of the risk
    for rule in quality.RULES[1:]:
        for cut in quality.GRID:
            row[f"bad_{rule}_{cut}"] = 0
    assert quality.choose_cutoffs([row]) == [("en", quality.RULES[0], 5)]


def test_rules_reject_bad_and_keep_good(spark, documents):
    own = random.Random(2)
    word = lambda: "".join(own.choice("abcdefghij") for _ in range(6))
    rows, labels = [], []
    for k in range(1600):
        bad = k % 4 == 0
        lang = "en" if k % 2 == 0 or k % 8 == 1 else "de"
        rows.append((k, " ".join(word() + ("$$$" if bad else "") for _ in range(30)), lang))
        labels.append((k, 0 if bad else 1, 0, "x"))
    rows += [(5000, None, "en"), (5001, "few words", "en"), (5002, "one two three four five six seven eight " * 9, "en"), (5003, rows[1][1], None), (5003, rows[1][1], None)]
    labels += [(1, None, None, "x"), (None, 1, 0, "x")]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, stratum string")
    docs = documents(rows)
    out = {r.doc_id: r for r in quality.quality_rules(docs, table).collect()}
    assert [out[d].base_failed for d in (5000, 5001, 5002, 5003)] == [True, True, True, False]
    good = [r for r in range(1600) if r % 4]
    assert all(out[d].kept for d in good) and out[5003].kept
    assert not any(out[d].kept for d in range(0, 1600, 4) if rows[d][2] == "en")
    left = quality.keep_good(docs, table)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.select("doc_id").collect()) == sorted(d for d, *_ in rows if out[d].kept)
    few = quality.quality_rules(docs, table.where("doc_id < 40"))  # too few labels: only the base rules
    assert few.where("kept = base_failed").count() == 0
    assert quality.quality_rules(documents([]), table).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")


def test_neighbours_by_brute_force(spark, monkeypatch):
    own = np.random.default_rng(4)
    rows = [(k, own.standard_normal(16).tolist()) for k in range(3000)]
    rows += [(4000 + k, rows[0][1]) for k in range(800)]  # a hot vector
    rows += [(9000, None), (9100, [0.0] * 16), (9200, [1.0, None] * 8), (9300, [float("nan")] * 16), (9400, [1.0] * 3), (None, [1.0] * 16)]
    monkeypatch.setattr(ann, "MAX_CELL", 64)
    got = ann.search(vectors(spark, rows).repartition(4), F.col("vec_id") % 100 == 0).toPandas()
    ids = np.array([i for i, _ in rows[:3800]])
    x = np.array([v for _, v in rows[:3800]], np.float32).astype(float)
    hits, asked = 0, [i for i in ids if i % 100 == 0]
    assert sorted(set(got.query_id)) == sorted(asked)
    for q in asked:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, d)) if ids[k] != q][:10]
        own_rows = got[got.query_id == q].sort_values("rank")
        assert own_rows["rank"].tolist() == list(range(1, 11))
        at = [int(np.flatnonzero(ids == v)[0]) for v in own_rows.vec_id]
        assert np.array_equal(own_rows.score.to_numpy(), d[at])
        assert list(zip(own_rows.score, own_rows.vec_id)) == sorted(zip(own_rows.score, own_rows.vec_id))
        hits += len(set(ids[order]) & set(own_rows.vec_id))
    assert hits >= 0.9 * 10 * len(asked)


def test_queries_of_a_cell_are_dealt_to_blocks(spark, monkeypatch):
    own = np.random.default_rng(3)
    rows = [(k, own.standard_normal(8).tolist()) for k in range(900)]
    rows += [(1000 + k, rows[0][1]) for k in range(600)]  # all of them ask in one cell
    rows += [(5000 + k, (own.standard_normal(8) * 500).tolist()) for k in range(100)]  # alone in their cells
    groups, ranked = [], ann._ranked

    def watched(stored, visits, key, k):
        groups.append([side.groupBy(*key).count().agg(F.max("count")).first()[0] for side in (stored, visits)])
        return ranked(stored, visits, key, k)

    monkeypatch.setattr(ann, "_ranked", watched)
    monkeypatch.setattr(ann, "MAX_CELL", 64)
    monkeypatch.setattr(ann, "CELL_ROWS", 8)
    got = []
    for most in (10 ** 6, 64):
        monkeypatch.setattr(ann, "MAX_ASKED", most, raising=False)
        got.append(sorted(ann.search(vectors(spark, rows), F.lit(True), success=0.3).collect()))
    half = len(groups) // 2  # the rounds of cells and the queries with fewer than k found, each time
    assert half >= 2 and len(groups) == 2 * half
    assert max(sides[1] for sides in groups[:half]) >= 600
    assert all(max(sides) <= 128 for sides in groups[half:])
    assert got[0] == got[1] and len(got[0]) == 10 * len(rows)


def test_rounds_change_no_result_and_give_fewer_rows(spark, monkeypatch):
    own = np.random.default_rng(6)
    rows = [(k, own.standard_normal(8).tolist()) for k in range(2000)]
    rows += [(3000 + k, rows[0][1]) for k in range(700)]  # a hot vector: ties to smaller ids across its parts
    given, ranked = [], ann._ranked

    def watched(stored, visits, key, k):
        out = ranked(stored, visits, key, k)
        given.append(out.count())
        return out

    monkeypatch.setattr(ann, "_ranked", watched)
    monkeypatch.setattr(ann, "MAX_CELL", 32)
    monkeypatch.setattr(ann, "CELL_ROWS", 16)
    got, rows_given, rounds = [], [], []
    for start, growth in ((10 ** 9, 16), (64, 4), (16, 2)):
        monkeypatch.setattr(ann, "START_ROWS", start)
        monkeypatch.setattr(ann, "GROWTH", growth)
        given.clear()
        got.append(sorted(ann.search(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect()))
        rows_given.append(sum(given))
        rounds.append(len(given))
    assert got[0] == got[1] == got[2] and len(got[0]) == 10 * (40 + 14)
    assert rounds[0] == 1 < rounds[1] < rounds[2]
    assert 2 * max(rows_given[1:]) < rows_given[0]


def test_few_rows_give_all_candidates(spark):
    rows = [(k, [float(k), 1.0]) for k in range(5)]
    got = ann.search(vectors(spark, rows), F.col("vec_id") % 2 == 0).collect()
    assert {q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in (0, 2, 4)} == {
        0: [1, 2, 3, 4], 2: [1, 3, 0, 4], 4: [3, 2, 1, 0]}
    assert ann.search(vectors(spark, [(1, None)]), F.col("vec_id") > 0).count() == 0
    assert ann.search(vectors(spark, [(100, [1.0])]), F.col("vec_id") > 0).count() == 0
