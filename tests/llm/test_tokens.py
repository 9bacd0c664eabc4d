"""Token counts (op 1), packing (op 7) and token files (op 10)."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from panelkit.llm import packing, token_counts, token_files
from panelkit.llm._common import filesystem, output_folder
from panelkit.llm.tokens import WordEncoder, default_tokenizer

ODD = ["", None, " \t\n", "Hello, World! it's 2024   café CAFÉ", "a\x0bb\x0cc\x1cd", "<|endoftext|> x<|startoftext|>y",
       "你好 世界 İstanbul ΣΣ", "é ́x", "word " * 3000, "x" * 20000, "a ▁b ▁▁c", "\U0001f600 � ퟿"]


@pytest.fixture(scope="module")
def rows():
    own = random.Random(3)
    words = ["the", "of", "rend", "ouble", "it's", "2024", "$$$", "naïve", "THE", "фу", "...", "x1y2"]
    rows = list(enumerate(ODD))
    rows += [(100 + k, " ".join(own.choice(words) for _ in range(own.randint(0, 400)))) for k in range(60)]
    return rows + [(5, "again"), (5, "again"), (None, "no id"), (None, None)]


def whole_ids(text, end):
    t = Tokenizer.from_file(default_tokenizer())
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_give_the_ids_of_whole_texts(rows):
    enc = WordEncoder(default_tokenizer(), cached_words=50)  # emptied again and again
    texts = [t for _, t in rows]
    ids, firsts = enc.encode(pa.array(texts))
    for k, t in enumerate(texts):
        assert [*ids[firsts[k]:firsts[k + 1]].tolist(), 1] == whole_ids(t, 1)


def test_token_counts_equal_the_library():
    vocabulary = token_counts.read_vocabulary(token_counts.default_vocabulary())
    tiny = [("<unk>", 0.0), ("▁", -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -3.0), ("ba", -2.0), ("aa", -2.0),
            ("aba", -3.0)]
    own = random.Random(1)
    for vocab, fallback, alphabet in ((vocabulary, True, "abc theéè你▁ "), (tiny, False, "abc ")):
        library = Tokenizer(models.Unigram(vocab, 0, byte_fallback=fallback))
        library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
        mine = token_counts.UnigramCounter(vocab)
        texts = ["".join(own.choice(alphabet) for _ in range(own.randint(0, 60))) for _ in range(400)]
        texts = [" ".join(t.split(" ")).strip() for t in texts]
        texts = [" ".join(filter(None, t.split(" "))) for t in texts] + ["the quick brown fox", "你你你"]
        pieces, _ = mine.texts(pa.array(texts))
        for t, n in zip(texts, pieces.tolist()):
            marked = " " + t if t else ""  # a space mark stands before every word
            assert n == len(library.encode(marked).ids), t


def test_token_counts_query(documents, rows):
    out = token_counts.token_counts(documents(rows)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by[0].n_tokens == by[1].n_tokens == by[2].n_tokens == 0 and by[0].score == 0.0
    assert token_counts.token_counts(documents([])).count() == 0


def test_token_files_round_trip(spark, documents, rows):
    out = token_files.token_files(documents(rows)).collect()
    assert len(out) == len(rows)
    want = sorted(((d, t) for d, t in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in out) == sorted(
        (d is not None, d or 0, len(whole_ids(t, 1)), crc(whole_ids(t, 1))) for d, t in rows)
    at = 0
    for r, (d, _) in zip(sorted(out, key=lambda r: r.start), want):
        assert (r.start, r.doc_id) == (at, d)
        at += r.n_tokens
    assert token_files.token_files(documents([])).count() == 0


def test_token_file_reads_only_what_is_asked(spark, documents, rows):
    folder = output_folder(spark, "test-files")
    manifest = token_files.write_token_files(documents(rows).coalesce(1), folder, frame_tokens=64).collect()
    read = []
    for m in manifest:
        system, local = filesystem(m.path)
        with system.open_input_file(local) as source:
            got = token_files.TokenFileReader(source, m.n_bytes)
            for k, d in enumerate(got.doc_ids):
                if d == 8:
                    assert got.ids(k).tolist() == whole_ids(ODD[8], 1)
                    assert got.n_frames[k] == -(-len(whole_ids(ODD[8], 1)) // 64)
                    read.append(k)
            data = bytearray(system.open_input_file(local).read())
        data[int(got.begin[got.first_frame[0]]) + 9] ^= 0xFF  # a damaged frame is found
        with pytest.raises(Exception):
            list(token_files.TokenFileReader(pa.BufferReader(bytes(data)), m.n_bytes).frames_of(0))
    assert len(read) == 1


def test_hilbert_curve_is_one_path():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = packing.hilbert_keys(grid, bits)
        path = grid[np.argsort(keys)]
        assert sorted(keys.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_packing_places_every_id_once(documents, rows):
    docs = documents(rows).repartition(4)
    out = packing.pack(docs, length=512).toPandas()
    again = packing.pack(docs, length=512).toPandas()
    key = ["sequence_id", "offset"]
    assert out.sort_values(key).reset_index(drop=True).equals(again.sort_values(key).reset_index(drop=True))
    total = sum(len(whole_ids(t, 2)) for _, t in rows)
    assert out.length.sum() == total
    used = out.sort_values(key)
    assert ((used.sequence_id * 512 + used.offset).values == (used.length.cumsum() - used.length).values).all()
    assert used.groupby("sequence_id").length.sum().iloc[:-1].eq(512).all()
    for d, t in rows:
        if d is None or d == 5:
            continue
        ids, own = whole_ids(t, 2), out[out.doc_id == d].sort_values("start")
        assert own.length.sum() == len(ids) and (own.doc_tokens == len(ids)).all()
        for p in own.itertuples():
            assert p.ids_crc32 == crc(ids[p.start:p.start + p.length])
    assert packing.pack(documents([])).count() == 0


def test_curve_brings_like_documents_together():
    curve = packing.CurveKeys()
    own = np.random.default_rng(0)
    topics = [own.integers(0, 49000, 60) for _ in range(6)]
    docs = [own.choice(topics[k % 6], 300).astype(np.uint32) for k in range(120)]
    order = np.argsort(curve.keys(docs), kind="stable") % 6
    assert (order[1:] == order[:-1]).mean() > 0.5


def test_ids_of_random_texts_are_those_of_whole_texts():
    import public_tokenizers

    own = random.Random(11)
    letters = ([chr(c) for c in range(0xC0, 0x180)] + [chr(c) for c in range(0x21, 0x7F)] + ["\u0130"] * 25
               + ["\u0301", "\u0307", "\u0338", "\u030a", "\u0345"] * 5 + [" ", "\t", "\n", "\u00a0", "\u2003", "\u3000"] * 6 + list("is'tdm.") * 4)
    texts = ["".join(own.choices(letters, k=own.randint(1, 14))) for _ in range(8000)] + ["\u0130.", "\u0130\u0307.", "A\u0130B,\u0130 x"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):  # the second has other rules
        path = str(public_tokenizers.path(name))
        ids, first = WordEncoder(path).encode(pa.array(texts))
        whole = WordEncoder(path).tokenizer.encode_batch(texts, add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [e.ids for e in whole], name
