"""Tokenizer alignment (op 11) against whole-text encoding and plain counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelkit.llm import alignment

ODD = [None, "", " ", "  ", "a", " a", "a  b", "a  b", "x  y", "é è ", "İ. ı", "日本 語", "a▁b", "tab\t x", "line\n\n y ",
       "<|endoftext|> s </s> <unk>", "it's  we'll 's", "…  dots ", "​ z", "\x00 nul", "\x1f u", "é x", "<0x41> <0x0A>", "’ q", "– dash "]


def whole(text, tool):
    """Tokens, groups and links of a text, straight from the definition."""
    zeros = (0, 0, [], "")
    if not text:
        return zeros
    raw = (" " + text).encode()
    a, b = tool.a.encode(" " + text, add_special_tokens=False).ids, tool.b.encode(text)
    if b"".join(tool.a_tokens.of_id[i] for i in a) != raw or b"".join(tool.b_tokens.of_id[i] for i in b) != raw:
        return zeros
    ends_a = np.cumsum([len(tool.a_tokens.of_id[i]) for i in a]).tolist()
    ends_b = np.cumsum([len(tool.b_tokens.of_id[i]) for i in b]).tolist()
    both, at, groups = sorted(set(ends_a) & set(ends_b)), 0, []
    for end in both:
        groups.append(",".join(str(i) for i, e in zip(a, ends_a) if at < e <= end) + "|"
                      + ",".join(str(i) for i, e in zip(b, ends_b) if at < e <= end))
        at = end
    links = [(a[ends_a.index(e)], b[ends_b.index(e)]) for e in both]
    return len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def expected(rows, tool):
    found = [whole(t, tool) for _, t in rows]
    counts = Counter(link for f in found for link in f[2])
    top = Counter()
    for (_, b), c in counts.items():
        top[b] = max(top[b], c)
    return sorted(((d, f[0], f[1], len(f[2]), len(f[2]), sum(counts[x] == top[x[1]] for x in f[2]), sum(counts[x] for x in f[2]), f[3])
                   for (d, _), f in zip(rows, found)), key=repr), counts


def corpus():
    own = random.Random(2)
    letters = "abcdeéèöß .,'\n\t-日 "
    rows = list(enumerate(ODD))
    rows += [(100 + k, "".join(own.choice(letters) for _ in range(own.randint(1, 200)))) for k in range(60)]
    rows += [(300, "word " * 4000), (300, "word " * 4000), (None, "the cat"), (301, "x" * 5000), (302, "the cat")]
    return rows


def test_matches_whole_texts(spark, documents, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 2)  # several parts and tree levels
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 12_000)
    monkeypatch.setattr(alignment, "BUCKETS", 5)
    tool = alignment.Aligner(*alignment.default_tokenizers())
    rows = corpus()
    want, counts = expected(rows, tool)
    docs = documents(rows).repartition(3)
    got = alignment.align_corpus(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == want
    pairs = {(r.a_id, r.b_id): r.links for r in alignment.pair_counts(docs).collect()}
    assert pairs == dict(counts)


def test_empty_table(spark, documents):
    assert alignment.align_corpus(documents([])).count() == 0


@given(st.lists(st.sampled_from([" ", "  ", "a", "é", " ", " ", "'s", ".", "日", "\n", "\t", "’", "▁", "İ", "\x1f", "́"]), min_size=1, max_size=25))
@settings(max_examples=400, deadline=None)
def test_segments_are_whole_texts(parts):
    import pyarrow as pa
    tool = alignment.aligner(*alignment.default_tokenizers())
    text = "".join(parts)
    got = tool.block(pa.array([text, "x", text], pa.large_string()))
    n_a, n_b, links, sha = whole(text, tool)
    assert got["totals"][0].tolist() == [n_a, n_b, len(links)] and got["sha"][0] == sha == got["sha"][2]


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 2 ** 62, 50_000))
    levels = alignment.build_hash(keys)
    at = alignment.hash_index(levels, keys)
    assert sorted(at.tolist()) == list(range(len(keys)))
    table = np.empty_like(keys)
    table[at] = keys
    assert (alignment.verified_index(alignment._unpack(*alignment._pack(levels)), table, keys) == at).all()
    with pytest.raises(ValueError):
        alignment.verified_index(levels, table, keys[:5] ^ 1 << 61)
    assert alignment.build_hash(keys[:0]) == []


def test_quick_encoding_is_the_file():
    tool = alignment.aligner(*alignment.default_tokenizers())
    own = random.Random(5)
    letters = [chr(c) for c in [*range(0x20, 0x7F), 10, 9, *range(0xC0, 0x250)]] + [" "] * 40 + list("etaoinsr'") * 9
    parts = ["".join(own.choices(letters, k=own.randint(1, 30))) for _ in range(4000)]
    parts += [" don't", "we'll 'S 's", "  \n\n x", "1234567", " <|endoftext|>", "\u00d7 \u00f7", "ﬁ"]
    assert tool.quick is not None
    assert tool.encode_a(parts) == [e.ids for e in tool.a.encode_batch(parts, add_special_tokens=False)]
    assert not tool.PLAIN.fullmatch("\u00d7") and not tool.PLAIN.fullmatch("a\u00a0b")
