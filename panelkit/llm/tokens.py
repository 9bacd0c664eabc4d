"""Word-wise encoding with a tokenizer file of the ``tokenizers`` library.

The tokenizer's own rules drop white space, lower-case the text, and never join letters with
ASCII punctuation or digits (but for an apostrophe), so a text's ids are the ids of such
pieces in a row. Each distinct piece is encoded by the library once and kept in a bounded
table; the ids of a text are then gathered with numpy. Pieces of Latin letters alone are one
word to the library's splitting rules and go straight to its model. ``tests/llm`` holds this
against encoding of whole texts.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa

from panelkit.llm._common import coded, gather, split_words, starts_of, strings

#: Pieces kept by one Python worker; the table is emptied when it is full.
CACHED_WORDS = 800_000

_LETTER, _MARK, _OTHER = 1, 2, 3
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KIND[0x21:0x7F] = _MARK
_KIND[0x61:0x7B] = _LETTER
_KIND[0x27] = _OTHER


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet, by its rule: printable bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()


def split_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased pieces of all texts in a row, and the number in each text.

    Cuts stand at white space and between ASCII or Latin letters and ASCII marks. Where a
    special token may occur only white space cuts, and nothing is lower-cased.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    if b"<|" in data.tobytes():
        return split_words(texts)
    data = data | np.where((data >= 0x41) & (data <= 0x5A), np.uint8(0x20), np.uint8(0))
    kind = _KIND[data]
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))  # U+00C0 to U+017F
    lead = lead[(data[lead] != 0xC3) | ((data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7))]
    # U+0130 ends in a combining dot once lower-cased, which joins the mark after it
    lead = lead[(data[lead] != 0xC4) | (data[lead + 1] != 0xB0)]
    kind[lead] = kind[lead + 1] = _LETTER
    full = kind > 0
    first = full.copy()
    if len(first):
        sides = kind[1:] | (kind[:-1] << 4)
        first[1:] &= (kind[:-1] == 0) | (sides == (_LETTER | _MARK << 4)) | (sides == (_MARK | _LETTER << 4))
        begins = (offsets - offsets[0])[:-1]
        begins = begins[begins < len(data)]
        first[begins] = full[begins]
    at = np.flatnonzero(first)
    places = np.append(starts_of(full)[at], full.sum()).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(places), pa.py_buffer(data[full])])
    return pieces, np.diff(np.searchsorted(at, offsets - offsets[0]))

#: The rules that the cuts above follow (fixed values, as in the file): others' files are encoded
#: by whole texts.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

_ENCODERS: dict[str, "WordEncoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


class WordEncoder:
    """ids of texts, by a table of words already encoded."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            file = json.load(f)
        self.by_pieces = file["normalizer"] == NORMALIZER and file["pre_tokenizer"] == SPLITTER
        self.limit = cached_words
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.start, self.size, self.pool, self.used = (np.zeros(0, np.int64), np.zeros(0, np.int64),
                                                       np.zeros(0, np.uint32), 0)

    def _ids(self, words: list[str]) -> list[list[int]]:
        """ids of single pieces, in order."""
        found: list = [None] * len(words)
        hard, model = [], self.tokenizer.model
        for k, w in enumerate(words):
            if w.isalpha() and (w.isascii() or max(w) < "\u0180") and "\u0130" not in w:
                w = w.lower()
                if not w.isascii():
                    w = "".join(map(_BYTE_LETTERS.__getitem__, w.encode()))
                found[k] = [t.id for t in model.tokenize(w)]
            else:
                hard.append(k)
        for at in range(0, len(hard), 4096):
            some = hard[at:at + 4096]
            got = self.tokenizer.encode_batch_fast([words[k] for k in some], add_special_tokens=False)
            for k, e in zip(some, got):
                found[k] = e.ids
        return found

    def _learn(self, words: list[str]) -> None:
        found = self._ids(words)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        at = len(self.slot)
        if at + len(words) > len(self.start):
            room = max(1024, 2 * (at + len(words)))
            self.start, self.size = np.resize(self.start, room), np.resize(self.size, room)
        if self.used + len(ids) > len(self.pool):
            self.pool = np.resize(self.pool, max(4096, 2 * (self.used + len(ids))))
        self.start[at:at + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.size[at:at + len(words)] = sizes
        self.pool[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.slot.update(zip(words, range(at, at + len(words))))

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for at in range(0, len(texts), 256):
            found += [e.ids for e in self.tokenizer.encode_batch_fast(texts.slice(at, 256).to_pylist(), add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), starts_of(sizes)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32) and the first position of each text (one more at the end)."""
        if not self.by_pieces:
            return self._whole(strings(texts))
        words, counts = split_pieces(strings(texts))
        distinct, codes = coded(words)
        distinct = distinct.to_pylist()
        missing = [w for w in distinct if w not in self.slot]
        if len(self.slot) + len(missing) > self.limit:
            self._clear()
            missing = distinct
        if missing:
            self._learn(missing)
        slots = np.fromiter(map(self.slot.__getitem__, distinct), np.int64, len(distinct))
        sizes = self.size[slots][codes]
        ids = self.pool[gather(self.start[slots][codes], sizes)]
        firsts = starts_of(sizes)[starts_of(counts)]
        return ids, firsts


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker for one tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
