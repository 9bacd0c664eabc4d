"""Token counts (operator 1): count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character of a
word; dynamic programming carries the best score and the number of pieces of the best
split, without building the pieces. The rules are those of the ``Unigram`` model of the
``tokenizers`` library over the same (piece, score) list:

* sums of scores in double precision, left to right; of equal sums the longest last piece
  wins, since starts are tried in ascending order and only a larger sum replaces one;
* a character that is no piece of its own may be passed as unknown, for the lowest score of
  the vocabulary less ten; unknown characters cost their UTF-8 bytes in byte pieces if the
  vocabulary has all of them, else a run of them is one unknown piece;
* a space mark stands before each word, and words are cut before every mark, also before
  marks of the text itself (``Metaspace``).

Texts are split at the white space of the word rule; every run of it counts as one space.
A word is solved once per batch and kept in a bounded table of the Python worker. Each
document is handled where it is read: no shuffle.

Cases: null or empty text, or white space only: 0 pieces and score 0; one word of any
length is solved in memory linear in its length; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelkit.llm._common import coded, doc_texts, slices, split_words, strings

SPACE_MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 400_000

_COUNTERS: dict[str, "UnigramCounter"] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) in id order from a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter:
    """Number of pieces and best score of single words."""

    def __init__(self, vocabulary: list[tuple[str, float]], cached_words: int = CACHED_WORDS):
        import ahocorasick

        self.pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        known = {piece for piece, _ in vocabulary}
        self.byte_piece = [f"<0x{b:02X}>" in known for b in range(256)]
        self.limit, self.cache = cached_words, {}

    def solve(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best split of one word."""
        n = len(word)
        ends: list[list] = [[] for _ in range(n)]
        for end, hit in self.pieces.iter(word):
            ends[end].append(hit)
        score, pieces = [0.0] * (n + 1), [0] * (n + 1)
        run = [0] * (n + 1)  # first character of the run of unknown ones that ends here, plus one
        for end in range(1, n + 1):
            best, size = None, 0
            single = False
            for length, own in ends[end - 1]:  # longest first: ascending starts
                total = own + score[end - length]
                if best is None or total > best:
                    best, size = total, length
                single = single or length == 1
            begin = end - size
            if not single:
                total = self.unknown + score[end - 1]
                if best is None or total > best:
                    best, begin = total, end - 1
                    run[end] = run[end - 1] or end
            score[end] = best
            if run[end]:
                pieces[end] = pieces[run[end] - 1] + self._unknown(word[run[end] - 1:end])
            else:
                pieces[end] = pieces[begin] + 1
        return pieces[n], score[n]

    def _unknown(self, text: str) -> int:
        data = text.encode()
        return len(data) if all(self.byte_piece[b] for b in set(data)) else 1

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces and scores of words, each with a space mark before it."""
        if len(self.cache) + len(words) > self.limit:
            self.cache.clear()
        found = self.cache
        for w in words:
            if w not in found:
                parts = [self.solve(SPACE_MARK + x) for x in w.split(SPACE_MARK)]
                found[w] = (sum(p for p, _ in parts), sum(s for _, s in parts))
        return (np.fromiter((found[w][0] for w in words), np.int64, len(words)),
                np.fromiter((found[w][1] for w in words), np.float64, len(words)))

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pieces and scores of whole texts."""
        words, counts = split_words(strings(texts))
        distinct, codes = coded(words)
        pieces, scores = self.words(distinct.to_pylist())
        owner = np.repeat(np.arange(len(counts)), counts)
        return (np.bincount(owner, pieces[codes], len(counts)).astype(np.int64),
                np.bincount(owner, scores[codes], len(counts)))


def counter(path: str) -> UnigramCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = UnigramCounter(read_vocabulary(path))
    return _COUNTERS[path]


def token_counts(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens (long), score (double, the sum over its words)."""
    path = vocabulary or default_vocabulary()

    def count(batches):
        own = counter(path)
        for batch in batches:
            for part in slices(batch, "text"):
                pieces, scores = own.texts(part.column("text"))
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column("doc_id"), "n_tokens": pieces, "score": scores})

    return doc_texts(docs, id_col, text_col).mapInArrow(
        count, "doc_id long, n_tokens long, score double")
