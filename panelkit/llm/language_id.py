"""Language identification with hyperdimensional profiles (operator 2).

Every letter (and the gap between words) has a random vector of +1 and -1 drawn from its
code point. A trigram abc is bound as rot2(a) * rot1(b) * c, where rotk turns a vector by k
places; a text is the bundle (sum) of its trigrams, scaled to length one. The prototype of a
language is the bundle of its training texts; a text gets the language whose prototype has
the largest cosine with it, and the cosine as score.

Texts are lower-cased, everything but letters counts as a gap, gaps are one deep and stand
at both ends. Work per text is one product of its trigram counts with the bound vectors of
the trigrams of its slice. Training is one pass that adds up prototypes per task and then
sums them by (language, dimension): what reaches the driver is the model, languages x
dimensions, whatever the number of documents.

Cases: null text or text without a letter gives ``und`` with score 0, and such texts do not
train; a null label does not train; no training text at all gives ``und`` with score 0 for
every document; ties go to the first language by code point; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm._common import slices

DIMS = 512
UNDETERMINED = "und"
#: Letters kept with their vectors by one Python worker; emptied when full.
KNOWN_LETTERS = 4096
SLICE_BYTES = 1 << 20
#: Bound trigram vectors made at once.
BOUND_AT_ONCE = 2048

_SPACES: dict[tuple[int, int], "LetterSpace"] = {}


def _letter_table() -> np.ndarray:
    """Code point -> itself for letters, 0 for all others."""
    table = np.arange(0x110000, dtype=np.uint32)
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    table[~letter] = 0
    return table


class LetterSpace:
    """Vectors of letters and bundles of texts."""

    def __init__(self, dims: int = DIMS, seed: int = 3):
        self.dims, self.seed = dims, seed
        self.letters = _letter_table()
        self.known, self.room = 0, KNOWN_LETTERS
        self.slot_of = np.full(0x110000, -1, np.int32)
        self.turned = np.zeros((3, self.room, dims), np.float32)  # turned by 2, 1 and 0 places

    def _slots(self, points: np.ndarray) -> np.ndarray:
        new = np.unique(points[self.slot_of[points] < 0])
        if self.known + len(new) > self.room:
            self.slot_of[:] = -1
            self.known, new = 0, np.unique(points)
            if len(new) > self.room:
                self.room = 2 * len(new)
                self.turned = np.zeros((3, self.room, self.dims), np.float32)
        for p in new.tolist():
            own = np.random.Generator(np.random.Philox(key=[self.seed, p]))
            v = 1 - 2 * own.integers(0, 2, self.dims)
            for k in range(3):
                self.turned[k, self.known] = np.roll(v, 2 - k)
            self.slot_of[p] = self.known
            self.known += 1
        return self.slot_of[points].astype(np.int64)

    def bundles(self, texts: list[str | None]) -> np.ndarray:
        """Unit vectors of texts (all zero without a letter)."""
        out = np.zeros((len(texts), self.dims), np.float32)
        padded = [f" {t.lower() if t else ''} " for t in texts]
        sizes = np.fromiter(map(len, padded), np.int64, len(padded))
        raw = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
        points, owner = self.letters[raw], np.repeat(np.arange(len(texts)), sizes)
        keep = points > 0  # and the first of each run of gaps
        keep[1:] |= points[:-1] > 0
        keep[np.cumsum(sizes) - sizes] = True
        points, owner = points[keep], owner[keep]
        if len(points) < 3:
            return out
        slots = self._slots(points)
        k = max(self.known, 1)
        whole = owner[:-2] == owner[2:]
        keys = np.sort((((owner[:-2] * k + slots[:-2]) * k + slots[1:-1]) * k + slots[2:])[whole])
        if not len(keys):
            return out
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        counts = np.diff(np.r_[new, len(keys)])
        docs, kinds = np.divmod(keys[new], k ** 3)
        kinds, column = np.unique(kinds, return_inverse=True)
        for low in range(0, len(kinds), BOUND_AT_ONCE):
            some = kinds[low:low + BOUND_AT_ONCE]
            bound = self.turned[0][some // (k * k)]
            bound *= self.turned[1][some // k % k]
            bound *= self.turned[2][some % k]
            mine = (column >= low) & (column < low + len(some))
            table = np.zeros((len(texts), len(some)), np.float32)
            table[docs[mine], column[mine] - low] = counts[mine]
            out += table @ bound
        norm = np.sqrt(np.einsum("ij,ij->i", out, out))
        return out / np.maximum(norm, 1e-12)[:, None]


def letter_space(dims: int, seed: int) -> LetterSpace:
    if (dims, seed) not in _SPACES:
        _SPACES[dims, seed] = LetterSpace(dims, seed)
    return _SPACES[dims, seed]


def fit(docs: DataFrame, dims: int = DIMS, seed: int = 3, text_col: str = "text",
        lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Prototypes by language, from every row with a label and a letter."""
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang")).where("lang is not null")

    def bundle(batches):
        space, sums, n = letter_space(dims, seed), {}, {}
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                vectors = space.bundles(part.column("text").to_pylist())
                for lang, v in zip(part.column("lang").to_pylist(), vectors):
                    if v.any():
                        if lang not in sums:
                            sums[lang], n[lang] = np.zeros(dims), 0
                        sums[lang] += v
        for lang, v in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * dims, "dim": pa.array(range(dims), pa.int32()), "v": v})

    model: dict[str, np.ndarray] = {}
    sums = rows.mapInArrow(bundle, "lang string, dim int, v double").groupBy("lang", "dim").agg(F.sum("v").alias("v"))
    for r in sums.collect():  # languages x dims numbers
        model.setdefault(r.lang, np.zeros(dims))[r.dim] = r.v
    return {k: model[k] / max(np.linalg.norm(model[k]), 1e-12) for k in sorted(model, key=str.encode)}


def predict(docs: DataFrame, model: dict[str, np.ndarray], dims: int = DIMS, seed: int = 3,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, lang_pred, score."""
    langs = list(model)
    matrix = np.array([model[k] for k in langs]).reshape(len(langs), dims).T

    def guess(batches):
        space = letter_space(dims, seed)
        names = np.array([*langs, UNDETERMINED], dtype=object)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                vectors = space.bundles(part.column("text").to_pylist()).astype(np.float64)
                n = part.num_rows
                best, score = np.full(n, len(langs)), np.zeros(n)
                if langs:
                    cosines = vectors @ matrix
                    some = vectors.any(axis=1)
                    best = np.where(some, cosines.argmax(axis=1), len(langs))
                    score = np.where(some, np.clip(cosines.max(axis=1), 0.0, 1.0), 0.0)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"),
                                                  "lang_pred": pa.array(names[best], pa.string()), "score": score})

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(guess, "doc_id long, lang_pred string, score double")


def fold(doc_id):
    """crc32 of the id as text, modulo 4; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4
