"""Quality rules with risk-controlled thresholds (operator 6).

Features of a text (see ``text_features``) give three scores, each growing with what a rule
would reject: symbols per 1000 characters of words, duplicate lines per 1000 lines, repeated
words per 1000 words. A rule rejects a document whose score lies above its cutoff.

The cutoffs come from labelled documents only (quality 1: good). For every stratum (the
language), every rule and every point of a fixed grid of cutoffs, the good labelled
documents that the cutoff would reject are counted. The exact (Clopper-Pearson) upper bound of its
false rejection rate is taken at the confidence left after dividing ``delta`` by the number of
all tests of all strata (Bonferroni). A document is rejected if any rule rejects it, so the
bounds of the cutoffs of a stratum may sum to ``risk`` at most. Of the combinations within that
sum the one whose cutoffs reject most bad labelled documents (added over the rules) is taken, and
of equal ones the one of the highest cutoffs; a rule that rejects no bad document, or of which
more good than bad documents would go, stays off in that stratum. A stratum without enough
labels keeps all.

The guarantee: with probability 1 - delta over the labelled sample, the rules of any stratum
together reject no more than the share ``risk`` of the good documents.

Counting is one pass with partial aggregation; only counts (strata x rules x grid) reach the
driver. The number of strata is the number of languages, which is checked (``MAX_STRATA``).

Cases: null or empty text has no words and fails the base rules; a null label value takes no
part; several label rows of one document count each; documents without labels are judged
like all; a null stratum is a stratum of its own; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm._common import coded, materialise, mix64, slices, split_words, strings

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
RISK = 0.02
DELTA = 0.05
#: Cutoffs tried, in parts per 1000.
GRID = (5, 10, 20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500, 600, 700, 800, 900)
RULES = ("symbols", "dup_lines", "repeats")
MAX_STRATA = 10_000

FEATURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def text_features(column: pa.Array, window: int = WINDOW) -> dict[str, np.ndarray]:
    """The counts of FEATURES for each text of an array."""
    texts = strings(column)
    words, n_words = split_words(texts)
    n = len(texts)
    owner = np.repeat(np.arange(n), n_words)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    symbols = pc.count_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False)
    # lines with a word, equal to an earlier line of the same text
    lists = pc.split_pattern(texts, "\n")
    lines, line_owner = lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    full = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    lines, line_owner = lines.filter(pa.array(full)), line_owner[full].astype(np.int64)
    kinds, codes = coded(lines)
    seen = np.unique(line_owner * max(len(kinds), 1) + codes) // max(len(kinds), 1)
    n_lines = np.bincount(line_owner, minlength=n)
    return {"n_words": n_words, "word_chars": np.bincount(owner, chars, n).astype(np.int64),
            "n_symbols": symbols.astype(np.int64), "n_lines": n_lines,
            "n_dup_lines": n_lines - np.bincount(seen, minlength=n),
            "n_repeat_words": repeated_words(words, n_words, window)}


def repeated_words(words: pa.Array, n_words: np.ndarray, window: int) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in that text."""
    n, total = len(n_words), int(n_words.sum())
    if total < window:
        return np.zeros(n, np.int64)
    _, codes = coded(words)
    owner = np.repeat(np.arange(n, dtype=np.int64), n_words)
    # two independent 64-bit hashes of each window of codes: equal windows, equal hashes
    m = total - window + 1
    with np.errstate(over="ignore"):
        base = mix64(codes + 1)
        a, b = mix64(owner[:m] + 1), np.zeros(m, np.uint64)
        for k in range(window):
            a = a * np.uint64(0x9E3779B97F4A7C15) + base[k:k + m]
            b = b * np.uint64(0xC2B2AE3D27D4EB4F) + (base[k:k + m] ^ np.uint64(0x5851F42D4C957F2D))
    inside = owner[:m] == owner[window - 1:]
    at = np.flatnonzero(inside)
    key = mix64(a[at]) ^ b[at]
    order = np.argsort(key, kind="stable")
    ranked, who = key[order], owner[at][order]
    same = (ranked[1:] == ranked[:-1]) & (who[1:] == who[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    begins = at[order[twice]]
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, begins, 1)
    np.add.at(cover, begins + window, -1)
    covered = np.cumsum(cover[:-1]) > 0
    return np.bincount(owner[covered], minlength=n)


def features(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (each a select expression with an alias) and FEATURES."""
    rows = docs.select(*keep, F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = rows.drop("__text").schema
    for f in FEATURES:
        schema = schema.add(f, "long")
    names = [f.name for f in rows.schema if f.name != "__text"]

    def measure(batches):
        for batch in batches:
            for part in slices(batch, "__text"):
                got = text_features(part.column("__text"))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [pa.array(got[f]) for f in FEATURES],
                                                 names=[*names, *FEATURES])

    return rows.mapInArrow(measure, schema)


def scores() -> dict:
    """Rule -> score in parts per 1000, as columns over FEATURES."""
    def share(a, b):
        return F.floor(1000 * F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("long")
    return {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"),
            "repeats": share("n_repeat_words", "n_words")}


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def binomial_upper(k: int, n: int, alpha: float) -> float:
    """Clopper-Pearson upper bound: the rate at which k or fewer of n have probability alpha."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]

    def below(p):
        return sum(math.exp(c + i * math.log(p) + (n - i) * math.log1p(-p)) for i, c in enumerate(logs))

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if mid <= 0.0 or below(mid) > alpha:
            low = mid
        else:
            high = mid
    return high


def choose_cutoffs(counts: list[dict], risk: float = RISK, delta: float = DELTA, grid=GRID,
                   rules=RULES) -> list[tuple]:
    """(stratum, rule, cutoff) from rows with stratum, good, bad and, for each rule and grid
    point, the rejected good and bad documents (``good_<rule>_<cutoff>``, ``bad_...``)."""
    tests = max(1, len(counts) * len(rules) * len(grid))
    out = []
    for row in counts:
        combined = [(0.0, 0, ())]  # bound, bad documents, cutoffs (None: off)
        for rule in rules:
            options = [(0.0, 0, None)]
            for cut in grid:
                good, bad = row[f"good_{rule}_{cut}"], row[f"bad_{rule}_{cut}"]
                if good > risk * row["good"] or bad <= good:
                    continue
                upper = binomial_upper(good, row["good"], delta / tests)
                if upper <= risk:
                    options.append((upper, bad, cut))
            combined = [(u + upper, b + bad, (*cuts, cut)) for u, b, cuts in combined
                        for upper, bad, cut in options if u + upper <= risk]
        best = max(combined, key=lambda c: (c[1], [math.inf if cut is None else cut for cut in c[2]]))
        out += [(row["stratum"], rule, cut) for rule, cut in zip(rules, best[2]) if cut is not None]
    return out


def fit_cutoffs(featured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> list[tuple]:
    """Cutoffs from a table with doc_id, stratum and FEATURES, and (doc_id, quality)."""
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality")
                          ).where("label_id is not null and quality is not null")
    own = scores()
    rows = featured.where(~base_failed()).select("doc_id", "stratum", *[own[r].alias(r) for r in RULES])
    rows = rows.join(known, rows["doc_id"] == known["label_id"])
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    aggs = [F.count_if(good).alias("good"), F.count_if(bad).alias("bad")]
    for rule in RULES:
        for cut in GRID:
            aggs += [F.count_if(good & (F.col(rule) > cut)).alias(f"good_{rule}_{cut}"),
                     F.count_if(bad & (F.col(rule) > cut)).alias(f"bad_{rule}_{cut}")]
    counts = [r.asDict() for r in rows.groupBy("stratum").agg(*aggs).limit(MAX_STRATA + 1).collect()]
    if len(counts) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata")
    return choose_cutoffs(counts, risk, delta)


def judge(featured: DataFrame, cutoffs: list[tuple]) -> DataFrame:
    """Adds base_failed and kept to a table with stratum and FEATURES."""
    own = scores()
    by: dict = {}
    for stratum, rule, cut in cutoffs:
        by.setdefault(stratum, {})[rule] = cut
    table = featured.sparkSession.createDataFrame(
        [(s, *[c.get(r) for r in RULES]) for s, c in by.items()] or [("", *[None] * len(RULES))],
        "of string, " + ", ".join(f"cut_{r} long" for r in RULES))
    # the table has one row per stratum, MAX_STRATA at most
    rows = featured.join(F.broadcast(table), F.col("stratum").eqNullSafe(F.col("of")), "left").drop("of")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(own[rule] > F.col(f"cut_{rule}"), F.lit(False))
    rows = rows.withColumn("base_failed", base_failed())
    rows = rows.withColumn("kept", ~F.col("base_failed") & ~rejected)
    return rows.drop(*[f"cut_{r}" for r in RULES])


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA,
                  id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Per document: doc_id, stratum, FEATURES, base_failed, kept."""
    featured = materialise(features(docs, [F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                                           F.col(f"`{stratum_col}`").cast("string").alias("stratum")], text_col),
                           "quality-features")
    return judge(featured, fit_cutoffs(featured, labels, risk, delta))


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA,
              id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the cutoffs, with their columns.

    Two passes over the texts: one for the counts behind the cutoffs, one that judges each
    row where it is read, so that no text is shuffled.
    """
    light = features(docs, [F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                            F.col(f"`{stratum_col}`").cast("string").alias("stratum")], text_col)
    cutoffs = fit_cutoffs(light, labels, risk, delta)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    wide = features(docs, [whole, F.col(f"`{stratum_col}`").cast("string").alias("stratum")], text_col)
    return judge(wide, cutoffs).where("kept").select("row.*")
