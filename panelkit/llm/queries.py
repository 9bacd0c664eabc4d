"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import (alignment, ann, collocations, language_id, mixing, ngram_join, packing, quality, simhash,
                          suffix_dedup, token_counts, token_files, warc)
from panelkit.llm._common import importable
from panelkit.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return run
    return register


@query("op1_token_counts")
def op1(spark, sf_dir):
    """Unigram pieces of every document."""
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"))


@query("op2_language_id")
def op2(spark, sf_dir):
    """Language of every document, learnt from three of the four folds."""
    docs = read_table(spark, sf_dir, "documents")
    held = language_id.fold(F.col("doc_id")) == 2
    model = language_id.fit(docs.where(~held))
    return language_id.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query("op3_mixing")
def op3(spark, sf_dir):
    """Words that the mix takes of every document."""
    return mixing.draw(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op4_warc", """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM g
""")
def op4(spark, sf_dir):
    """Every page written to WARC archives and read back."""
    return warc.warc_round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_suffix_dedup")
def op5(spark, sf_dir):
    """Bytes of every document that a smaller id has."""
    return suffix_dedup.removal_report(read_table(spark, sf_dir, "documents"))


@query("op6_quality_rules")
def op6(spark, sf_dir):
    """Counts and verdict of every document."""
    rows = quality.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept")


@query("op7_packing")
def op7(spark, sf_dir):
    """Pieces of every document in sequences along the curve."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


@query("op8_nearest")
def op8(spark, sf_dir):
    """Ten nearest vectors of every hundredth."""
    return ann.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op9_ngram_join", """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 3
      THEN list_distinct([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)])
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
sets AS (SELECT sh, len(sh) AS n, min(doc_id) AS rep FROM (SELECT doc_id, list_sort(sh) AS sh FROM s WHERE len(sh) > 0) GROUP BY sh),
e AS (SELECT rep, n, unnest(sh) AS g FROM sets),
o AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS i
      FROM e a JOIN e b ON a.g = b.g AND a.rep < b.rep AND 100 * b.n >= 90 * a.n AND 100 * a.n >= 90 * b.n GROUP BY 1, 2),
l AS (SELECT a, b FROM o WHERE 100 * i >= 90 * (na + nb - i)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(x, y) AS (SELECT rep, rep FROM sets UNION SELECT r.x, u.b FROM reach r JOIN u ON r.y = u.a),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(c.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN sets ON list_sort(s.sh) = sets.sh LEFT JOIN c ON c.x = sets.rep
""")
def op9(spark, sf_dir):
    """Components of documents whose shingle sets are alike."""
    return ngram_join.jaccard_join(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


@query("op10_token_files")
def op10(spark, sf_dir):
    """Every document's ids written to token files and read back."""
    return token_files.token_files(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


@query("op11_alignment")
def op11(spark, sf_dir):
    """Groups and links of two tokenizers in every document."""
    return alignment.align_corpus(read_table(spark, sf_dir, "documents"))


@query("op12_simhash")
def op12(spark, sf_dir):
    """Fingerprints, and components of those that differ in two bits or fewer."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op13_collocations", """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM d),
g AS (
  SELECT lang, m, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN range(1, len(ws) - m + 2)]) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(ws) >= m),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
t AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM f WHERE m > 1),
s AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, t.n,
    CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(l.a AS HUGEINT) * r.a) AS score
  FROM c JOIN t ON t.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.k + 1:c.m], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
u AS (SELECT lang, a, unnest(flatten([[array_to_string(ws[i:i + x - 1], ' ') FOR i IN range(1, m - x + 2)] FOR x IN range(2, m)])) AS phrase
      FROM (SELECT lang, a, m, string_split(phrase, ' ') AS ws FROM f WHERE m > 2)),
o AS (SELECT lang, phrase, max(a) AS most FROM u GROUP BY ALL),
q AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.most IS NULL OR 100 * o.most < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM q QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
""")
def op13(spark, sf_dir):
    """The first 2000 collocations of each language."""
    return collocations.collocations(read_table(spark, sf_dir, "documents"))
