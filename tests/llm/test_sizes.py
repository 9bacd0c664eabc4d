"""What grows with the corpus: the set of shared anchors (op 5), blocks of texts (op 11)."""

import numpy as np

from panelkit.llm import alignment, suffix_dedup
from panelkit.llm._common import doc_texts


def test_filters_pass_all_shared_anchors_and_few_others():
    own, bits = np.random.default_rng(3), 6
    short = np.unique(own.integers(0, 1 << 48, 40_000, dtype=np.uint64))
    short = short[short >> np.uint64(42) != 5]  # a bucket without any
    bucket = (short >> np.uint64(48 - bits)).astype(int)
    filters = {b: suffix_dedup.filter_of(short[bucket == b]) for b in range(1 << bits)}
    table = suffix_dedup.SharedAnchors(filters, bits)
    assert table.known(short).all()
    others = np.setdiff1d(own.integers(0, 1 << 48, 100_000, dtype=np.uint64), short)
    assert table.known(others).mean() < 0.01
    assert not table.known(others[others >> np.uint64(42) == 5]).any()
    assert len(table.data) < 2.1 * len(short)  # 8 bytes an anchor as a list
    assert not suffix_dedup.SharedAnchors({}, bits).known(others).any()


def test_many_anchors_are_still_sent_as_filters():
    assert suffix_dedup.BROADCAST_ANCHORS * suffix_dedup.FILTER_BITS // 8 <= 64_000_000
    assert suffix_dedup.BROADCAST_ANCHORS >= 26_000_000  # about those of 6 GB of documents


def test_blocks_hold_two_megabytes_of_text(spark):
    text = "the quick brown fox jumps over the lazy dog " * 30_000  # 1.3 MB
    docs = spark.createDataFrame([(k, text) for k in range(3)], "doc_id long, text string").coalesce(1)
    blocks = alignment._blocks(doc_texts(docs, "doc_id", "text"), *alignment.default_tokenizers()).select("ids").collect()
    assert [len(b["ids"]) for b in blocks] == [1, 1, 1]
