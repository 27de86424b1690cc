"""Texts that stand alone in a batch, a partition or a run of bytes."""

import numpy as np
import pytest

from freightmill.llm.decontaminate import contaminated_windows
from freightmill.llm.exact_dedup import mark_exact_duplicates
from freightmill.llm.jaccard_join import near_duplicate_components
from freightmill.llm.line_dedup import line_classes
from freightmill.llm.packing import pack_documents
from freightmill.llm.quality import score_quality, train_quality
from freightmill.llm.shingles import CHUNK_BYTES, in_chunks, shingle_sets
from freightmill.llm.substring_dedup import remove_repeats
from freightmill.llm.token_counts import token_counts
from freightmill.llm.toxicity import score_documents, train

TEXTS = ["", None, " ", "one", "two words", "now three words", "😀 four\x00 words here", "a b c d e"]


def bytes_of(*texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(d) for d in data])


@pytest.mark.parametrize("count", range(12))
@pytest.mark.parametrize("n", [1, 2, 5, 9])
def test_sets_of_few_words(count, n):
    words = [f"w{k}" for k in range(count)]
    values, bounds = shingle_sets(*bytes_of(" ".join(words)), n)
    wanted = 0 if not count else max(1, count - n + 1)
    assert len(values) == wanted and bounds.tolist() == [0, wanted]
    # The same words amid others have the same set.
    among, cut = shingle_sets(*bytes_of("x y z u v w t s r q", " ".join(words), "one two"), n)
    assert among[cut[1] : cut[2]].tolist() == values.tolist()


def test_a_short_text_after_a_full_run():
    data, bounds = bytes_of("x" * (CHUNK_BYTES - 1) + " ", "two words", "three more words")
    found = {first: len(values) for first, values, _ in in_chunks(data, bounds, 5)}
    assert sum(found.values()) == 3


def test_one_row_partitions(spark):
    rows = list(enumerate(TEXTS))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(
        len(rows), "doc_id"
    )
    assert docs.rdd.getNumPartitions() == len(rows)
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "now three words")], "item_id long, text string")
    sets = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicate_components(docs).collect()}
    assert sets == {k: (int(bool((t or "").split())), k) for k, t in rows}
    for out in (
        mark_exact_duplicates(docs), token_counts(docs), remove_repeats(docs),
        score_documents(docs, train(docs, labels)), score_quality(docs, train_quality(docs, labels)),
    ):
        assert out.count() == len(rows)
    assert pack_documents(docs).count() == len(rows)
    assert [r.doc_id for r in contaminated_windows(docs, items).collect()] == [5]
    assert {r.doc_id for r in line_classes(docs).collect()} == {3, 4, 5, 6, 7}
