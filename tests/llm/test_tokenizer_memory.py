"""pipeline, op3: what a worker holds while it tokenises, and that its cache changes no id."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from freightmill.llm import byte_bpe
from freightmill.llm.byte_bpe import ByteBpe, arrow_texts
from freightmill.llm.common import tokenizer_path
from freightmill.llm.packing import token_pieces


def random_texts(count, words, letters="abcdefghijklmnopqrstuvwxyz", seed=5):
    draw = random.Random(seed)
    return [
        " ".join("".join(draw.choices(letters, k=draw.randint(1, 8))) for _ in range(words))
        for _ in range(count)
    ]


def ids_of(bpe, texts):
    return np.concatenate([ids for _, _, ids in bpe.encode(*arrow_texts(pa.array(texts)))])


def test_tokenising_holds_little(monkeypatch):
    monkeypatch.setattr(byte_bpe, "_POWERS", [np.zeros(0, np.uint64), np.zeros(0, np.uint64)])
    bpe = ByteBpe(tokenizer_path())
    data, bounds = arrow_texts(pa.array(random_texts(2_000, 500)))
    assert len(data) > 5_000_000
    byte_bpe._classes()
    tracemalloc.start()
    for _ in bpe.encode(data, bounds):
        pass
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 200e6


def test_a_full_cache_changes_no_id(monkeypatch):
    texts = [*random_texts(60, 120, "abcde"), None, "", "one more text"]
    whole = ids_of(ByteBpe(tokenizer_path()), texts)
    monkeypatch.setattr(byte_bpe, "CACHE_WORDS", 40)
    monkeypatch.setattr(byte_bpe, "CHUNK_BYTES", 1 << 11)
    small = ByteBpe(tokenizer_path())
    assert ids_of(small, texts).tolist() == whole.tolist()
    small._trim()
    assert len(small.known) == 40 == len(small.offsets) - 1
    assert ids_of(small, texts).tolist() == whole.tolist()


def test_texts_go_to_the_tokenizer_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    token_pieces(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert int(spark.conf.get(name)) <= 8 << 20
