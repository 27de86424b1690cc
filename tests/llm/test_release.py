"""op7: disk is let go of, and windows of many texts are named at once."""

import random
import time

import numpy as np

from freightmill.llm import common
from freightmill.llm.substring_dedup import named_grams


def test_cut_lets_go_of_shuffle_files(spark, monkeypatch):
    monkeypatch.setattr(common, "RELEASE_EVERY", 0.0)
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = store.getAllFiles()
        return {str(files.apply(k).getName()) for k in range(files.size())}

    before = shuffled()
    kept = common.cut(spark.range(20_000).repartition(7, "id"))
    made = {f for f in shuffled() - before if f.startswith("shuffle")}
    for _ in range(40):
        common.cut(spark.range(1))
        if not made & shuffled():
            break
        time.sleep(0.25)
    assert not made & shuffled()
    assert kept.count() == 20_000


def test_named_grams_of_many_texts_at_once():
    draw = random.Random(3)
    texts = ["ab" * 70, "", "x" * 99, "y" * 100, *("".join(draw.choices("ab", k=draw.randint(0, 400))) for _ in range(30))]
    texts += ["", "z" * 130]
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    found = list(zip(*(c.tolist() for c in named_grams(np.concatenate(raw), bounds, 100, 40))))
    alone = []
    for k, one in enumerate(raw):
        _, hashes, first, last = named_grams(one, np.array([0, len(one)]), 100, 40)
        assert sum((last - first + 1).tolist()) == max(0, len(one) - 99)
        alone += [(k, h, f + bounds[k], t + bounds[k]) for h, f, t in zip(hashes, first, last)]
    assert found == alone
