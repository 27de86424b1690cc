"""op2: pairs whose parity bits differ too much are left out before the sets are read again."""

import numpy as np

from freightmill.llm import jaccard_join
from freightmill.llm.jaccard_join import may_be_similar, near_duplicate_components, parity_bits


def test_bits_differ_no_more_than_the_sets(spark):
    draw = np.random.default_rng(5)
    sets, pairs, linked, apart = [], [], set(), set()
    for k in range(120):
        size = int(draw.choice([1, 9, 60, 120, 130, 500, 515, 1030, 5000]))
        one = draw.integers(0, 1 << 63, size).astype(np.uint64)
        # From equal sets to sets with nothing in common, many about the bound.
        new = min(size, int(size * draw.choice([0, 0.05, 0.1, 0.11, 0.12, 0.2, 1])))
        other = np.concatenate([one[new:], draw.integers(0, 1 << 63, new).astype(np.uint64)])
        sets += [one, other]
        pairs.append((b"%d" % (2 * k), b"%d" % (2 * k + 1)))
        common = size - new
        if 100 * common >= 80 * (2 * size - common):
            linked.add(pairs[-1])
        if new == size > 100:
            apart.add(pairs[-1])
        if k % 3 == 0:  # a larger set, with bits of another width now and then
            sets[-1] = other = np.concatenate([other, draw.integers(0, 1 << 63, size // 20).astype(np.uint64)])
            if 100 * common < 80 * (size + len(other) - common):
                linked.discard(pairs[-1])
    sizes = np.array([len(s) for s in sets])
    bits = parity_bits(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), sizes)
    units = spark.createDataFrame(
        [(b"%d" % k, k, len(s), b) for k, (s, b) in enumerate(zip(sets, bits))],
        "unit binary, one long, n long, parity binary",
    )
    found = may_be_similar(spark.createDataFrame(pairs, "a binary, b binary"), units, 80).collect()
    kept = {(bytes(r.a), bytes(r.b)) for r in found}
    assert linked <= kept and 0 < len(linked) < len(pairs)
    assert all(r.one_a == int(r.a) and r.one_b == int(r.b) for r in found)
    assert apart and not apart & kept


def test_only_similar_texts_are_read_again(spark, monkeypatch):
    draw = np.random.default_rng(6)

    def words(count):
        return [f"w{x}" for x in draw.integers(0, 1 << 40, count)]

    # All share a rare passage, which their prefixes hold; only the last two are similar.
    passage = words(25)
    texts = [" ".join(passage + words(20)) for _ in range(12)]
    near = words(60)
    texts += [" ".join(near), " ".join([*near[:-1], "other"])]
    wanted = []

    def counted(ids):
        wanted.append(ids.distinct().count())
        return bitmap_of(ids)

    bitmap_of = jaccard_join.bitmap_of
    monkeypatch.setattr(jaccard_join, "bitmap_of", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = near_duplicate_components(docs).collect()
    assert {r.doc_id: r.component_id for r in rows} == {k: min(k, 12) for k in range(14)}
    assert max(wanted) == 2
