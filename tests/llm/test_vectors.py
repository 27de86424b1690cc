"""Hard negatives, quality and whitening against plain versions, and on awkward tables."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from freightmill.llm.hard_negatives import mine_hard_negatives
from freightmill.llm.quality import class_prior, score_quality, train_quality
from freightmill.llm.queries import ORACLES, QUERIES
from freightmill.llm.split_tree import SplitTree, lift
from freightmill.llm.text_measures import MEASURES, measure_texts
from freightmill.llm.whitening import cross_products, whitened_components

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, score string, id int, region long"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 2) for r in rows], VECTORS)


def plain_negatives(rows, is_anchor, positives=5, negatives=3):
    """Every anchor against every row."""
    ids = np.array([r[0] for r in rows])
    label = np.array([r[2] for r in rows])
    x = np.array([[math.floor(256 * v) for v in r[1]] for r in rows], object)
    out = []
    for a in [k for k in range(len(rows)) if is_anchor(ids[k])]:
        scores = [int(s) for s in x @ x[a]]
        order = sorted((k for k in range(len(rows)) if k != a), key=lambda k: (-scores[k], ids[k]))
        for p in [k for k in order if label[k] == label[a]][:positives]:
            fits = [
                k
                for k in order
                if label[k] != label[a] and 50 * scores[p] <= 100 * scores[k] <= 95 * scores[p]
            ]
            for rank, n in enumerate(fits[:negatives], 1):
                out.append((ids[a], ids[p], rank, ids[n], scores[p], scores[n]))
    return sorted(out)


def clustered(seed, count, width, copies=0):
    """Vectors around a few centres, some of them copies of one, as lists of floats."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, width))
    rows = centres[draw.integers(0, 6, count)] + 0.2 * draw.normal(size=(count, width))
    rows[:copies] = rows[0]
    return [(int(k), r.tolist(), int(draw.integers(0, 4))) for k, r in enumerate(rows)]


@pytest.mark.parametrize("seed, count, width, copies", [(1, 300, 3, 0), (2, 400, 8, 150)])
def test_negatives_of_clusters(spark, seed, count, width, copies):
    rows = clustered(seed, count, width, copies)
    draw = random.Random(seed)
    draw.shuffle(rows)
    found = mine_hard_negatives(
        vectors(spark, rows), F.col("vec_id") % 9 == 0, chunk_rows=40, anchor_block=7, sample_rows=90
    )
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, lambda i: i % 9 == 0)


def test_large_components_are_exact(spark):
    draw = random.Random(4)
    rows = [(k, [draw.uniform(-3e5, 3e5) for _ in range(5)], k % 3) for k in range(120)]
    found = mine_hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, chunk_rows=50)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_ranges_rule_out_leaves_without_losing_any():
    draw = np.random.default_rng(5)
    x = (200 * clustered_matrix(draw, 2000, 6)).astype(np.int64)
    longest = int((x * x).sum(axis=1).max())
    tree, members = SplitTree.build(lift(x, longest), longest, 50)
    queries = x[::40].astype(float)
    scores = x[::40] @ x.T
    low = np.sort(scores, axis=1)[:, -20:-19]
    high = np.sort(scores, axis=1)[:, -5:-4]
    who, leaf = tree.leaves_of(queries, low, high)
    pairs = set(zip(who.tolist(), leaf.tolist()))
    assert len(pairs) < 0.7 * len(queries) * tree.leaves
    for number, rows in enumerate(members):
        for q in range(len(queries)):
            inside = (scores[q, rows] >= low[q, 0]) & (scores[q, rows] <= high[q, 0])
            assert not inside.any() or (q, number) in pairs


def clustered_matrix(draw, count, width):
    return draw.normal(size=(12, width))[draw.integers(0, 12, count)] + 0.1 * draw.normal(
        size=(count, width)
    )


def test_negatives_of_awkward_rows(spark):
    good = [(k, [math.cos(k), math.sin(k), 0.5], k % 2) for k in range(40)]
    odd = [
        (None, [1.0, 0.0, 0.0], 1), (50, None, 1), (51, [1.0, 0.0, 0.0], None),
        (52, [None, 0.0, 0.0], 1), (53, [math.nan, 0.0, 0.0], 1), (54, [math.inf, 0.0, 0.0], 1),
        (55, [1e300, 0.0, 0.0], 0), (56, [1.0, 0.0], 0), (57, [], 0),
    ]
    table = vectors(spark, good + odd + good[:7])
    found = mine_hard_negatives(table, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == plain_negatives(good, lambda i: i % 10 == 0)
    # Of two rows with one id the smaller counts.
    twice = vectors(spark, [*good, (0, [9.0, 9.0, 9.0], 5)])
    assert sorted(mine_hard_negatives(twice, F.col("vec_id") % 10 == 0).collect()) == sorted(
        found.collect()
    )
    for table in (table.where("false"), vectors(spark, odd), vectors(spark, good[:1])):
        assert mine_hard_negatives(table, F.col("vec_id") % 10 == 0).count() == 0
    nobody = mine_hard_negatives(vectors(spark, good), F.lit(None).cast("boolean"))
    assert nobody.count() == 0


def test_negatives_query_and_sql(spark):
    import duckdb

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    frame = QUERIES["op11_hard_negatives"](spark, SMALL)
    result = duck.execute(ORACLES["op11_hard_negatives"])
    assert [d[0] for d in result.description] == frame.columns
    want = sorted(tuple(r) for r in result.fetchall())
    assert sorted(map(tuple, frame.collect())) == want and want


def test_cross_products_are_exact():
    draw = np.random.default_rng(3)
    for top, count in ((1, 1), (2, 63), (200, 777), (2**40, 65), (2**62, 130)):
        rows = draw.integers(0, top, (count, 4))
        assert (cross_products(rows) == rows.astype(object).T @ rows.astype(object)).all()


def check_whitening(out, rows):
    """``rows``: (id, values) that take part."""
    ids = [r[0] for r in rows]
    x = np.array([[math.floor(64 * v) + 1_000_000 for v in r[1]] for r in rows], object)
    n, sums = len(x), x.sum(axis=0)
    gap = n * x - sums
    exact = {i: int(d) for i, d in zip(ids, (gap * gap).sum(axis=1))}
    table = out.toPandas()
    assert set(table.vec_id) == set(ids) and set(table.n) == {n}
    assert all(int(d) == exact[i] for i, d in zip(table.vec_id, table.deviation))
    covariance = (gap.T @ gap / n**4 * n).astype(float)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    kept = table.component.max()
    wide = table.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    for c in range(kept):
        along = (gap / n).astype(float) @ axes[:, c] / math.sqrt(values[c])
        assert np.abs(np.abs(wide[:, c]) - np.abs(along)).max() < 1e-6
        share = table.explained[table.component == c + 1].iloc[0]
        assert abs(share - values[c] / values.sum()) < 1e-9
    measured = np.abs(wide.T @ wide / n - np.eye(kept)).max()
    assert measured < 1e-9 and table.identity_error.nunique() == 1
    assert abs(table.identity_error.iloc[0] - measured) < 1e-9
    return kept


def test_whitening(spark):
    draw = np.random.default_rng(8)
    spread = np.diag([3.0, 2.0, 1.2, 0.7, 0.4])
    good = [(k, r.tolist(), 0) for k, r in enumerate(draw.normal(size=(500, 5)) @ spread + 7)]
    odd = [
        (900, None, 1), (901, [None, 1.0, 2.0, 3.0, 4.0], 1), (902, [math.nan] * 5, 1),
        (903, [-math.inf] * 5, 1), (904, [1e300] * 5, 1), (905, [1.0], 1), (906, [], 1),
    ]
    frame = vectors(spark, good + odd).repartition(7)
    assert check_whitening(whitened_components(frame), good) == 5
    assert whitened_components(frame, components=2).count() == 1000
    large = [(k, [1e13 * v for v in r], 0) for k, r, _ in good[:60]]
    assert check_whitening(whitened_components(vectors(spark, large)), large) == 5


def test_whitening_of_awkward_tables(spark):
    line = [(k % 10, [float(k % 10), 2.0 * (k % 10), 1.0], 0) for k in range(30)]
    out = whitened_components(vectors(spark, line)).collect()
    # One direction has all the variance; repeated rows each get theirs.
    assert len(out) == 30 and {r.component for r in out} == {1}
    assert all(abs(r.explained - 1) < 1e-9 for r in out)
    nulls = vectors(spark, [(None, [1.0, 2.0], 0), (1, [2.0, 1.0], 0)])
    assert sorted((r.vec_id is None, r.n) for r in whitened_components(nulls).collect()) == [
        (False, 2), (True, 2),
    ]
    for rows in ([], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(1, [3.0], 0), (2, [3.0], 0)]):
        empty = whitened_components(vectors(spark, rows))
        assert empty.count() == 0
        assert empty.columns == [
            "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
        ]


def test_whitening_query(spark):
    frame = QUERIES["op13_whitening"](spark, SMALL)
    assert dict(frame.dtypes)["deviation"] == "bigint"
    stored = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    assert check_whitening(frame, [(r.vec_id, r.embedding) for r in stored]) == 32


def measures_of(*texts):
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0] + [len(d) for d in data])
    table = measure_texts(np.frombuffer(b"".join(data), np.uint8), bounds)
    return [dict(zip(MEASURES, row)) for row in table]


def test_measures_of_texts():
    plain, again, none, loud, words = measures_of(
        "One two three.\nOne two four!", "so so so so", " \n ", "A!! B#c", "é" * 3
    )
    assert plain["distinct_words"] == pytest.approx(math.log1p(4) / math.log1p(6))
    # Case does not count, but "three." and "four!" are words of their own.
    assert plain["distinct_lines"] == 1 and plain["words_ending_a_sentence"] == 2 / 6
    assert again["word_again"] == 3 / 4 and again["commonest_word"] == 1
    assert again["distinct_pairs"] == 1 / 3
    assert set(none.values()) == {0.0}
    assert loud["symbols"] == 1 / 7 and loud["exclamations"] == 2 / 7
    assert words["beyond_ascii"] == 1
    assert measures_of() == [] and set(measures_of("")[0].values()) == {0.0}


def test_class_prior_of_known_mixtures():
    draw = np.random.default_rng(2)
    for prior in (0.2, 0.5, 0.9):
        good = draw.beta(5, 2, 20_000)
        every = np.where(draw.random(20_000) < prior, draw.beta(5, 2, 20_000), draw.beta(1, 9, 20_000))
        counts = [np.histogram(s, 4096, (0, 1))[0].astype(float) for s in (every, good)]
        assert abs(class_prior(*counts) - prior) < 0.04
    assert class_prior(np.zeros(4096), np.zeros(4096)) == 0.5


def test_quality_of_held_out_rows(spark):
    """Labels of held-out rows are never read: they could as well be wrong."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    wrong = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    model = train_quality(docs, wrong)
    scored = score_quality(docs, model, keep=["doc_id"]).join(labels, "doc_id")
    rows = scored.where("held_out").select("score", "predicted", "quality").toPandas()
    assert len(rows) > 900
    rank = rows.score.rank().to_numpy()
    good = rows.quality.to_numpy() == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.98
    assert rows.predicted[good].mean() > 0.97 and rows.predicted[~good].mean() < 0.05
    assert abs(model.prior - 0.86) < 0.04


def test_quality_of_awkward_tables(spark):
    schema = "doc_id long, text string, score string, text_ int, half string, measures double"
    prose = [" ".join(f"word{(k * j) % 37}" for j in range(1, 60)) + "." for k in range(1, 40)]
    junk = ["$$$ &&& %%% " * k for k in range(1, 10)]
    texts = [*prose, *junk, None, "", " \n", "tiny", "long text " * 50_000]
    rows = [(k, t, "x", 1, "h", 0.5) for k, t in enumerate(texts)]
    rows += [rows[0], (None, "without an id", "x", 1, "h", 0.5), (None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    marks = [(k, 1) for k in range(len(prose))] + [(3, 0), (40, 0), (41, None), (None, 1), (0, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = train_quality(docs, labels)
    out = score_quality(docs, model)
    assert set(out.columns) == {*docs.columns, "held_out", "predicted"}
    found = out.collect()
    assert len(found) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    score = {r.doc_id: r.score for r in found}
    empty = [score[k] for k, t in enumerate(texts) if t is None or not t.strip()]
    assert len(set(empty)) == 1
    assert np.mean([score[k] for k in range(len(prose))]) > np.mean(
        [score[k] for k in range(len(prose), len(prose) + len(junk))]
    )
    nothing = docs.where("false")
    none = train_quality(nothing, labels.where("false"))
    assert score_quality(nothing, none).count() == 0
    unsure = score_quality(docs, train_quality(docs, labels.where("false")))
    assert {r.score for r in unsure.collect()} == {0.5}
