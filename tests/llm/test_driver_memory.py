"""Links and components: fewer stages for the driver to keep, and its free memory handed back."""

import itertools

import numpy as np
import pytest

from freightmill.llm import common
from freightmill.llm.components import components, two_rows
from freightmill.llm.jaccard_join import near_duplicate_components

numbers = itertools.count()


def stages_run(spark, work):
    """What ``work`` returns, and how many stages ran for it."""
    context, group = spark.sparkContext, f"counted-{next(numbers)}"
    context.setJobGroup(group, group)
    try:
        result = work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    tracker = context.statusTracker()
    found = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    infos = [tracker.getStageInfo(s) for s in found]
    return result, sum(bool(i and i.numCompletedTasks) for i in infos)


def test_components_of_a_path_in_few_stages(spark):
    links = spark.range(200).selectExpr("id AS a", "id + 1 AS b").localCheckpoint()
    rows, stages = stages_run(spark, lambda: components(links).collect())
    assert sorted((r.node, r.component) for r in rows) == [(k, 0) for k in range(201)]
    # 78 as written; 87 where every row that stands for two is made by a union.
    assert stages <= 82


def test_near_duplicates_of_overlapping_groups(spark):
    draw = np.random.default_rng(5)
    texts = []
    for _ in range(12):
        story = [f"w{k}" for k in draw.integers(0, 1 << 40, 60)]
        for k in range(20):
            texts.append(" ".join([*story[:k], f"x{k % 7}", *story[k + 1 :]]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.localCheckpoint()
    rows = near_duplicate_components(docs).collect()
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(label))


def test_two_rows_keeps_types_and_order(spark):
    frame = spark.createDataFrame([(1, b"x", 2, b"y"), (None, None, 3, b"z")], "a int, s binary, b int, t binary")
    made = two_rows(frame, ["n", "v"], ("a", "s"), ("b", "t"))
    assert made.dtypes == [("n", "int"), ("v", "binary")]
    rows = [(r.n, r.v and bytes(r.v)) for r in made.collect()]
    assert rows == [(1, b"x"), (2, b"y"), (None, None), (3, b"z")]


def test_cut_hands_memory_back(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(common, "RELEASE_EVERY", 0.0)
    monkeypatch.setattr(common, "give_back", lambda session: asked.append(session))
    assert common.cut(spark.range(3)).count() == 3
    assert asked == [spark]


def test_memory_is_handed_back_where_the_jvm_can(spark):
    text = spark.sparkContext._jvm.java.lang.System.getProperty
    version = [int(x) for x in text("java.version").split(".")[:3]]
    if text("os.name") != "Linux" or version < [17, 0, 9]:
        pytest.skip("this JVM has no such command")
    assert common.give_back(spark) is True
