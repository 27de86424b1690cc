"""op2: hubs that all near copies link with, and components of odd shapes."""

import random

import numpy as np

from freightmill.llm.components import components
from freightmill.llm.posting_lists import hub_pairs


def test_hub_lacks_least(spark):
    rows = [(5, grp, 100, 3) for grp in range(1, 40)] + [(5, 99, 100, 0)] * 2
    frame = spark.createDataFrame(rows, "token long, grp long, n long, pos long")

    def passes(n_a, n_b, pos_a, pos_b):
        return np.ones(len(n_a), bool)

    found = hub_pairs(frame, passes, 1).collect()
    assert {(r.a, r.b) for r in found if r.kind == 0} == {(k, 99) for k in range(1, 40)}
    # A group that is posted twice has one row.
    assert len([r for r in found if r.kind == 1]) == 40


def test_components_of_odd_shapes(spark):
    draw = random.Random(4)
    path = [(k, k + 1) for k in range(100, 130)]
    star = [(7, k) for k in range(200, 230)]
    stray = [(draw.randrange(300, 340), draw.randrange(300, 340)) for _ in range(30)]
    links = path + star + stray + [(b, a) for a, b in path[:5]] + [(1, 1), (None, 2)]
    label = {k: k for pair in path + star + stray for k in pair}
    for _ in label:
        for a, b in path + star + stray:
            label[a] = label[b] = min(label[a], label[b])
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    linked = {k for a, b in path + star + stray if a != b for k in (a, b)}
    assert len(found) == len(linked)
    assert {r.node: r.component for r in found} == {k: label[k] for k in linked}
