"""op10, op2: only units that may be linked go on from the posting lists, and stars stand in for links."""

from freightmill.llm.line_dedup import line_classes
from freightmill.llm.posting_lists import _joined, _partners


def test_units_without_a_partner_go_no_further(spark):
    units = spark.createDataFrame(
        [(1, 11), (2, 12), (3, 13), (4, 14), (5, 15), (6, 15), (7, None)], "unit long, grp long"
    )
    listed = spark.createDataFrame(
        [(0, 11, 12, 0, 0), (1, 99, 13, 5, 0), (1, 14, 13, 5, 0)],
        "kind long, a long, b long, n long, pos long",
    )
    # 14 is a token in ``listed``, not a group; 5 and 6 share their group.
    found = sorted(r.unit for r in _partners(units, listed).collect())
    assert found == [1, 2, 3, 5, 6]


def test_stars_take_more_links(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (5, 4), (4, 4)], "node long, component long")
    links = spark.createDataFrame([(5, 2), (8, 9)], "a long, b long")
    found = {r.node: r.component for r in _joined(labels, links).collect()}
    assert found == {1: 1, 2: 1, 4: 1, 5: 1, 8: 8, 9: 8}


def test_heads_of_lines_with_and_without_links(spark):
    base = "a line of text that many documents have in common"
    docs = spark.createDataFrame(
        [(3, f"{base}\nshort\nno other line is like this one, not by far"), (2, f"x{base}\nshort"),
         (None, f"{base}yz\nshort"), (2, f"x{base}\nshort"), (1, None)],
        "doc_id long, text string",
    )
    rows = {
        (r.doc_id, r.line, r.class_id, r.class_line, r.kept)
        for r in line_classes(docs).collect()
    }
    assert rows == {
        (None, 0, None, 0, True), (None, 1, None, 1, True),
        (2, 0, None, 0, False), (2, 1, None, 1, False),
        (3, 0, None, 0, False), (3, 1, None, 1, False), (3, 2, 3, 2, True),
    }
