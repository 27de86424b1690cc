"""Connected components of a link table, by alternating large-star and small-star rounds.

Where a row stands for two, ``two_rows`` makes both in one pass: a union would run everything
before it twice, and each task and plan node is kept by the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightmill.llm.common import cut


def two_rows(frame: DataFrame, names: list[str], *rows: tuple[Column | str, Column | str]) -> DataFrame:
    """Each row of ``frame`` as several rows with two columns, named ``names``."""
    made = [
        F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(row, names)])
        for row in rows
    ]
    return frame.select(F.inline(F.array(*made)))


def _towards_smallest(pairs: DataFrame) -> DataFrame:
    """Smallest neighbour (or itself) of every node ``u``."""
    return pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = two_rows(edges, ["u", "v"], ("u", "v"), ("v", "u"))
    return (
        both.join(_towards_smallest(both), "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_towards_smallest(down), "u")
    return two_rows(joined, ["u", "v"], ("v", "m"), ("u", "m")).where("u <> v").distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node either hangs on one other or has others hang on it (u on v)."""
    ends = two_rows(edges, ["node", "up"], ("u", F.lit(1)), ("v", F.lit(0)))
    ups = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return ups.where("ups > 1 OR (ups = 1 AND least = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (columns a, b of one orderable type).

    The component is its smallest node. Only links move; nothing is collected but whether all
    components are stars, which ends the rounds.
    Loops and NULL ends are ignored; an empty table gives no rows.
    """
    edges = cut(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    while not _all_stars(edges):
        edges = cut(_small_star(cut(_large_star(edges))))
    return two_rows(edges, ["node", "component"], ("u", "v"), ("v", "v")).distinct()
