"""Hard-negative mining: rows of another label that score almost as high as an anchor's positives.

Vectors become integers, so scores are whole numbers and ties are real ties. All rows are
indexed by a multiway hyperplane tree (``split_tree``). Its upper part is fitted on a bounded
sample and deals the rows to regions; the distance ranges of its nodes are then taken from all
rows. An anchor visits only the regions that its score windows can reach. A region is searched
in chunks of a bounded number of rows against blocks of a bounded number of anchors, and every
chunk gets a tree of its own down to leaves that are scored exactly. Nothing is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.llm.common import cut
from freightmill.llm.split_tree import FAR, NOTHING, Search, SplitTree, lift
from freightmill.llm.vectors import has_only_numbers, matrix, usual_size

CHUNK_ROWS = 4096
ANCHOR_BLOCK = 8192
SAMPLE_ROWS = 2048
SAMPLE_BYTES = 16 << 20
MOST_REGIONS = 1024


def _integers(column, scale: int) -> np.ndarray:
    return np.floor(scale * matrix(column)).astype(np.int64)


def _usable(
    vectors: DataFrame, anchor: Column, id_column: str, vector: str, label: str, scale: int
) -> DataFrame:
    """id, label, vector, anchor of the rows that take part, one row for each id."""
    told = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{label}`").alias("label"),
        F.col(f"`{vector}`").alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull())
    told = told.where(has_only_numbers(F.col("vector"), scale))
    size = usual_size(told, "vector")
    # Squared lengths then stay below 2^62, and so does every score.
    limit = 2.0**31 / max(size, 1) ** 0.5
    told = told.where((F.size("vector") == size) & has_only_numbers(F.col("vector"), scale, limit))
    row = F.min(F.struct("label", "vector", "anchor")).alias("row")
    return told.groupBy("id").agg(row).select("id", "row.*")


def _longest(rows: DataFrame, scale: int) -> tuple[int, int]:
    """Number of rows, and the largest squared length of them."""

    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa

        count, most = 0, 0
        for batch in batches:
            x = _integers(batch.column(0), scale)
            count += len(x)
            most = max(most, int(np.einsum("ij,ij->i", x, x).max(initial=0)))
        yield pa.RecordBatch.from_pydict({"n": [count], "longest": [most]})

    parts = rows.select("vector").mapInArrow(measure, "n long, longest long")
    n, longest = parts.agg(F.sum("n"), F.max("longest")).first()
    return n or 0, max(longest or 0, 1)


class Sample:
    """Rows that the upper tree is fitted on; being real rows, they also bound a search."""

    def __init__(self, rows: DataFrame, scale: int, bound: int):
        size = rows.select(F.size("vector")).first()
        bound = max(1, min(bound, SAMPLE_BYTES // (8 * max(size[0], 1)))) if size else 1
        first = rows.orderBy(F.xxhash64("id"), "id").limit(bound).select("id", "label", "vector")
        drawn = sorted(first.collect(), key=lambda r: r["id"])
        self.ids = np.array([r["id"] for r in drawn], np.int64)
        self.labels = np.array([r["label"] for r in drawn])
        wide = len(drawn[0]["vector"]) if drawn else 0
        numbers = np.array([r["vector"] for r in drawn], float).reshape(len(drawn), wide)
        self.rows = np.floor(scale * numbers).astype(np.int64)


def _fit_tree(sample: Sample, longest: int, regions: int) -> SplitTree:
    leaf_rows = max(1, -(-len(sample.ids) // regions))
    degree = max(2, min(16, regions))
    tree, _ = SplitTree.build(lift(sample.rows, longest), longest, leaf_rows, degree)
    tree.forget_ranges()
    return tree


def _with_region(rows: DataFrame) -> T.StructType:
    return T.StructType([*rows.schema.fields, T.StructField("region", T.IntegerType())])


def _place(rows: DataFrame, tree: SplitTree, scale: int) -> DataFrame:
    """Rows with the region they belong to."""

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            points = lift(_integers(batch.column("vector"), scale), tree.longest)
            region = pa.array(tree.place(points).astype(np.int32))
            names = [*batch.schema.names, "region"]
            yield pa.RecordBatch.from_arrays([*batch.columns, region], names=names)

    return rows.mapInArrow(place, _with_region(rows))


def _take_ranges(placed: DataFrame, tree: SplitTree, scale: int) -> None:
    """Give ``tree`` the distance ranges of all rows; a bounded table comes to the driver."""

    def widen(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            tree.place(lift(_integers(batch.column(0), scale), tree.longest))
        out = {"node": [], "i": [], "j": [], "low": [], "high": []}
        for number, node in enumerate(tree.nodes):
            for i, j in np.argwhere(node.low <= node.high).tolist():
                for name, value in zip(out, (number, i, j, node.low[i, j], node.high[i, j])):
                    out[name].append(value)
        yield pa.RecordBatch.from_pydict(
            out,
            pa.schema(
                [(n, pa.int32()) for n in ("node", "i", "j")]
                + [(n, pa.float64()) for n in ("low", "high")]
            ),
        )

    parts = placed.select("vector").mapInArrow(
        widen, "node int, i int, j int, low double, high double"
    )
    for row in parts.groupBy("node", "i", "j").agg(F.min("low"), F.max("high")).collect():
        node = tree.nodes[row[0]]
        node.low[row[1], row[2]], node.high[row[1], row[2]] = row[3], row[4]



def _visits(
    asked: DataFrame, tree: SplitTree, sample: Sample, scale: int, count: int, same_label: bool
) -> DataFrame:
    """A row for each anchor and region that it has to search.

    ``asked`` has id, label, vector, low, high. Rows of the sample raise the least score wanted
    where they fill a window's list by themselves.
    """

    def visit(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = Search(sample.ids, sample.labels, sample.rows, tree.longest)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy()
            labels = np.array(batch.column("label").to_pylist())
            queries = _integers(batch.column("vector"), scale)
            low, high = (
                batch.column(c).flatten().to_numpy().reshape(len(ids), -1) for c in ("low", "high")
            )
            scores, _ = known.best(ids, labels, queries, low, high, count, same_label)
            raised = np.maximum(low, scores[:, :, -1])
            who, region = tree.leaves_of(queries.astype(np.float64), raised, high)
            table = pa.Table.from_batches([batch.drop_columns(["low"])]).take(pa.array(who))
            each = low.shape[1]
            bounds = pa.array(np.arange(len(who) + 1) * each, pa.int32())
            lists = pa.ListArray.from_arrays(bounds, pa.array(raised[who].ravel()))
            table = table.append_column("low", lists)
            table = table.append_column("region", pa.array(region.astype(np.int32)))
            yield from table.select([f.name for f in schema.fields]).to_batches()

    schema = _with_region(asked)
    return asked.mapInArrow(visit, schema)


def _search(
    placed: DataFrame,
    asked: DataFrame,
    tree: SplitTree,
    sample: Sample,
    parts: DataFrame,
    blocks: int,
    scale: int,
    count: int,
    same_label: bool,
) -> DataFrame:
    """(anchor_id, window, score, id): the first ``count`` rows of every chunk for each window."""
    rows = placed.join(parts, "region").select(
        "id",
        "label",
        "vector",
        "region",
        F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    visits = (
        _visits(asked, tree, sample, scale, count, same_label)
        .join(parts, "region")
        .select(
            "id",
            "label",
            "vector",
            "low",
            "high",
            "region",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
            F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
        )
    )
    longest = tree.longest

    def search(there, here):
        import pyarrow as pa

        if not (there.num_rows and here.num_rows):
            return result.empty_table()
        there = there.sort_by("id")
        labels = there.column("label").to_pylist() + here.column("label").to_pylist()
        _, code = np.unique(np.array(labels), return_inverse=True)
        chunk = Search(
            there.column("id").to_numpy(),
            code[: there.num_rows],
            _integers(there.column("vector").combine_chunks(), scale),
            longest,
        )
        ids = here.column("id").to_numpy()
        low, high = (
            here.column(c).combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            for c in ("low", "high")
        )
        queries = _integers(here.column("vector").combine_chunks(), scale)
        scores, found = chunk.best(
            ids, code[there.num_rows :], queries, low, high, count, same_label
        )
        who, window, place = np.nonzero(scores != NOTHING)
        return pa.Table.from_arrays(
            [
                pa.array(ids[who]),
                pa.array(window.astype(np.int32)),
                pa.array(scores[who, window, place]),
                pa.array(found[who, window, place]),
            ],
            schema=result,
        )

    import pyarrow as pa

    result = pa.schema(
        [("anchor_id", pa.int64()), ("window", pa.int32()), ("score", pa.int64()), ("id", pa.int64())]
    )
    keys = ("region", "part", "block")
    both = rows.groupBy(*keys).cogroup(visits.groupBy(*keys))
    found = both.applyInArrow(search, "anchor_id long, window int, score long, id long")
    place = F.row_number().over(
        Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id")
    )
    return found.withColumn("rank", place).where(F.col("rank") <= count)


def mine_hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    scale: int = 256,
    chunk_rows: int = CHUNK_ROWS,
    anchor_block: int = ANCHOR_BLOCK,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """For each anchor and each of its first positives, its first hard negatives. Exact.

    ``anchor`` says which rows are anchors. A component x counts as floor(scale * x), a row's
    score is its inner product with the anchor, higher scores come first and equal ones by id.
    Positives are the first ``positives`` other rows of the anchor's label. A negative has
    another label and a score of ``least_percent`` to ``most_percent`` of the positive's.

    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Rows with a NULL id, label or vector, a NULL, NaN or infinite component, or one so large
    that scores might not be longs, take no part, nor do vectors of another length than most. Of
    rows with the same id only one counts, the smallest by label and vector. Anchors without
    positives, and positives without negatives (all of those with a score below zero), give no
    row. Other columns play no part. ``chunk_rows`` and ``anchor_block`` bound what a task
    holds, ``sample_rows`` the sample that the upper tree is fitted on; none changes the result.
    """
    rows = cut(_usable(vectors, anchor, id_column, vector, label, scale))
    n, longest = _longest(rows, scale)
    sample = Sample(rows, scale, sample_rows)
    tree = _fit_tree(sample, longest, max(1, min(MOST_REGIONS, -(-n // chunk_rows))))
    placed = cut(_place(rows, tree, scale))
    _take_ranges(placed, tree, scale)
    # One row for each region.
    parts = F.broadcast(
        placed.groupBy("region").agg(F.ceil(F.count("*") / chunk_rows).alias("parts"))
    )
    anchors = placed.where("anchor").select("id", "label", "vector")
    blocks = max(1, -(-anchors.count() // anchor_block))
    everything = anchors.select(
        "*",
        F.array(F.lit(-FAR)).cast("array<long>").alias("low"),
        F.array(F.lit(FAR)).cast("array<long>").alias("high"),
    )
    tools = (tree, sample, parts, blocks, scale)
    first = cut(_search(placed, everything, *tools, positives, True))
    # Scores stay below 2^62, so the percentages need more than a long.
    score = F.col("score").cast("decimal(28,0)")
    low = F.ceil(score * least_percent / 100).cast("long")
    high = F.floor(score * most_percent / 100).cast("long")
    # At most ``positives`` entries for each anchor, brought to that number by empty windows.
    listed = first.groupBy(F.col("anchor_id").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high")))).alias(
            "windows"
        )
    )

    def bounds(name: str, empty: int) -> Column:
        filled = F.concat(
            F.col(f"windows.{name}"),
            F.array_repeat(F.lit(empty).cast("long"), positives),
        )
        return F.slice(filled, 1, positives).alias(name)

    windows = anchors.join(listed, "id").select(
        "id", "label", "vector", bounds("low", 1), bounds("high", 0)
    )
    found = _search(placed, windows, *tools, negatives, False)
    positive = first.select(
        "anchor_id",
        (F.col("rank") - 1).alias("window"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    negative = found.select(
        "anchor_id",
        "window",
        "rank",
        F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return negative.join(positive, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
