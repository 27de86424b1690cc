"""Links among units that share a posting, without making all pairs of a posting list.

First one group of every list, its hub, meets the others, one unit of a group speaking for it.
The links found give components, and from then on only pairs across components are looked at,
since one more link inside a component changes nothing. So HUBS hubs of every list meet those
others that are still apart from them, by up to HUBS units each; what is left after that, in
longer lists and of larger groups, is compared across components, too. A large group of near
copies thus costs about one comparison for each member, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightmill.llm.common import cut
from freightmill.llm.components import components

HUBS = 64
SLOTS = 64
BITMAP_CELLS = 1 << 23
#: Label of a group whose units are in several components.
MIXED = np.iinfo(np.int64).min
#: (n_a, n_b, pos_a, pos_b) -> which pairs may be linked.
Passes = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def summed_counts(parts: DataFrame, size: int) -> np.ndarray:
    """Add up counter arrays given as (slot int, counts binary); the result has ``size`` cells."""
    width = size // SLOTS

    def add(table):
        import pyarrow as pa

        total = np.zeros(width, np.uint64)
        for raw in table.column("counts"):
            total += np.frombuffer(raw.as_py(), np.uint8)
        raw = np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()
        return pa.table({"slot": table.column("slot")[:1], "counts": pa.array([raw], pa.binary())})

    out = np.zeros(size, np.uint32)
    merged = parts.groupBy("slot").applyInArrow(add, "slot int, counts binary")
    for row in merged.collect():  # SLOTS rows, 4 * size bytes in all
        out[row["slot"] * width : (row["slot"] + 1) * width] = np.frombuffer(row["counts"], np.uint32)
    return out


def emit_counts(counts: np.ndarray):
    """The counters of one task (255 stands for more) as SLOTS rows; empty slots are left out."""
    import pyarrow as pa

    width = len(counts) // SLOTS
    rows = [(k, counts[k * width : (k + 1) * width]) for k in range(SLOTS)]
    rows = [(k, np.minimum(c, 255).astype(np.uint8).tobytes()) for k, c in rows if c.any()]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.binary())],
        names=["slot", "counts"],
    )


def bitmap_of(ids: DataFrame) -> np.ndarray:
    """Which ids (a long column) occur, by their low bits: 1 MB, whatever the input.

    Driver and tasks only ever hold this form; ids that share their low bits are taken in.
    """
    width = BITMAP_CELLS // SLOTS

    def mark(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen = np.zeros(BITMAP_CELLS, bool)
        for batch in batches:
            seen[batch.column(0).to_numpy() & (BITMAP_CELLS - 1)] = True
        rows = [(k, seen[k * width : (k + 1) * width]) for k in range(SLOTS)]
        rows = [(k, np.packbits(c).tobytes()) for k, c in rows if c.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.binary())],
            names=["slot", "bits"],
        )

    def either(table):
        import pyarrow as pa

        total = np.zeros(width // 8, np.uint8)
        for raw in table.column("bits"):
            total |= np.frombuffer(raw.as_py(), np.uint8)
        bits = pa.array([total.tobytes()], pa.binary())
        return pa.table({"slot": table.column("slot")[:1], "bits": bits})

    out = np.zeros(BITMAP_CELLS // 8, np.uint8)
    marks = ids.mapInArrow(mark, "slot int, bits binary")
    for row in marks.groupBy("slot").applyInArrow(either, "slot int, bits binary").collect():
        at = row["slot"] * (width // 8)
        out[at : at + width // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    place = ids & (BITMAP_CELLS - 1)
    return ((bitmap[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1).astype(bool)


def hub_pairs(postings: DataFrame, passes: Passes, hubs: int) -> DataFrame:
    """From (token, grp, n, pos): pairs with the first ``hubs`` groups of each list (kind 0), and
    all rows of the lists that are longer than that covers (kind 1). A list is in the order of
    pos, so that its hub has the least that the others may lack.

    With a column ``label`` as well, groups of the same label do not meet; groups labelled MIXED
    meet all. Only the first hubs + 1 rows of an unfinished list are held from batch to batch.
    """
    labelled = "label" in postings.columns

    def stream(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held = np.zeros((0, 4 + labelled), np.int64)
        for batch in batches:
            rows = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            if len(held) and len(rows) and held[0, 0] == rows[0, 0]:
                rows = np.concatenate([held, rows])
            if not len(rows):
                continue
            # A group may be posted more than once under a token.
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
            rows = rows[new]
            token, group, size, pos, *label = rows.T
            heads = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            length = np.diff(np.append(heads, len(rows)))
            start = np.repeat(heads, length)
            here = np.arange(len(rows))
            left, right = [heads[:0]], [heads[:0]]
            for k in range(hubs):
                at = np.flatnonzero(here > start + k)
                if not len(at):
                    break
                hub = start[at] + k
                good = passes(size[hub], size[at], pos[hub], pos[at]) & (group[hub] != group[at])
                if labelled:
                    good &= (label[0][hub] != label[0][at]) | (label[0][hub] == MIXED)
                left.append(hub[good])
                right.append(at[good])
            a, b = group[np.concatenate(left)], group[np.concatenate(right)]
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            long = np.repeat(length, length) > hubs + 1
            none = np.zeros(len(pairs), np.int64)
            out = [
                np.concatenate([none, np.ones(long.sum(), np.int64)]),
                np.concatenate([pairs[:, 0], token[long]]),
                np.concatenate([pairs[:, 1], group[long]]),
                np.concatenate([none, size[long]]),
                np.concatenate([none, pos[long]]),
            ]
            if len(out[0]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in out], names=["kind", "a", "b", "n", "pos"]
                )
            held = rows[heads[-1] :][: hubs + 1]

    ordered = postings.repartition("token").sortWithinPartitions("token", "pos", "grp")
    columns = ["token", "grp", "n", "pos", *["label"][: int(labelled)]]
    return ordered.select(columns).mapInArrow(
        stream, "kind long, a long, b long, n long, pos long"
    )


def cross_pairs(rows: DataFrame, condition: str) -> DataFrame:
    """Pairs of groups of one long list (token, grp, n, pos, label) with different labels.

    Each row outside a list's most common component meets the rest of the list; rows of that
    component never meet. ``condition`` is the filter of pairs in SQL, on rows x and y.
    """
    share = rows.groupBy("token", "label").count()
    lists = share.groupBy("token").agg(
        F.max_by("label", F.when(F.col("label") == MIXED, -1).otherwise(F.col("count"))).alias("common"),
        F.count("*").alias("labels"),
    )
    lists = lists.where((F.col("labels") > 1) | (F.col("common") == MIXED))
    odd = (F.col("label") != F.col("common")) | (F.col("label") == MIXED)
    marked = rows.join(lists, "token").withColumn("odd", odd)
    met = marked.where("odd").alias("x").join(marked.alias("y"), F.expr("x.token = y.token"))
    return met.where(
        f"x.grp <> y.grp AND (x.label <> y.label OR x.label = {MIXED}) "
        f"AND (NOT y.odd OR x.grp < y.grp) AND {condition}"
    ).selectExpr("least(x.grp, y.grp) AS a", "greatest(x.grp, y.grp) AS b")


def ordered_pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _unit_pairs(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs of units in different components, of pairs of groups (a, b; a group may meet itself).

    The units of a group are dealt into blocks of about HUBS, those of its most common component
    apart from the others. Blocks meet blocks, so no key holds more than a block, and where two
    groups have their most common component in common, those blocks do not meet.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("grp")).distinct()
    share = known.join(wanted, "grp", "left_semi").groupBy("grp", "component").count()
    sizes = share.groupBy("grp").agg(
        F.max_by("component", F.struct("count", "component")).alias("common"),
        F.max("count").alias("same"),
        F.sum("count").alias("all"),
    )
    sizes = cut(
        sizes.select(
            "grp",
            "common",
            F.ceil(F.col("same") / HUBS).alias("same_blocks"),
            F.ceil((F.col("all") - F.col("same")) / HUBS).alias("odd_blocks"),
        )
    )
    # Blocks 0, 1, … hold the most common component, -1, -2, … the others.
    dealt = known.join(sizes, "grp").select(
        "grp",
        "unit",
        "component",
        F.when(
            F.col("component") == F.col("common"), F.expr("pmod(xxhash64(unit), same_blocks)")
        )
        .otherwise(F.expr("-1 - pmod(xxhash64(unit), odd_blocks)"))
        .alias("block"),
    )
    blocks = F.expr("sequence(-odd_blocks, same_blocks - 1)")
    sides = [
        sizes.select(F.col("grp").alias(g), F.col("common").alias(f"common_{g}"), blocks.alias(f"all_{g}"))
        for g in ("a", "b")
    ]
    met = (
        pairs.join(sides[0], "a")
        .join(sides[1], "b")
        .withColumn("block_a", F.explode("all_a"))
        .withColumn("block_b", F.explode("all_b"))
        .where("common_a <> common_b OR block_a < 0 OR block_b < 0")
        .where("a <> b OR block_a <= block_b")
        .select("a", "b", "block_a", "block_b")
    )
    x, y = (
        dealt.select(
            F.col("grp").alias(g), F.col("block").alias(f"block_{g}"),
            F.col("unit").alias(u), F.col("component").alias(f"c{u}"),
        )
        for g, u in (("a", "x"), ("b", "y"))
    )
    found = met.join(x, ["a", "block_a"]).join(y, ["b", "block_b"]).where("cx <> cy AND x <> y")
    return found.select(*ordered_pair("x", "y")).distinct()


def linked_components(
    postings: DataFrame,
    units: DataFrame,
    passes: Passes,
    condition: str,
    verify: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """(node, component) of all units that have a link.

    ``postings``: token, grp, n, pos (longs). ``units``: unit, grp; the units of a group share
    all its postings, and are compared with each other as well. ``passes`` and ``condition``
    are the same filter of pairs, on arrays and in SQL. ``verify`` takes pairs of units (a, b)
    and returns those that are linked.
    """
    listed = cut(hub_pairs(postings, passes, 1).distinct())
    units = cut(_partners(units, listed))

    # One unit speaks for a group; inside a group it meets all its units.
    one = units.groupBy("grp").agg(F.min("unit").alias("one"))
    within = one.join(units, "grp").select(F.col("one").alias("x"), F.col("unit").alias("y"))
    across = (
        listed.where("kind = 0")
        .join(one.withColumnsRenamed({"grp": "a", "one": "x"}), "a")
        .join(one.withColumnsRenamed({"grp": "b", "one": "y"}), "b")
        .select("x", "y")
    )
    first = cut(within.union(across).where("x <> y").select(*ordered_pair("x", "y")).distinct())
    labels = cut(components(verify(first)))

    # More hubs, and more units of a group, across components only.
    known, groups = _labelled(units, labels)
    again = cut(hub_pairs(_list_rows(listed, groups), passes, HUBS).distinct())
    met = cut(listed.where("kind = 0").union(again.where("kind = 0")).select("a", "b").distinct())
    place = F.row_number().over(Window.partitionBy("grp").orderBy("unit"))
    mixed = groups.where("low <> high").select("grp")
    apart = cut(_apart(met, groups).select("a", "b"))
    asked = apart.select(F.explode(F.array("a", "b")).alias("grp")).union(mixed).distinct()
    few = (
        known.join(asked, "grp", "left_semi").withColumn("k", place).where(F.col("k") <= HUBS)
    )
    few = cut(few.select("grp", "unit", "component"))
    sides = [
        few.select(F.col("grp").alias(g), F.col("unit").alias(u), F.col("component").alias(f"c{u}"))
        for g, u in (("a", "x"), ("b", "y"))
    ]
    across = apart.join(sides[0], "a").join(sides[1], "b").where("cx <> cy").select("x", "y")
    speakers = few.join(mixed, "grp", "left_semi").select(
        "grp", F.col("unit").alias("x"), F.col("component").alias("cx")
    )
    within = speakers.join(known, "grp").where("cx <> component").select(
        "x", F.col("unit").alias("y")
    )
    second = within.union(across).select(*ordered_pair("x", "y")).distinct()
    second = cut(second.join(first, ["a", "b"], "left_anti"))
    if not second.isEmpty():
        labels = cut(_joined(labels, verify(second)))
        known, groups = _labelled(units, labels)

    # What long lists and large groups have left.
    long_rows = _list_rows(again, groups)
    wide = _apart(met, groups).where("large_a OR large_b").select("a", "b")
    split = groups.where("low <> high AND large").select(
        F.col("grp").alias("a"), F.col("grp").alias("b")
    )
    rest = cut(cross_pairs(long_rows, condition).union(wide).union(split).distinct())
    if rest.isEmpty():
        return labels
    left = _unit_pairs(rest, known).join(first.union(second), ["a", "b"], "left_anti")
    return _joined(labels, verify(cut(left)))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, component) after more ``links``: a component stands in as a star."""
    stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(stars.union(links))


def _partners(units: DataFrame, listed: DataFrame) -> DataFrame:
    """The units that share their group or a posting with another one; no others can be linked."""
    both = F.when(F.col("kind") == 0, F.array("a", "b")).otherwise(F.array("b"))
    met = listed.select(F.explode(both).alias("grp")).distinct()
    crowded = units.groupBy("grp").count().where("count > 1").select("grp")
    return units.join(met.union(crowded), "grp", "left_semi").select("unit", "grp")


def _labelled(units: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The component of every unit, and for every group the first and last one and its label."""
    known = units.join(labels, F.col("unit") == F.col("node"), "left").select(
        "unit", "grp", F.coalesce("component", "unit").alias("component")
    )
    known = cut(known)
    groups = known.groupBy("grp").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        (F.count("*") > HUBS).alias("large"),
    )
    label = F.when(F.col("low") == F.col("high"), F.xxhash64("low")).otherwise(F.lit(int(MIXED)))
    return known, cut(groups.withColumn("label", label))


def _list_rows(listed: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of long lists (kind 1) with the label of their group."""
    rows = listed.where("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("grp"), "n", "pos")
    return rows.join(groups.select("grp", "label"), "grp")


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs of groups (a, b) that are not wholly in one component, and whether they are large."""
    ends = groups.select("grp", "low", "high", "large")
    sides = [
        ends.withColumnsRenamed({"grp": g, **{c: f"{c}_{g}" for c in ("low", "high", "large")}})
        for g in ("a", "b")
    ]
    return pairs.join(sides[0], "a").join(sides[1], "b").where(
        "NOT (low_a = high_b AND high_a = low_b)"
    )
