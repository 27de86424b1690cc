"""Exact Jaccard self-join of documents on word shingles, by a grouped prefix join.

1. Shingles are ordered by how common they are (levels of a counting sketch of fixed size over
   all documents, then hash). Two sets that are similar enough share a shingle among the first
   few of each, their prefixes.
2. Documents with the same set are one unit; units with the same size and prefix are one group.
   Only groups are posted under their prefix shingles.
3. Group pairs of a posting list that pass the size and position filters are expanded to units
   (``posting_lists`` says which pairs of a long list need it). Those whose parity bits differ
   in more places than similar sets can are left out, the others verified on the whole sets.
4. Components of the links are the classes of near duplicates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightmill.llm.byte_bpe import arrow_texts
from freightmill.llm.common import cut, scratch_names, small_batches
from freightmill.llm.components import two_rows
from freightmill.llm.posting_lists import (
    bitmap_of,
    emit_counts,
    in_bitmap,
    linked_components,
    summed_counts,
)
from freightmill.llm.shingles import in_chunks

SKETCH_BITS = 22


def _levels(texts: DataFrame, n: int) -> np.ndarray:
    """How common the shingles of each sketch cell are, as a small number for each cell.

    Shingles that occur once fill all cells alike, up to chance; the level says by how many
    times twice that chance's deviation a cell exceeds the mean, on a log scale. The order is
    the same for all documents, and any order gives right results.
    """

    def count(batches: Iterator) -> Iterator:
        cells = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for _, values, _ in in_chunks(*arrow_texts(batch.column(0)), n):
                at = np.sort((values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))[: len(at)]
                cells[at[first]] += np.diff(np.append(first, len(at))).astype(np.uint32)
        yield emit_counts(cells)

    counts = summed_counts(texts.mapInArrow(count, "slot int, counts binary"), 1 << SKETCH_BITS)
    mean = max(float(counts.mean()), 1.0)
    levels = np.empty(len(counts), np.uint8)
    for at in range(0, len(counts), 1 << 18):  # in parts, to keep the driver small
        excess = (counts[at : at + (1 << 18)] - mean) / (2 * np.sqrt(mean))
        level = np.where(excess < 1, 0, 1 + np.floor(np.log2(np.maximum(excess, 1))))
        levels[at : at + (1 << 18)] = level
    return levels


def _set_id(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def parity_bits(values: np.ndarray, row: np.ndarray, size: np.ndarray) -> list[bytes]:
    """For each row w bits, the power of two from its number of hashes on (64 at least): bit b
    says whether an odd number of its hashes, all of them different, are b modulo w."""
    width = np.where(size > 0, 1 << np.ceil(np.log2(np.maximum(size, 64))).astype(np.int64), 0)
    bounds = np.concatenate([[0], np.cumsum(width)])
    low = values & (width[row] - 1).astype(np.uint64)
    odd = np.bincount(bounds[row] + low.astype(np.int64), minlength=bounds[-1]) & 1
    raw = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [raw[a:b] for a, b in zip((bounds[:-1] // 8).tolist(), (bounds[1:] // 8).tolist())]


def least_apart(one: np.ndarray, other: np.ndarray) -> int:
    """Two sets differ in so many hashes at least, by the bytes of their parity bits."""
    while len(one) != len(other):
        if len(one) < len(other):
            one, other = other, one
        half = len(one) // 2
        one = one[:half] ^ one[half:]  # the bits for half the width
    return int(np.bitwise_count(one ^ other).sum())


def _profiles(texts: DataFrame, id_type: str, n: int, percent: int, levels: np.ndarray):
    """doc id, set size, unit (id of the set), grp (id of size and prefix), prefix, parity bits."""

    def describe(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes, units, groups, prefixes = [], [], [], []
            parities = []
            for _, values, bounds in in_chunks(*arrow_texts(batch.column(0)), n):
                size = np.diff(bounds)
                row = np.repeat(np.arange(len(size)), size)
                parities += parity_bits(values, row, size)
                level = levels[(values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.argsort(row * 64 + level, kind="stable")
                keep = size - -(-percent * size // 100) + 1
                rank = np.arange(len(values)) - np.repeat(bounds[:-1], size)
                prefix = values[order][rank < keep[row]].view(np.int64)
                at = np.concatenate([[0], np.cumsum(np.where(size > 0, keep, 0))])
                for k in range(len(size)):
                    if not size[k]:
                        units.append(None)
                        groups.append(None)
                        prefixes.append(None)
                        continue
                    mine = prefix[at[k] : at[k + 1]]
                    raw = hashlib.blake2b(
                        mine.tobytes(), digest_size=8, salt=int(size[k]).to_bytes(8, "little")
                    ).digest()
                    units.append(_set_id(values[bounds[k] : bounds[k + 1]]))
                    groups.append(int.from_bytes(raw, "little", signed=True))
                    prefixes.append(mine)
                sizes += size.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(sizes, pa.int64()), pa.array(units, pa.binary())]
                + [pa.array(groups, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))]
                + [pa.array(parities, pa.binary())],
                names=["id", "n", "unit", "grp", "prefix", "parity"],
            )

    schema = f"id {id_type}, n long, unit binary, grp long, prefix array<long>, parity binary"
    return texts.mapInArrow(describe, schema)


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that sets of these sizes must share."""
    return -(-percent * (a + b) // (100 + percent))


def _passes(n_a, n_b, pos_a, pos_b, percent: int) -> np.ndarray:
    """Size and position filter; a similar pair passes at its first common prefix shingle."""
    sizes = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    reach = 1 + np.minimum(n_a - pos_a - 1, n_b - pos_b - 1)
    return sizes & (reach >= _needed(n_a, n_b, percent))


def may_be_similar(pairs: DataFrame, units: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b: units) without those that cannot be linked by their parity bits, and
    ``one_a``, ``one_b``. ``units``: unit, one, n and parity of its set.

    Sets are linked when at most (100 - percent) / (100 + percent) of the sum of their sizes is
    in one of them only, and each of those hashes turns one bit.
    """

    def choose(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes = batch.column(4).to_numpy()
            good = []
            for k, (x, y) in enumerate(zip(batch.column(5), batch.column(6))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y))
                good.append(least_apart(x, y) * (100 + percent) <= (100 - percent) * sizes[k])
            yield batch.select([0, 1, 2, 3]).filter(pa.array(good, pa.bool_()))

    sides = [
        units.withColumnsRenamed({"unit": e, **{c: f"{c}_{e}" for c in ("one", "n", "parity")}})
        for e in ("a", "b")
    ]
    met = pairs.join(sides[0], "a").join(sides[1], "b").select(
        "a", "b", "one_a", "one_b", (F.col("n_a") + F.col("n_b")).alias("n"), "parity_a", "parity_b"
    )
    id_type = units.schema["one"].dataType.simpleString()
    return met.mapInArrow(choose, f"a binary, b binary, one_a {id_type}, one_b {id_type}")


def _verified(
    pairs: DataFrame, texts: DataFrame, units: DataFrame, n: int, percent: int
) -> DataFrame:
    """Links among ``pairs`` (a, b: units), on the whole sets of both.

    The sets are made again from the texts of one document for each unit that is needed. A
    bitmap of fixed size over id hashes passes by most other documents before they are read
    into words; what passes by accident meets no pair.
    """
    pairs = cut(may_be_similar(pairs, units, percent))
    ends = two_rows(pairs, ["unit", "one"], ("a", "one_a"), ("b", "one_b"))
    wanted = ends.select("unit").distinct()
    bitmap = bitmap_of(ends.select(F.xxhash64("one").alias("h")))

    def collect_sets(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            hit = in_bitmap(bitmap, batch.column(2).to_numpy())
            texts = batch.column(0).filter(pa.array(hit))
            keys, sets = [], []
            for _, values, bounds in in_chunks(*arrow_texts(texts), n):
                for k in range(len(bounds) - 1):
                    mine = values[bounds[k] : bounds[k + 1]]
                    if len(mine):
                        keys.append(_set_id(mine))
                        sets.append(mine.tobytes())
                if sum(map(len, sets)) > 1 << 22:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.binary()), pa.array(sets, pa.binary())],
                        names=["unit", "set"],
                    )
                    keys, sets = [], []
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], names=["unit", "set"]
            )

    sets = (
        texts.select("text", "id", F.xxhash64("id").alias("h"))
        .mapInArrow(collect_sets, "unit binary, set binary")
        .join(wanted, "unit", "left_semi")
        .groupBy("unit")
        .agg(F.first("set").alias("set"))
    )

    def similar(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(both) - common))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = sets.withColumnsRenamed({"unit": "a", "set": "set_a"})
    right = sets.withColumnsRenamed({"unit": "b", "set": "set_b"})
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(similar, "a binary, b binary")


def near_duplicate_components(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    n: int = 5,
    percent: int = 80,
) -> DataFrame:
    """doc id, n_shingles and component_id of every row of ``docs``.

    Two documents link when 100 * |intersection| >= percent * |union| of their sets of n-word
    shingles; a component is what links reach, and is named by its smallest id. Documents
    without words have an empty set and stand alone. Rows with equal texts are one component;
    NULL ids are passed over in naming it unless there is no other. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        F.col(f"`{id_column}`").alias("id"),
    )
    levels = _levels(texts.select("text"), n)
    profiles = cut(_profiles(texts, id_type, n, percent, levels))
    units = profiles.where("n > 0").select("unit", "grp").distinct()
    groups = profiles.where("n > 0").select("grp", "n", "prefix").distinct()
    postings = groups.select("grp", "n", F.posexplode("prefix").alias("pos", "token"))
    postings = postings.select("token", "grp", "n", F.col("pos").cast("long").alias("pos"))
    sets = profiles.where("n > 0").groupBy("unit").agg(
        F.min("id").alias("one"), F.first("n").alias("n"), F.first("parity").alias("parity")
    )
    labels = linked_components(
        postings,
        units,
        lambda n_a, n_b, pos_a, pos_b: _passes(n_a, n_b, pos_a, pos_b, percent),
        f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) AND "
        f"(1 + least(x.n - x.pos - 1, y.n - y.pos - 1)) * {100 + percent} >= {percent} * (x.n + y.n)",
        lambda pairs: _verified(pairs, texts, sets, n, percent),
    )

    by_unit = profiles.groupBy("unit").agg(F.min("id").alias("one"))
    named = by_unit.join(labels, F.col("unit") == F.col("node"))
    smallest = named.groupBy("component").agg(F.min("one").alias("component_id"))
    found = named.join(smallest, "component").select(F.col("unit").alias("linked"), "component_id")
    alone = by_unit.withColumnsRenamed({"unit": "known", "one": "first_id"})
    return (
        profiles.select("id", "n", "unit")
        .join(alone, F.col("unit") == F.col("known"), "left")
        .join(found, F.col("unit") == F.col("linked"), "left")
        .select(
            F.col("id").alias(id_column),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("id"))
            .otherwise(F.coalesce("component_id", "first_id"))
            .alias("component_id"),
        )
    )


def drop_near_duplicates(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", **settings
) -> DataFrame:
    """The rows of each component that have its smallest id; all rows without words stay.

    A row is told by its id alone, so rows that repeat a winning id all stay, with NULL ids too.
    """
    found = near_duplicate_components(docs, text, id_column, **settings)
    (winner,) = scratch_names(docs, "winner")
    winners = found.where(F.col(id_column).eqNullSafe(F.col("component_id"))).select(
        F.col(id_column).alias(winner)
    )
    return docs.join(
        winners.distinct(), F.col(f"`{id_column}`").eqNullSafe(F.col(winner)), "left_semi"
    )
