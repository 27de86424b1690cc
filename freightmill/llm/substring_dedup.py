"""Removal of byte strings that repeat across or inside documents, on suffix arrays.

Equal strings of ``length`` bytes are brought together by content: every such window names one
of its k-grams, the one with the smallest hash, so equal windows name equal k-grams. Windows
of one document that name the same occurrence form a segment. K-grams that are named once, or
always in equal segments, need no look at their text: of equal segments all but the first go.
The first copies of all other segments are dealt over tasks by k-gram; each task builds a
suffix array and its Burrows-Wheeler order, and extends all intervals backwards by one byte at
a time, breadth first, until they stand for strings of ``length`` bytes.

Segments are told apart by 64-bit hashes under a 64-bit k-gram hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.llm.byte_bpe import arrow_texts, span_hashes
from freightmill.llm.common import cut
from freightmill.llm.posting_lists import bitmap_of, in_bitmap
from freightmill.llm.shingles import mix

GRAM = 40
SHARD_BYTES = 1_500_000
#: Texts are looked at together in runs of about so many bytes.
CHUNK_BYTES = 1 << 18
#: Segments of one k-gram above which its windows are dealt one by one.
HOT_SEGMENTS = 4_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every position on, by doubling."""
    count = len(data) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    parts, have, at = data.astype(np.uint64) + np.uint64(1), 1, 0
    total, left = np.zeros(count, np.uint64), size
    factor = np.array([_FACTOR])  # an array wraps around without a warning
    while left:
        if left & 1:
            total = total * factor + parts[at : at + count]
            at += have
        left >>= 1
        if left:
            parts = parts[:-have] * factor + parts[have:]
            have, factor = have * 2, factor * factor
    return mix(total)


def smallest_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value, the first of equals, of every window of ``width``."""
    best, at, have = values, np.arange(len(values)), 1

    def join(a, pos_a, b, pos_b):
        right = b < a
        return np.where(right, b, a), np.where(right, pos_b, pos_a)

    while have * 2 <= width:
        best, at = join(best[:-have], at[:-have], best[have:], at[have:])
        have *= 2
    rest = width - have
    if rest:
        best, at = join(best[:-rest], at[:-rest], best[rest:], at[rest:])
    return at


def named_grams(
    data: np.ndarray, bounds: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, ...]:
    """(row, hash, first window, last window) for each k-gram that windows of the texts name.

    Text k is data[bounds[k] : bounds[k + 1]], and windows are told by their start in ``data``.
    Windows that name one occurrence follow each other. Texts shorter than ``length`` have none.
    """
    if len(data) < length:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    hashes = gram_hashes(data, gram)
    at = smallest_in_windows(hashes, length - gram + 1)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(at)]
    inside = np.arange(len(at)) + length <= bounds[row + 1]
    other = np.ones(len(at) + 1, bool)  # whether a window does not go on where the last one was
    other[1:-1] = (at[1:] != at[:-1]) | ~inside[:-1] | ~inside[1:]
    first = np.flatnonzero(other[:-1] & inside)
    last = np.flatnonzero(other[1:] & inside)
    return row[first], hashes[at[first]].view(np.int64), first, last


def _suffix_order(text: np.ndarray, depth: int, room: np.ndarray) -> tuple[np.ndarray, ...]:
    """Suffixes of ``text`` (values above 0) in the order of their first ``depth`` values at
    least, and which of them part from the one before within the first ``min(7, depth)``.

    Prefix doubling from those values on. Only suffixes that are not told apart yet are sorted
    again, in their own places; where ``room`` values were compared, the order is left open.
    """
    size, have = len(text), min(7, depth)
    padded = np.concatenate([text, np.zeros(have, text.dtype)]).astype(np.uint64)
    key = np.zeros(size, np.uint64)
    for k in range(have):  # up to seven nine-bit values fill one key
        key = (key << np.uint64(9)) | padded[k : k + size]
    order = np.argsort(key)
    ranked = key[order]
    parts = np.ones(size, bool)
    parts[1:] = ranked[1:] != ranked[:-1]
    rank = np.zeros(size + 1, np.uint64)  # 1 + the first place of equal ones; 0 past the end
    new, at = parts, np.arange(size)
    while True:
        rank[order[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))] + 1
        if have >= depth:
            break
        at = at[~(new & np.append(new[1:], True))]
        at = at[room[order[at]] >= have]
        if not len(at):
            break
        mine = order[at]
        key = (rank[mine] << np.uint64(32)) | rank[mine + have]
        by = np.argsort(key)
        order[at], ranked = mine[by], key[by]
        new = np.ones(len(at), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        have *= 2
    return order, parts


def equal_windows(text: np.ndarray, length: int, room: np.ndarray | None = None) -> np.ndarray:
    """For every position a number that is equal where the next ``length`` values are equal.

    Intervals of suffixes with a common prefix are extended backwards, all at once: the
    suffixes that begin with c followed by W stand together, and two neighbours part where
    their first values differ or where what follows lies in different intervals of W. Only
    intervals with more than one suffix are carried on; at ``length`` the extension stops.
    Positions with fewer than ``length`` values of ``room`` (by default to the end of the
    text) are equal to none. After ``room`` values stands the end or a separator.
    """
    size = len(text)
    room = np.arange(size, 0, -1, np.int32) if room is None else room
    order, parts = _suffix_order(text, length, room)
    inverse = np.zeros(size + 1, np.int64)
    inverse[order] = np.arange(size)
    parts |= room[order] < min(7, length)
    interval = np.cumsum(parts, dtype=np.int32)
    alive = np.flatnonzero(~(parts & np.append(parts[1:], True)))
    follow = inverse[order[alive] + 1]  # where the suffix without its first value is
    left, parted = room[order[alive]], parts[alive]
    for depth in range(min(7, length) + 1, length + 1):
        if not len(alive):
            break
        behind, ends = interval[follow], left < depth
        parted |= ends
        parted[1:] |= (behind[1:] != behind[:-1]) | ends[:-1]
        interval[alive] = np.cumsum(parted, dtype=np.int32)  # told apart from each other only
        alone = parted.copy()
        alone[:-1] &= parted[1:]
        if np.count_nonzero(alone) * 8 > len(alone):  # until then they do no harm
            parts[alive[alone]] = True
            stay = np.flatnonzero(~alone)
            alive, follow, left, parted = alive[stay], follow[stay], left[stay], parted[stay]
    parts[alive] = parted
    return np.cumsum(parts, dtype=np.int32)[inverse[:size]]


def _repeated_masks(segments: list[np.ndarray], rank: np.ndarray, start: np.ndarray, length: int):
    """Bit i of a segment's mask: its i-th window also stands earlier, by (rank, start)."""
    sizes = np.array([len(s) for s in segments])
    text = np.zeros(int(sizes.sum()) + len(sizes), np.uint16)
    at = np.cumsum(sizes + 1) - (sizes + 1)
    for place, segment in zip(at.tolist(), segments):
        text[place : place + len(segment)] = segment
    text[: len(text)] += 1
    text[at + sizes] = 257  # a separator; windows that reach it are not looked at
    room = (np.repeat(at + sizes, sizes + 1) - np.arange(len(text))).astype(np.int32)
    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(sizes)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    kind = equal_windows(text, length, room)[at[owner] + offset]
    again = np.flatnonzero((np.bincount(kind) > 1)[kind])  # windows that stand more than once
    kind, mine, bit = kind[again], owner[again], offset[again]
    order = np.lexsort((start[mine] + bit, rank[mine], kind))
    repeated = np.zeros(len(owner), bool)
    repeated[again[order[1:]]] = kind[order[1:]] == kind[order[:-1]]
    bits = np.where(repeated, np.int64(1) << offset, 0)
    return np.bitwise_or.reduceat(bits, np.cumsum(windows) - windows)


def _anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, seg, doc, place) of every segment; place packs its windows first .. last."""

    def name(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def flush(out: list[list]):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in out], names=["gram", "seg", "doc", "place"]
            )

        for batch in batches:
            data, bounds = arrow_texts(batch.column(0))
            docs = batch.column(1).to_numpy()
            out: list[list] = [[], [], [], []]
            size = low = 0
            while low < len(docs):
                high = int(np.searchsorted(bounds, bounds[low] + CHUNK_BYTES, side="right")) - 1
                high = max(high, low + 1)
                mine, edges = data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
                row, hashes, first, last = named_grams(mine, edges, length, gram)
                out[0].append(hashes)
                out[1].append(span_hashes(mine, first, last + length).view(np.int64))
                out[2].append(docs[low:high][row])
                out[3].append((first - edges[row]) * 64 + (last - first))
                size += len(hashes)
                low = high
                if size > 1 << 18:
                    yield flush(out)
                    out, size = [[], [], [], []], 0
            if size:
                yield flush(out)

    return texts.mapInArrow(name, "gram long, seg long, doc long, place long")


def _named_again(anchors: DataFrame) -> DataFrame:
    """Segments whose k-gram is named at least twice. Reads each run of equal ones in order and
    holds one row of it, so a k-gram of any frequency streams through."""

    def repeats(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, known = np.zeros((0, 4), np.int64), False
        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1)
            if not len(rows):
                continue
            carried = len(held) and held[0, 0] == rows[0, 0]
            if carried:
                rows = np.concatenate([held, rows])
            same = rows[1:, 0] == rows[:-1, 0]
            again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            last_known = bool(len(rows) > 1 and same[-1])
            if carried and known:
                again[0] = False  # passed on before
                last_known |= len(rows) == 1
            out = rows[again]
            if len(out):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(c)) for c in out.T],
                    names=["gram", "seg", "doc", "place"],
                )
            held, known = rows[-1:], last_known

    ordered = anchors.repartition("gram").sortWithinPartitions("gram")
    return ordered.mapInArrow(repeats, "gram long, seg long, doc long, place long")


def _only_marked(texts: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Rows whose doc may be marked, before any shuffle; the join that follows decides."""

    def choose(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bitmap, batch.column(1).to_numpy())))

    return texts.mapInArrow(choose, texts.schema)


def _with_bytes(texts: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """``firsts`` (gram, seg, one) with the bytes of the segments."""
    places = firsts.groupBy(F.col("one.doc").alias("there")).agg(
        F.collect_list(F.struct("gram", "seg", "one.place")).alias("at")
    )
    near = _only_marked(texts, bitmap_of(firsts.select("one.doc")))

    def slices(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            data, bounds = arrow_texts(batch.column(0))
            lists = batch.column(3)
            flat = lists.flatten()
            places = flat.field(2).to_numpy()
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            first, more = places >> 6, places & 63
            low, high = bounds[row] + first, bounds[row] + first + more + length
            raw = data.tobytes()
            for at in range(0, len(row), 50_000):
                part = slice(at, at + 50_000)
                pieces = [raw[a:b] for a, b in zip(low[part].tolist(), high[part].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [flat.field(k).slice(at, len(pieces)) for k in (0, 1)]
                    + [pa.array(pieces, pa.binary())]
                    + [batch.column(k).take(pa.array(row[part])) for k in (2, 1)]
                    + [pa.array(first[part])],
                    names=["gram", "seg", "bytes", "id", "doc", "start"],
                )

    id_type = texts.schema["id"].dataType.simpleString()
    met = near.join(places, F.col("doc") == F.col("there")).select("text", "doc", "id", "at")
    schema = f"gram long, seg long, bytes binary, id {id_type}, doc long, start long"
    # Rows that repeat id and text come with the same segments.
    return met.mapInArrow(slices, schema).dropDuplicates(["gram", "seg"])


def _masks(texts: DataFrame, segs: DataFrame, length: int) -> DataFrame:
    """(gram, seg, mask): which windows of a segment's first copy are repeats, for the segments
    whose k-gram has others."""
    loads = segs.groupBy("gram").count().where("count > 1")
    forked = segs.join(loads, "gram")
    distinct = cut(_with_bytes(texts, forked, length).join(loads, "gram"))
    shards = max(1, -(-distinct.count() * (length + GRAM) // SHARD_BYTES))
    hot = distinct.where(F.col("count") > HOT_SEGMENTS)
    calm = distinct.where(F.col("count") <= HOT_SEGMENTS)

    def find(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        segments = [np.frombuffer(b.as_buffer(), np.uint8) for b in table.column("bytes")]
        ranks = []
        for name in ("id", "doc"):
            column = table.column(name).combine_chunks()
            ranks.append(pc.rank(column, null_placement="at_end", tiebreaker="dense").to_numpy())
        rank = ranks[0].astype(np.int64) << 32 | ranks[1].astype(np.int64)
        start = table.column("start").to_numpy()
        mask = _repeated_masks(segments, rank, start, length)
        return pa.table([table.column("gram"), table.column("seg"), pa.array(mask)], ["gram", "seg", "mask"])

    # A k-gram stays in one shard; shards have about SHARD_BYTES, and so has any k-gram.
    dealt = calm.drop("count").withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
    masks = dealt.groupBy("shard").applyInArrow(find, "gram long, seg long, mask long")
    # Windows of hot k-grams are dealt by their own content and cut down before they move.
    windows = hot.withColumn("i", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)))
    windows = windows.select(
        "gram", "seg", "i",
        F.expr(f"sha2(substring(bytes, i + 1, {length}), 256)").alias("window"),
        F.struct(
            F.col("id").isNull().alias("last"), "id", "doc", (F.col("start") + F.col("i")).alias("start")
        ).alias("at"),
    )
    earliest = windows.groupBy(F.col("window").alias("w")).agg(F.min("at").alias("least"))
    hot_masks = (
        windows.join(earliest, F.col("window") == F.col("w"))
        .groupBy("gram", "seg")
        .agg(F.bit_or(F.expr("if(at <=> least, 0L, shiftleft(1L, i))")).alias("mask"))
    )
    return masks.union(hot_masks)


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    length: int = 100,
    gram: int = GRAM,
    with_text: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256 (kept bytes).

    A byte goes when a string of ``length`` bytes that covers it also starts earlier: in a
    document with a smaller id or, in the same one, further left. Strings are judged on the
    input. NULL texts count as empty; NULL ids come last; of equal ids the text's hash decides;
    rows that repeat id and text are one document and get equal results. Texts shorter than
    ``length`` keep all. ``with_text`` adds the kept bytes. Other columns are not read.

    ``length - gram`` must be below 64: the windows of a segment are bits of one number.
    """
    if not 0 < length - gram < 63:
        raise ValueError("length - gram must be between 1 and 62")
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    identity = F.md5(raw.cast("binary"))
    texts = docs.select(
        raw.alias("text"),
        F.xxhash64(F.col(f"`{id_column}`"), identity).alias("doc"),
        F.col(f"`{id_column}`").alias("id"),
    )
    # Later copies of a whole text repeat it from end to end; only first ones are searched.
    copies = docs.select(
        identity.alias("same"),
        F.struct(
            F.col(f"`{id_column}`").isNull().alias("last"),
            F.col(f"`{id_column}`").alias("id"),
            F.xxhash64(F.col(f"`{id_column}`"), identity).alias("doc"),
        ).alias("who"),
    ).distinct()
    copies = cut(copies)
    leaders = copies.groupBy("same").agg(F.min("who").alias("lead"))
    leading = leaders.select(F.col("lead.doc").alias("doc"), F.col("lead.id").alias("id"))
    again = _named_again(_anchors(texts.select("text", "doc"), length, gram))
    repeated = cut(again.join(leading, "doc"))
    order = F.struct(F.col("id").isNull().alias("last"), "id", "doc", "place")
    segs = cut(repeated.groupBy("gram", "seg").agg(F.min(order).alias("one")))
    masks = segs.join(_masks(texts, segs, length), ["gram", "seg"], "left")

    # All windows of a later copy of a segment go, of its first copy those in the mask.
    every = "shiftleft(1L, int(place & 63) + 1) - 1"
    spans = (
        repeated.join(masks, ["gram", "seg"])
        .select(
            "doc",
            F.expr("shiftright(place, 6)").alias("start"),
            F.expr(
                f"if(doc = one.doc AND place = one.place, coalesce(mask, 0L), {every})"
            ).alias("mask"),
        )
        .where("mask <> 0")
        .groupBy("doc")
        .agg(F.collect_list(F.struct("start", "mask")).alias("gone"))
    )
    followers = copies.join(leaders, "same").where("who.doc <> lead.doc").select(
        F.col("who.doc").alias("follower")
    )
    spans = cut(
        spans.select("doc", "gone", F.lit(False).alias("whole")).union(
            followers.distinct().select(
                "follower", F.lit(None).cast("array<struct<start:bigint,mask:bigint>>"), F.lit(True)
            )
        )
    )
    return _apply(texts, spans, id_column, length, with_text)


def _apply(texts: DataFrame, spans: DataFrame, id_column: str, length: int, with_text: bool):
    """Cut the windows in ``spans`` out of the texts."""
    fields = [
        T.StructField(id_column, texts.schema["id"].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
    if with_text:
        fields.append(T.StructField("kept", T.BinaryType()))
    schema = T.StructType(fields)

    def drop(data: np.ndarray, starts: np.ndarray, masks: np.ndarray) -> tuple[int, int, bytes]:
        bits = np.unpackbits(masks.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        span, bit = np.nonzero(bits)
        begins = np.zeros(len(data), np.int32)
        begins[starts[span] + bit] = 1
        begun = np.cumsum(begins, dtype=np.int32)
        out = begun > 0
        out[length:] = begun[length:] > begun[:-length]
        spans = int(out[0]) + int((out[1:] & ~out[:-1]).sum()) if len(out) else 0
        return int(out.sum()), spans, data[~out].tobytes()

    def change(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            data, bounds = arrow_texts(batch.column(0))
            rows: list[list] = [[] for _ in range(5)]
            whole = batch.column(3).to_pylist()
            gone = batch.column(2)
            sizes = pc.fill_null(pc.list_value_length(gone), 0).to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(sizes)])
            gone = gone.flatten()  # without the lists that are NULL
            starts, masks = (gone.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for k in range(len(whole)):
                mine = data[bounds[k] : bounds[k + 1]]
                if whole[k]:
                    whole_text = len(mine) >= length
                    found = (len(mine), 1, b"") if whole_text else (0, 0, mine.tobytes())
                else:
                    own = slice(at[k], at[k + 1])
                    found = drop(mine, starts[own], masks[own])
                values = (len(mine), *found[:2], hashlib.sha256(found[2]).hexdigest(), found[2])
                for column, value in zip(rows, values):
                    column.append(value)
            out = [batch.column(1)] + [pa.array(c, pa.int64()) for c in rows[:3]]
            out.append(pa.array(rows[3], pa.string()))
            if with_text:
                out.append(pa.array(rows[4], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    # Texts that may lose something go to their spans; the others never leave their task.
    bitmap = bitmap_of(spans.select("doc"))
    near = _only_marked(texts, bitmap)
    met = near.join(spans.withColumnRenamed("doc", "there"), F.col("doc") == F.col("there"))
    changed = met.select("text", "id", "gone", "whole").mapInArrow(change, schema)
    plain = [F.col("doc"), F.col("id").alias(id_column)]
    plain.append(F.octet_length("text").cast("long").alias("n_bytes"))
    plain += [F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans")]
    plain.append(F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    if with_text:
        plain.append(F.col("text").cast("binary").alias("kept"))
    hit = spans.select(F.col("doc").alias("there"))
    untouched = texts.select(*plain).join(hit, F.col("doc") == F.col("there"), "left_anti")
    return changed.union(untouched.drop("doc"))
