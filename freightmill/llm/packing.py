"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt evenly over shards of
a bounded number of pieces; each shard keeps, for every residual gap, how many of its open
sequences have it, and places a piece where the sum of the squared counts becomes smallest.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.llm.byte_bpe import arrow_texts, shared_tokenizer
from freightmill.llm.common import cut, small_batches, tokenizer_path

SHARD_PIECES = 40_000


def piece_bounds(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be short of capacity."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


def token_pieces(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    tokenizer: str | None = None,
    capacity: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: doc id, piece, start, length, ids_crc32 (and ids if wanted).

    A document is its ids followed by ``end_id``; a NULL or empty text is ``end_id`` alone.
    """
    path = tokenizer or tokenizer_path()
    fields = [
        T.StructField(id_column, docs.schema[id_column].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)
    end = np.array([end_id], np.int32)

    def whole_rows(bpe, data, bounds):
        """(row, ids) for each row in order; parts of one row are joined, empty rows filled."""
        row, parts = 0, []
        for rows, counts, ids in bpe.encode(data, bounds):
            at = 0
            for number, count in zip(rows.tolist(), counts.tolist()):
                while row < number:
                    yield row, np.concatenate([*parts, end])
                    row, parts = row + 1, []
                parts.append(ids[at : at + count])
                at += count
        while row < len(bounds) - 1:
            yield row, np.concatenate([*parts, end])
            row, parts = row + 1, []

    def tokenise(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = shared_tokenizer(path)
        for batch in batches:
            data, bounds = arrow_texts(batch.column(1))
            columns: list[list] = [[] for _ in range(6)]
            for row, ids in whole_rows(bpe, data, bounds):
                raw = ids.astype("<u4").tobytes()
                for number, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                    values = (row, number, start, length, crc)
                    for column, value in zip(columns, values):
                        column.append(value)
                    if with_ids:
                        columns[5].append(ids[start : start + length])
            out = [batch.column(0).take(pa.array(columns[0], pa.int64()))]
            out.append(pa.array(columns[1], pa.int32()))
            out += [pa.array(c, pa.int64()) for c in columns[2:5]]
            if with_ids:
                out.append(pa.array(columns[5], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    small_batches(docs.sparkSession)
    source = docs.select(f"`{id_column}`", F.col(f"`{text}`").cast("string").alias("_text"))
    return source.mapInArrow(tokenise, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and place of every piece, longest pieces first.

    Only where no open sequence has room is a new one opened. The counts of open sequences per
    gap decide alone; among sequences of equal gap the one that was opened last is taken. Of
    equally good gaps the smallest wins.
    """
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap; gap 0 is never counted
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    used: list[int] = []
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    none = np.iinfo(np.int64).max
    for at in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[at])
        if size >= capacity:
            sequence[at], offset[at] = len(used), 0
            used.append(size)
            continue
        # Change of the sum (halved, without its constant) when a gap shrinks by ``size``.
        after = count[: capacity + 1 - size].copy()
        after[0] = -1  # closing a sequence leaves no gap behind
        change = np.where(count[size:] > 0, after - count[size:], none)
        best = int(change.argmin())
        if change[best] == none:
            gap, number = capacity, len(used)
            used.append(0)
        else:
            gap = best + size
            number = stacks[gap].pop()
            count[gap] -= 1
        sequence[at], offset[at] = number, used[number]
        used[number] += size
        if gap > size:
            stacks[gap - size].append(number)
            count[gap - size] += 1
    return sequence, offset


def pack(
    pieces: DataFrame, capacity: int = 1024, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """``pieces`` (any columns, with a long ``length``) plus sequence_id and offset.

    Every sequence is gapless from 0. The pieces are written once and dealt over shards by
    their place in that copy, so a shard has about ``shard_pieces`` rows whatever values
    repeat, and a lost task packs the same rows again. An empty table gives no rows.
    Columns named sequence_id or offset are replaced.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    stored = cut(pieces.select(*[f"`{c}`" for c in kept]))
    shards = max(1, math.ceil(stored.count() / shard_pieces))
    dealt = stored.withColumn(
        "_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("long")
    )
    schema = T.StructType(
        [stored.schema[c] for c in kept]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def place(table):
        import pyarrow as pa

        lengths = table.column("length").to_numpy().astype(np.int64)
        sequence, offset = sum_of_squares(lengths, capacity)
        first = int(table.column("_shard")[0].as_py()) << 40
        return pa.table(
            [*(table.column(c) for c in kept), pa.array(sequence + first), pa.array(offset)],
            names=schema.names,
        )

    return dealt.groupBy("_shard").applyInArrow(place, schema)


def pack_documents(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    tokenizer: str | None = None,
    capacity: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their sequence and place; see ``token_pieces``, ``pack``."""
    pieces = token_pieces(docs, text, id_column, tokenizer, capacity, end_id, with_ids)
    return pack(pieces, capacity)
