"""Embedding whitening from an exact, bit-sliced scatter matrix.

Entries become integers. Over a block of rows every dimension is shifted to start at zero and
cut into bit planes, and a plane is packed across the rows into 64-bit words. The product sum of
two dimensions is then the weighted popcount of their planes' ANDs. Blocks add up as whole
numbers of any size, first inside a task and then over all tasks, and the scatter is centred as
integers, so that rounding begins with the covariance handed to the eigenvalue solver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.llm.common import scratch_names
from freightmill.llm.vectors import has_only_numbers, matrix

BLOCK_ROWS = 4096
SCALE, OFFSET = 64, 1_000_000
#: Product sums travel as two numbers, so that a sum over all tasks fits a decimal.
LOW_BITS = 62


def to_integers(values: np.ndarray, scale: int = SCALE, offset: int = OFFSET) -> np.ndarray:
    return np.floor(scale * values).astype(np.int64) + offset


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """(dimensions, bits, words): each bit of each dimension, packed across the rows.

    ``rows`` holds non-negative integers; the last word is filled up with zeros.
    """
    count, width = rows.shape
    bits = max(1, int(rows.max(initial=0)).bit_length())
    cut = (rows.T[:, None, :] >> np.arange(bits)[:, None]) & 1
    packed = np.packbits(cut.astype(np.uint8), axis=2)
    padded = np.zeros((width, bits, -(-count // 64) * 8), np.uint8)
    padded[:, :, : packed.shape[2]] = packed
    return padded.view(np.uint64)


def cross_products(rows: np.ndarray) -> np.ndarray:
    """Exact product sums of all pairs of columns, by weighted AND-popcounts of bit planes."""
    planes = bit_planes(rows)
    width, bits, _ = planes.shape
    flat = planes.reshape(width * bits, -1)
    met = np.zeros((len(flat), len(flat)), np.int64)
    for p in range(len(flat)):
        met[p, p:] = np.bitwise_count(flat[p] & flat[p:]).sum(axis=1, dtype=np.int64)
    met = np.triu(met) + np.triu(met, 1).T
    weight = np.arange(bits)[:, None] + np.arange(bits)
    small = 2 * bits + len(rows).bit_length() < 62
    power = np.array([[1 << int(w) for w in row] for row in weight], np.int64 if small else object)
    met = met.reshape(width, bits, width, bits).transpose(0, 2, 1, 3)
    return (met * power).sum(axis=(2, 3)).astype(object)


class Scatter:
    """Row count, sums and product sums of integer vectors of one length, as Python integers."""

    def __init__(self, width: int):
        self.n = 0
        self.sums = np.zeros(width, object)
        self.products = np.zeros((width, width), object)

    def add(self, rows: np.ndarray) -> None:
        for start in range(0, len(rows), BLOCK_ROWS):
            block = rows[start : start + BLOCK_ROWS]
            low = block.min(axis=0)
            shifted = block - low
            count, low = len(block), low.astype(object)
            if int(shifted.max(initial=0)) < 2**50:
                own = shifted.sum(axis=0).astype(object)
            else:
                own = shifted.astype(object).sum(axis=0)
            across = np.outer(own, low)
            self.n += count
            self.sums += own + count * low
            self.products += (
                cross_products(shifted) + across + across.T + count * np.outer(low, low)
            )


@dataclass(frozen=True)
class Whitening:
    """What whitening needs of the fit list; every array is as large as a vector or its square."""

    scale: int
    offset: int
    n: int
    sums: list[int]
    directions: np.ndarray
    explained: list[float]
    identity_error: float

    @property
    def size(self) -> int:
        return len(self.sums)


def _chosen(vector: str, scale: int) -> Column:
    return has_only_numbers(F.col(f"`{vector}`"), scale) & (F.size(F.col(f"`{vector}`")) > 0)


def _scatter(vectors: DataFrame, vector: str, scale: int, offset: int) -> dict[int, Scatter]:
    """One pass: the scatter of the usable vectors, by their length."""

    def add_up(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        found: dict[int, Scatter] = {}
        for batch in batches:
            column = batch.column(0)
            sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                same = column.filter(pa.array(sizes == size))
                rows = to_integers(matrix(same), scale, offset)
                found.setdefault(size, Scatter(size)).add(rows)
        for size, part in found.items():
            values = [(-1, -1, part.n)]
            values += [(i, -1, int(s)) for i, s in enumerate(part.sums)]
            values += [(i, j, int(part.products[i, j])) for i in range(size) for j in range(i + 1)]
            first, second, total = zip(*values)
            low = [t & ((1 << LOW_BITS) - 1) for t in total]
            high = [t >> LOW_BITS for t in total]
            kind = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * len(values), pa.int32())]
                + [pa.array(c, pa.int32()) for c in (first, second)]
                + [pa.array(list(map(Decimal, c)), kind) for c in (high, low)],
                names=["size", "i", "j", "high", "low"],
            )

    parts = (
        vectors.where(_chosen(vector, scale))
        .select(F.col(f"`{vector}`"))
        .mapInArrow(add_up, "size int, i int, j int, high decimal(38,0), low decimal(38,0)")
    )
    sums = parts.groupBy("size", "i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    totals: dict[int, Scatter] = {}
    # As many rows as a vector's square has, however many vectors there are.
    for size, i, j, high, low in sums.collect():
        total = (int(high) << LOW_BITS) + int(low)
        part = totals.setdefault(size, Scatter(size))
        if i < 0:
            part.n = total
        elif j < 0:
            part.sums[i] = total
        else:
            part.products[i, j] = part.products[j, i] = total
    return totals


def fit_whitening(
    vectors: DataFrame,
    vector: str = "embedding",
    components: int = 32,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> Whitening | None:
    """Principal directions of the fit list: every usable vector of ``vectors``.

    A vector takes no part when it is NULL or empty, holds a NULL, NaN or infinite entry or one
    whose integer is no long, or has another length than most (the larger length of a tie); None
    if none is left. Rows that repeat count as often as they stand there. A direction along
    which the vectors do not differ cannot be whitened and is left out, so fewer than
    ``components`` may come back, none for a single vector. Of the two signs of a direction the
    one that makes its largest entry positive is taken.
    """
    totals = _scatter(vectors, vector, scale, offset)
    if not totals:
        return None
    size = max(totals, key=lambda s: (totals[s].n, s))
    n, sums, products = totals[size].n, totals[size].sums, totals[size].products
    centred = n * products - np.outer(sums, sums)
    # Dividing whole numbers rounds once, however large they are.
    covariance = np.array([[int(c) / (n * n) for c in row] for row in centred], float)
    values, found = np.linalg.eigh(covariance)
    values, found = values[::-1], found[:, ::-1]
    real = values > max(size * np.finfo(float).eps * values[0], 0.0)
    kept = min(components, int(real.sum()))
    values, found = values[:kept], found[:, :kept]
    if kept:
        found = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(kept)])
    directions = found / np.sqrt(values)
    whitened = directions.T @ covariance @ directions
    trace = sum(int(centred[i, i]) for i in range(size)) / (n * n)
    return Whitening(
        scale,
        offset,
        n,
        [int(s) for s in sums],
        directions,
        [float(v) / trace for v in values],
        float(np.abs(whitened - np.eye(kept)).max(initial=0.0)),
    )


def deviations(rows: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows minus the mean as doubles, and the exact sum of squares of n * row - sums."""
    middle = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    near = rows - np.array(middle, np.int64)
    widest = n * (int(np.abs(near).max(initial=0)) + 1)
    kind = np.int64 if len(sums) * widest * widest < 2**63 else object
    gap = n * near.astype(kind) - np.array(rest, kind)
    return near - np.array([r / n for r in rest]), (gap * gap).sum(axis=1)


def whiten(
    vectors: DataFrame,
    model: Whitening | None,
    vector: str = "embedding",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row for each usable vector (columns ``keep``, default all but the vector).

    New columns: ``deviation``, the exact sum over the dimensions of (n * x - S) squared, and
    ``whitened``, an array with the vector's value on each direction. Vectors that take no part
    in a fit get no row, nor does any if there is no model. Columns of the table named like a
    new one are replaced.
    """
    results = {"deviation": T.DecimalType(38, 0), "whitened": T.ArrayType(T.DoubleType())}
    named = keep if keep is not None else [c for c in vectors.columns if c != vector]
    kept = [c for c in named if c not in results]
    (hidden,) = scratch_names(vectors, "vector")
    size = model.size if model else -1
    source = vectors.where(_chosen(vector, model.scale if model else SCALE))
    source = source.where(F.size(F.col(f"`{vector}`")) == size).select(
        F.col(f"`{vector}`").alias(hidden), *[f"`{c}`" for c in kept]
    )
    schema = T.StructType(
        [source.schema[c] for c in kept] + [T.StructField(n, t) for n, t in results.items()]
    )

    def project(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = to_integers(matrix(batch.column(0)), model.scale, model.offset)
            for start in range(0, len(rows), BLOCK_ROWS):
                block = rows[start : start + BLOCK_ROWS]
                centred, squares = deviations(block, model.n, model.sums)
                values = centred @ model.directions
                each = values.shape[1]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(block) + 1) * each, pa.int32()), pa.array(values.ravel())
                )
                exact = pa.array([Decimal(int(s)) for s in squares], pa.decimal128(38, 0))
                others = batch.slice(start, len(block)).columns[1:]
                yield pa.RecordBatch.from_arrays([*others, exact, lists], names=schema.names)

    return source.mapInArrow(project, schema)


def whitened_components(
    vectors: DataFrame,
    vector: str = "embedding",
    id_column: str = "vec_id",
    components: int = 32,
) -> DataFrame:
    """Fit on all usable vectors and whiten them: one row for each vector and component.

    Columns: the id, component (from 1), n, deviation, whitened, explained (the component's
    share of the variance) and identity_error, how far the covariance of the whitened values is
    from the identity at most, taken from the exact scatter. A NULL id stays NULL; see
    ``fit_whitening`` and ``whiten`` for the rest.
    """
    model = fit_whitening(vectors, vector, components)
    rows = whiten(vectors, model, vector, [id_column])
    share = F.array(*[F.lit(e) for e in model.explained]) if model and model.explained else None
    placed = rows.select(
        F.col(f"`{id_column}`"), "deviation", F.posexplode("whitened").alias("place", "value")
    )
    explained = F.lit(None).cast("double") if share is None else F.get(share, F.col("place"))
    return placed.select(
        F.col(f"`{id_column}`"),
        (F.col("place") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        explained.alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
