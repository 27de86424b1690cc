"""Embedding columns: which of their values can be used, and their rows as numpy matrices."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_only_numbers(vector: Column, scale: float = 1.0, limit: float = 2.0**62) -> Column:
    """A vector without NULL, NaN or infinite entries, all of them below ``limit`` when scaled.

    The limit keeps ``floor(scale * entry)`` a long with room to spare.
    """

    def sound(entry: Column) -> Column:
        return entry.isNotNull() & (F.abs(entry.cast("double")) * scale < limit)

    # NaN is above every number for Spark, so the comparison refuses it too.
    return vector.isNotNull() & F.forall(vector, sound)


def usual_size(vectors: DataFrame, vector: str) -> int:
    """The most frequent vector length, the larger one of a tie; 0 without any vector."""
    sizes = vectors.groupBy(F.size(F.col(f"`{vector}`")).alias("size")).count()
    best = sizes.orderBy(F.desc("count"), F.desc("size")).select("size").first()
    return best[0] if best else 0


def matrix(column) -> np.ndarray:
    """An Arrow list column whose rows all have one length, as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
