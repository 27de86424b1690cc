"""Word shingles of many texts at once, as 64-bit hashes in numpy arrays.

Words are runs of bytes other than blank and 0x09-0x0D, with A-Z in lower case. A text with
fewer than ``n`` words is one shingle of all its words; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from freightmill.llm.byte_bpe import span_hashes

CHUNK_BYTES = 1 << 20
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0xFF51AFD7ED558CCD)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(33))) * _MIX
    return value ^ (value >> np.uint64(32))


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word."""
    inside = ~_IS_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = True, True
    edge[1:-1] = inside[1:] != inside[:-1]
    edge |= first
    at = np.flatnonzero(edge)
    starts = at[:-1][inside[at[:-1]]] if len(data) else at[:0]
    ends = at[1:][inside[at[:-1]]] if len(data) else at[:0]
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def shingle_sets(data: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, ascending within a row, and each row's bounds."""
    rows = len(bounds) - 1
    starts, ends, row = word_spans(data, bounds)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    hashes = span_hashes(_LOWER[data], starts, ends)
    total = np.zeros(len(hashes), np.uint64)
    words = np.bincount(row, minlength=rows)
    for step in range(min(n, len(hashes))):
        total[: len(hashes) - step] = total[: len(hashes) - step] * _FACTOR + hashes[step:]
    full = np.zeros(len(hashes), bool)
    if len(hashes) >= n:
        full[: len(hashes) - n + 1] = row[n - 1 :] == row[: len(row) - n + 1]
    for short in np.flatnonzero((words > 0) & (words < n)).tolist():
        at = int(np.searchsorted(row, short))
        value = np.uint64(words[short])
        for k in range(int(words[short])):
            value = mix(np.array([value]) * _FACTOR + hashes[at + k : at + k + 1])[0]
        total[at], full[at] = value, True
    values, row = mix(total[full]), row[full]
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[new], row[new]
    return values, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])


def in_chunks(
    data: np.ndarray, bounds: np.ndarray, n: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, bounds) for runs of rows of about CHUNK_BYTES."""
    row, rows = 0, len(bounds) - 1
    while row < rows:
        stop = int(np.searchsorted(bounds, bounds[row] + CHUNK_BYTES, side="right")) - 1
        stop = max(stop, row + 1)
        part = data[bounds[row] : bounds[stop]]
        yield row, *shingle_sets(part, bounds[row : stop + 1] - bounds[row], n)
        row = stop
