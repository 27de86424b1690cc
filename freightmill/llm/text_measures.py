"""Measures of a text's make-up, for many texts at once in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from freightmill.llm.byte_bpe import arrow_texts, span_hashes
from freightmill.llm.shingles import CHUNK_BYTES, word_spans

MEASURES = (
    "log_words",
    "symbols",
    "exclamations",
    "capitals",
    "digits",
    "punctuation",
    "spaces",
    "beyond_ascii",
    "word_again",
    "distinct_words",
    "distinct_pairs",
    "commonest_word",
    "words_ending_odd",
    "words_ending_a_sentence",
    "word_bytes",
    "distinct_lines",
    "line_words",
)

OTHER, LOWER, UPPER, DIGIT, SPACE, STOP, SHOUT, MARK, BEYOND = range(9)
_KIND = np.full(256, OTHER, np.uint8)
_KIND[ord("a") : ord("z") + 1] = LOWER
_KIND[ord("A") : ord("Z") + 1] = UPPER
_KIND[ord("0") : ord("9") + 1] = DIGIT
_KIND[[0x20, *range(0x09, 0x0E)]] = SPACE
_KIND[[ord(c) for c in ".,;:'\"()-"]] = STOP
_KIND[[ord(c) for c in "!?"]] = SHOUT
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = MARK
_KIND[128:] = BEYOND
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _distinct(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """How many values of each row differ, and how often its commonest one stands there."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(first)
    often = np.zeros(rows, np.int64)
    np.maximum.at(often, row[at], np.diff(np.append(at, len(row))))
    return np.bincount(row[at], minlength=rows), often


def _line_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every line that is not empty."""
    feed = data == 0x0A
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    edge[:-1] |= feed
    edge[1:] |= feed
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    kept = ~feed[starts] if len(data) else np.zeros(0, bool)
    starts, ends = starts[kept], ends[kept]
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def measure_texts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, MEASURES); a text without words has zero everywhere, shares are of its bytes."""
    rows = len(bounds) - 1
    out = np.zeros((rows, len(MEASURES)))
    if not len(data):
        return out
    sizes = np.diff(bounds)
    row_of_byte = np.repeat(np.arange(rows), sizes)
    kinds = np.bincount(row_of_byte * 9 + _KIND[data], minlength=rows * 9).reshape(rows, 9)
    starts, ends, row = word_spans(data, bounds)
    hashes = span_hashes(_FOLD[data], starts, ends)
    words = np.bincount(row, minlength=rows)
    some, many = np.maximum(words, 1), np.maximum(sizes, 1)
    distinct, often = _distinct(row, hashes, rows)
    neighbours = row[1:] == row[:-1]
    pair_row = row[1:][neighbours]
    pairs, _ = _distinct(pair_row, (hashes[:-1] * _PAIR + hashes[1:])[neighbours], rows)
    again = np.bincount(pair_row, (hashes[1:] == hashes[:-1])[neighbours], minlength=rows)
    last = _KIND[data[ends - 1]]
    line_start, line_end, line_row = _line_spans(data, bounds)
    lines = np.bincount(line_row, minlength=rows)
    unlike, _ = _distinct(line_row, span_hashes(data, line_start, line_end), rows)
    stops = np.isin(data[ends - 1], [ord(c) for c in ".!?"])
    columns = {
        "log_words": np.log1p(words),
        "symbols": kinds[:, MARK] / many,
        "exclamations": kinds[:, SHOUT] / many,
        "capitals": kinds[:, UPPER] / np.maximum(kinds[:, UPPER] + kinds[:, LOWER], 1),
        "digits": kinds[:, DIGIT] / many,
        "punctuation": kinds[:, STOP] / many,
        "spaces": kinds[:, SPACE] / many,
        "beyond_ascii": kinds[:, BEYOND] / many,
        "word_again": again / some,
        "distinct_words": np.log1p(distinct) / np.maximum(np.log1p(words), 1e-9),
        "distinct_pairs": pairs / np.maximum(words - 1, 1),
        "commonest_word": often / some,
        "words_ending_odd": np.bincount(row, last == MARK, minlength=rows) / some,
        "words_ending_a_sentence": np.bincount(row, stops, minlength=rows) / some,
        "word_bytes": np.log1p(np.bincount(row, ends - starts, minlength=rows) / some),
        "distinct_lines": unlike / np.maximum(lines, 1),
        "line_words": np.log1p(words / np.maximum(lines, 1)),
    }
    for place, name in enumerate(MEASURES):
        out[:, place] = columns[name]
    out[words == 0] = 0.0
    return out


def measured_batches(column) -> Iterator[np.ndarray]:
    """Measures of an Arrow text column, in runs of rows of about CHUNK_BYTES, in order."""
    data, bounds = arrow_texts(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        stop = int(np.searchsorted(bounds, bounds[row] + CHUNK_BYTES, side="right")) - 1
        stop = max(stop, row + 1)
        yield measure_texts(data[bounds[row] : bounds[stop]], bounds[row : stop + 1] - bounds[row])
        row = stop
