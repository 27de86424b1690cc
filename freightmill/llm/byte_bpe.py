"""Byte-level BPE on numpy arrays: whole batches of texts at once, no Python loop per token.

Texts arrive as one UTF-8 byte buffer with row offsets. Pre-tokens are found on byte classes,
equal ones are encoded once, and the encoding itself is rank-synchronous: every sequence of a
ragged batch applies its own lowest-rank pair at the same step, until no pair is left.

Equal pre-tokens are recognised by a 64-bit hash of their bytes and their length.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
# Code points with the Unicode property White_Space (fixed values).
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
# Suffixes that the pre-tokenizer splits off after an apostrophe (fixed values).
CONTRACTIONS = [b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"]
#: A chunk is held many times over while its words are found and merged.
CHUNK_BYTES = 1 << 20
CACHE_WORDS = 400_000

_HASH_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)),
        np.uint8,
        0x110000,
    )
    table[WHITE_SPACE] = SPACE
    return table


def byte_classes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each byte (that of its character), and whether a character starts there."""
    table = _classes()
    lead = (data & 0xC0) != 0x80
    kind = table[:256][data]
    wide = np.flatnonzero(lead & (data >= 0x80))
    if len(wide):
        first = data[wide].astype(np.int64)
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        code = first & np.array([0x1F, 0x0F, 0x07])[size - 2]
        last = len(data) - 1
        for step in (1, 2, 3):
            more = size > step
            at = np.minimum(wide + step, last)
            code = np.where(more, (code << 6) | (data[at] & 0x3F), code)
        found = table[np.minimum(code, 0x10FFFF)]
        kind[wide] = found
        for step in (1, 2, 3):
            more = size > step
            kind[np.minimum(wide[more] + step, last)] = found[more]
    return kind, lead


def pretoken_starts(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Byte positions where pre-tokens start. ``rows``: starts of the non-empty texts."""
    size = len(data)
    kind, lead = byte_classes(data)
    row_start = np.zeros(size + 1, bool)
    row_start[rows] = True
    row_start[size] = True
    starts = np.zeros(size, bool)
    starts[1:] = lead[1:] & (kind[1:] != kind[:-1])
    starts[rows] = True
    # A run that is not white space takes one preceding blank with it; of other white
    # space before it, the last character stands alone.
    run = np.flatnonzero(starts & (kind != SPACE))
    run = run[~row_start[run]]
    after_space = run[kind[run - 1] == SPACE]
    before = after_space - 1
    blank = data[before] == 0x20
    starts[after_space[blank]] = False
    for _ in range(3):
        inside = ~lead[before]
        if not inside.any():
            break
        before = before - inside
    starts[before] = True
    # Contractions, where the apostrophe itself starts a pre-token.
    quote = np.flatnonzero(starts & (data == 0x27))
    for suffix in CONTRACTIONS:
        at = quote[quote + len(suffix) < size]
        for k, char in enumerate(suffix, 1):
            at = at[(data[at + k] == char) & ~row_start[at + k]]
        starts[at + 1] = False
        end = at + 1 + len(suffix)
        starts[end[end < size]] = True
    return np.flatnonzero(starts)


_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _powers(size: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``size`` of each."""
    if len(_POWERS[0]) < size:
        inverse = np.uint64(pow(int(_HASH_BASE), -1, 1 << 64))
        for k, base in enumerate((_HASH_BASE, inverse)):
            factors = np.full(size + size // 8, base, np.uint64)
            factors[0] = 1
            _POWERS[k] = np.cumprod(factors)
    return _POWERS


def running_hash(data: np.ndarray) -> np.ndarray:
    """The running polynomial from which ``span_hashes`` takes its spans."""
    power, _ = _powers(max(1 << 16, len(data) + 1))
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=running[1:])
    return running


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, running: np.ndarray | None = None
) -> np.ndarray:
    """64-bit hash of each span of bytes, from one running polynomial (made here if not given)."""
    _, inverse = _powers(max(1 << 16, len(data) + 1))
    if running is None:
        running = running_hash(data)
    value = (running[ends] - running[starts]) * inverse[starts]
    value ^= (ends - starts).astype(np.uint64) * _MIX
    value = (value ^ (value >> np.uint64(31))) * _MIX
    return value ^ (value >> np.uint64(29))


class ByteBpe:
    """Vocabulary and merges of one tokenizer file, and the words seen so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        alphabet = self._alphabet()
        self.byte_ids = np.array([vocabulary[c] for c in alphabet], np.int32)
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int32)
        self.specials = [(t["content"].encode(), t["id"]) for t in spec["added_tokens"]]
        self._index(left, right)
        self._forget()

    @staticmethod
    def _alphabet() -> list[str]:
        """The printable character that stands for each byte."""
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        letters = {b: chr(b) for b in shown}
        hidden = [b for b in range(256) if b not in letters]
        letters |= {b: chr(256 + k) for k, b in enumerate(hidden)}
        return [letters[b] for b in range(256)]

    def _index(self, left: np.ndarray, right: np.ndarray) -> None:
        """Open-addressed table of pair -> rank."""
        self.bits = 20
        keys = (left << 32) | right
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.zeros(1 << self.bits, np.int32)
        todo, slot, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(todo):
            self.probes += 1
            place = slot[todo]
            free = self.keys[place] == -1
            self.keys[place[free]] = keys[todo[free]]
            self.ranks[place[free]] = todo[free]
            todo = todo[self.keys[place] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _HASH_BASE) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of merges where there is none."""
        keys = (left.astype(np.int64) << 32) | right
        none = len(self.merged)
        slot = self._slot(keys)
        rank = np.where(self.keys[slot] == keys, self.ranks[slot], none).astype(np.int32)
        for _ in range(1, self.probes):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            rank = np.where(self.keys[slot] == keys, self.ranks[slot], rank)
        return rank

    def merge(self, symbols: np.ndarray, owner: np.ndarray, words: int) -> tuple:
        """Symbols left of each word, all words in step. ``owner``: the word of each symbol.

        Each round finds the lowest rank of every word and joins all its occurrences there,
        from the left and without overlap. Words without a pair leave the batch.
        """
        none = len(self.merged)
        done_symbols, done_owner = [], []
        rank = np.full(len(symbols), none, np.int32)
        if len(symbols) > 1:
            rank[:-1] = self._rank(symbols[:-1], symbols[1:])
            rank[:-1][owner[:-1] != owner[1:]] = none
        while len(symbols):
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(rank, heads)
            size = np.diff(np.append(heads, len(symbols)))
            per = np.repeat(lowest, size)
            over = per == none
            if over.any():
                done_symbols.append(symbols[over])
                done_owner.append(owner[over])
                keep = ~over
                symbols, owner, rank, per = symbols[keep], owner[keep], rank[keep], per[keep]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == per)
            # Of adjacent hits, which overlap, every second one counts.
            fresh = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
            symbols[hit] = self.merged[rank[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            changed = np.zeros(len(symbols), bool)
            changed[place[hit]] = True
            changed[:-1] |= changed[1:]
            touched = np.flatnonzero(changed)
            inner = touched[touched + 1 < len(symbols)]
            rank[touched] = none
            same = inner[owner[inner] == owner[inner + 1]]
            rank[same] = self._rank(symbols[same], symbols[same + 1])
        if not done_symbols:
            return np.zeros(0, np.int32), np.zeros(words + 1, np.int64)
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=words))])

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes of the words, in order
        self.numbers = np.zeros(0, np.int32)  # their places in ``offsets``
        self.ids = np.zeros(0, np.int32)
        self.offsets = np.zeros(1, np.int64)

    def _trim(self) -> None:
        """Drop what came after the cache was full; the words met first are the common ones."""
        if len(self.known) > CACHE_WORDS:
            keep = self.numbers < CACHE_WORDS
            self.known, self.numbers = self.known[keep], self.numbers[keep]
            self.offsets = self.offsets[: CACHE_WORDS + 1].copy()
            self.ids = self.ids[: self.offsets[-1]].copy()

    def _learn(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Encode the words that are new (``hashes`` in order) and remember them."""
        sizes = ends - starts
        owner = np.repeat(np.arange(len(starts)), sizes)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        symbols = self.byte_ids[data[np.repeat(starts, sizes) + inside]]
        ids, offsets = self.merge(symbols, owner, len(starts))
        place = np.searchsorted(self.known, hashes)
        fresh = len(self.known) + np.arange(len(hashes), dtype=np.int32)
        self.known = np.insert(self.known, place, hashes)
        self.numbers = np.insert(self.numbers, place, fresh)
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
        self.ids = np.concatenate([self.ids, ids])

    def words(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start of every pre-token and its number in ``ids`` / ``offsets``."""
        starts = pretoken_starts(data, rows)
        ends = np.append(starts[1:], len(data))
        hashes = span_hashes(data, starts, ends)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        self._trim()
        number = np.full(len(distinct), -1)
        if len(self.known):
            place = np.minimum(np.searchsorted(self.known, distinct), len(self.known) - 1)
            found = self.known[place] == distinct
            number[found] = self.numbers[place[found]]
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = len(self.known) + np.arange(len(new))
            self._learn(data, distinct[new], starts[first[new]], ends[first[new]])
        return starts, number[back]

    def _pieces(self, raw: bytes):
        """Parts of a text that hold a special string: (bytes, id or None) in order."""
        at = 0
        while at < len(raw):
            places = [(p, text, i) for text, i in self.specials if (p := raw.find(text, at)) >= 0]
            if not places:
                yield raw[at:], None
                return
            place, text, number = min(places, key=lambda x: (x[0], -len(x[1])))
            if place > at:
                yield raw[at:place], None
            yield text, number
            at = place + len(text)

    def _encoded(self, data: np.ndarray, bounds: np.ndarray, want_ids: bool):
        """Token count of each row of ``data`` and, if wanted, all ids in order."""
        rows = bounds[:-1][np.diff(bounds) > 0]
        starts, number = self.words(data, rows)
        sizes = (self.offsets[1:] - self.offsets[:-1])[number]
        before = np.concatenate([[0], np.cumsum(sizes)])
        counts = np.diff(before[np.searchsorted(starts, bounds)])
        if not want_ids:
            return counts, None
        at = np.repeat(self.offsets[:-1][number] - before[:-1], sizes) + np.arange(before[-1])
        return counts, self.ids[at]

    def encode(self, data: np.ndarray, bounds: np.ndarray, want_ids: bool = True):
        """Yield (row numbers, token counts, ids) for runs of rows; a row may come in parts.

        ``data``: the UTF-8 bytes of all rows; ``bounds``: where each row starts, and the end.
        Rows with a special string, and very long rows, are cut where no pre-token can cross.
        """
        special = self._rows_with_special(data, bounds)
        row, count = 0, len(bounds) - 1
        while row < count:
            if special[row] or bounds[row + 1] - bounds[row] > CHUNK_BYTES:
                raw = data[bounds[row] : bounds[row + 1]].tobytes()
                for part, number in self._pieces(raw):
                    if number is not None:
                        yield np.array([row]), np.array([1]), np.array([number], np.int32)
                        continue
                    for piece in self._cut(np.frombuffer(part, np.uint8)):
                        counts, ids = self._encoded(piece, np.array([0, len(piece)]), want_ids)
                        yield np.array([row]), counts, ids
                row += 1
                continue
            stop = int(np.searchsorted(bounds, bounds[row] + CHUNK_BYTES, side="right")) - 1
            stop = max(stop, row + 1)
            cut = np.flatnonzero(special[row:stop])
            stop = row + int(cut[0]) if len(cut) else stop
            part = data[bounds[row] : bounds[stop]]
            if len(part):
                counts, ids = self._encoded(part, bounds[row : stop + 1] - bounds[row], want_ids)
                yield np.arange(row, stop), counts, ids
            row = stop

    def _rows_with_special(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        found = np.zeros(len(bounds) - 1, bool)
        raw = data.tobytes()
        for text, _ in self.specials:
            at = raw.find(text)
            while at >= 0:
                row = int(np.searchsorted(bounds, at, side="right")) - 1
                if at + len(text) <= bounds[row + 1]:
                    found[row] = True
                at = raw.find(text, at + 1)
        return found

    @staticmethod
    def _cut(data: np.ndarray):
        """Parts of about CHUNK_BYTES, cut only between a visible ASCII byte and a blank."""
        at = 0
        while len(data) - at > CHUNK_BYTES:
            tail = data[at + CHUNK_BYTES - 1 :]
            good = np.flatnonzero((tail[1:] == 0x20) & (tail[:-1] > 0x20) & (tail[:-1] < 0x7F))
            if not len(good):
                break
            end = at + CHUNK_BYTES + int(good[0])
            yield data[at:end]
            at = end
        if at < len(data):
            yield data[at:]


@lru_cache(maxsize=2)
def shared_tokenizer(path: str) -> ByteBpe:
    """One tokenizer per Python worker."""
    return ByteBpe(path)


def arrow_texts(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row bounds of an Arrow string column; NULL counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]
