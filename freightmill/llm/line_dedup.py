"""Line dedup by a segment-partition edit join.

Every distinct line is cut into one segment more than the edits allowed, so two lines within
that distance share a segment, at places that their lengths narrow down. A line posts its own
segments and probes for those of lines that are up to ``edits`` shorter; what meets is verified
by a banded bit-parallel edit distance. Classes are what such links reach; the first line of a
class stays.

Posting lists are worked off by ``posting_lists``, without making all pairs of a long one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightmill.llm.byte_bpe import running_hash, span_hashes
from freightmill.llm.common import cut, scratch_names
from freightmill.llm.posting_lists import bitmap_of, in_bitmap, linked_components
from freightmill.llm.shingles import mix

CHUNK_CHARS = 1 << 20
TRIM = " \t\r\x0b\x0c"
#: Classes of characters, and of two neighbours, in a line's signature: 62 bits.
CHAR_CLASSES, PAIR_CLASSES = 23, 39
CHAR_BITS = (1 << CHAR_CLASSES) - 1


def within_edits(a: str, b: str, edits: int) -> bool:
    """Whether the Levenshtein distance of two texts is at most ``edits``.

    One word of 2 * edits + 1 bits for each number of edits holds which diagonals of the band
    are reached after a prefix of ``a``; a step moves all of them at once.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    if a == b:
        return True
    # Common ends cost nothing.
    low, high = 0, min(len(a), len(b))
    while low < high:  # longest common prefix by halving
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[len(a) - middle :] == b[len(b) - middle :]:
            low = middle
        else:
            high = middle - 1
    a, b = a[: len(a) - low], b[: len(b) - low]
    width = 2 * edits + 1
    full = (1 << width) - 1
    # Bit d stands for the place j + d - edits in b after j characters of a.
    reached = [((1 << (edits + e + 1)) - (1 << edits)) & full for e in range(edits + 1)]
    size = len(b)
    for j, char in enumerate(a):
        match = 0
        for d in range(max(0, edits - j), min(width, size - j + edits)):
            if b[j + d - edits] == char:
                match |= 1 << d
        new = [reached[0] & match]
        for e in range(1, edits + 1):
            below = reached[e - 1]
            # Match, substitution, deletion from a; then insertions from b.
            state = (reached[e] & match) | below | (below >> 1)
            new.append((state | (new[e - 1] << 1)) & full)
        reached = new
        if not any(reached):
            return False
    end = size - len(a) + edits
    return any((r >> end) & 1 for r in reached)


def _line_id(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def _short(line_id: bytes) -> int:
    return int.from_bytes(line_id[:8], "little", signed=True)


def segment_bounds(length: np.ndarray, parts: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of one of ``parts`` even segments; the later ones take what is left."""
    base, extra = length // parts, length % parts
    small = parts - extra  # segments of the smaller size come first
    start = number * base + np.maximum(number - small, 0)
    return start, base + (number >= small)


def line_keys(lengths: np.ndarray, starts: np.ndarray, codes: np.ndarray, edits: int):
    """(line, key) of all segments posted and all substrings probed.

    ``codes``: the code points of all lines; a line is codes[start : start + length].
    """
    parts = edits + 1
    owners, keys = [], []
    running = running_hash(codes)

    def add(lines, begin, size, target, number):
        good = (size > 0) & (begin >= 0) & (begin + size <= lengths[lines])
        lines, begin, size, target = (x[good] for x in (lines, begin, size, target))
        at = starts[lines] + begin
        salt = (target * parts + number).astype(np.uint64)
        value = span_hashes(codes, at, at + size, running) ^ mix(salt + np.uint64(1))
        owners.append(lines)
        keys.append(mix(value).view(np.int64))

    lines = np.arange(len(lengths))
    for number in range(parts):
        start, size = segment_bounds(lengths, parts, number)
        add(lines, start, size, lengths, number)
        for less in range(edits + 1):
            target = lengths - less
            start, size = segment_bounds(target, parts, number)
            # An edit script leaves segment ``number`` at a shift of at most ``number`` from
            # the left, and likewise from the right.
            low = np.maximum(start - number, start + less - (edits - number))
            high = np.minimum(start + number, start + less + (edits - number))
            for shift in range(int((high - low).max(initial=-1)) + 1):
                begin = low + shift
                # A line's own segments are posted already.
                wanted = (begin <= high) & (target > 0) & ~((less == 0) & (begin == start))
                chosen = lines[wanted]
                add(chosen, begin[wanted], size[wanted], target[wanted], number)
    return np.concatenate(owners), np.concatenate(keys)


def signatures(lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """One bit for each class of characters, and of two neighbours: whether their number is odd.

    An edit changes two of the characters' counts at most, and four of the neighbours', so lines
    within e edits differ in 2 * e of the low CHAR_CLASSES bits and 4 * e of the others at most.
    No line may be empty.
    """
    starts = np.cumsum(lengths) - lengths
    codes = codes.astype(np.int64)
    bits = np.int64(1) << (codes % CHAR_CLASSES)
    both = ((codes[:-1] * 65599 + codes[1:]) * 0x9E3779B1 & 0xFFFFFFFF) >> 7
    neighbours = np.int64(1) << (CHAR_CLASSES + both % PAIR_CLASSES)
    neighbours[starts[1:] - 1] = 0  # the last character of a line and the first of the next
    bits[:-1] ^= neighbours
    return np.bitwise_xor.reduceat(bits, starts) if len(starts) else bits


def _split(texts: list[str | None]) -> Iterator[tuple[int, int, str]]:
    """(row, line number, trimmed line) of all lines with visible text."""
    for row, text in enumerate(texts):
        for number, line in enumerate((text or "").split("\n")):
            line = line.strip(TRIM)
            if line:
                yield row, number, line


def _occurrences(texts: DataFrame) -> DataFrame:
    """id, line, unit (id of the line's text), grp (a short form of it), n (code points)."""

    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = list(_split(batch.column(0).to_pylist()))
            units = [_line_id(line.encode()) for _, _, line in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array([r for r, _, _ in found], pa.int64()))]
                + [pa.array([k for _, k, _ in found], pa.int64()), pa.array(units, pa.binary())]
                + [pa.array([_short(u) for u in units], pa.int64())]
                + [pa.array([len(line) for _, _, line in found], pa.int64())],
                names=["id", "line", "unit", "grp", "n"],
            )

    id_type = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(find, f"id {id_type}, line long, unit binary, grp long, n long")


def _postings(texts: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """token, grp, n, pos (the line's signature): a row for each key of each distinct line."""

    def post(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows(lines: list[str]):
            groups = np.array([_short(_line_id(x.encode())) for x in lines], np.int64)
            lengths = np.array([len(x) for x in lines], np.int64)
            codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
            owner, key = line_keys(lengths, np.cumsum(lengths) - lengths, codes, edits)
            marks = signatures(lengths, codes)
            for lo in range(0, len(owner), 1 << 18):
                part = owner[lo : lo + (1 << 18)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[lo : lo + (1 << 18)]), pa.array(groups[part])]
                    + [pa.array(lengths[part]), pa.array(marks[part])],
                    names=["token", "grp", "n", "pos"],
                )

        for batch in batches:
            seen: set[str] = set()
            lines: list[str] = []
            size = 0
            for _, _, line in _split(batch.column(0).to_pylist()):
                if len(line) < min_chars or line in seen:
                    continue
                seen.add(line)
                lines.append(line)
                size += len(line)
                if size > CHUNK_CHARS:
                    yield from rows(lines)
                    lines, size = [], 0
            if lines:
                yield from rows(lines)

    return texts.select("text").mapInArrow(post, "token long, grp long, n long, pos long")


def _verified(pairs: DataFrame, texts: DataFrame, units: DataFrame, edits: int) -> DataFrame:
    """Links among ``pairs`` (a, b: units), on the lines themselves, found again in the texts.

    A bitmap of fixed size over the places of the units' first lines passes by nearly all other
    lines; what passes by accident meets no pair.
    """
    wanted = pairs.select(F.col("a").alias("unit")).union(pairs.select("b")).distinct()
    places = F.xxhash64("one.id").bitwiseXOR(F.col("one.line"))
    bitmap = bitmap_of(wanted.join(units, "unit").select(places.alias("place")))

    def fetch(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [(text or "").split("\n") for text in batch.column(0).to_pylist()]
            sizes = np.array([len(lines) for lines in texts], np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            number = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            near = in_bitmap(bitmap, batch.column(1).to_numpy()[row] ^ number)
            lines = [texts[r][k].strip(TRIM) for r, k in zip(row[near].tolist(), number[near].tolist())]
            found = {_line_id(line.encode()): line for line in lines}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.string())],
                names=["unit", "content"],
            )

    def close(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            good = [within_edits(x, y, edits) for x, y in both]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    lines = (
        texts.select("text", F.xxhash64("id").alias("h"))
        .mapInArrow(fetch, "unit binary, content string")
        .join(wanted, "unit", "left_semi")
        .groupBy("unit")
        .agg(F.first("content").alias("content"))
    )
    left = lines.withColumnsRenamed({"unit": "a", "content": "text_a"})
    right = lines.withColumnsRenamed({"unit": "b", "content": "text_b"})
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(close, "a binary, b binary")


def line_classes(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    edits: int = 2,
    min_chars: int = 20,
) -> DataFrame:
    """One row for each visible line: id, line (from 0), class_id, class_line, kept.

    Lines are trimmed of blanks and ASCII control spaces; lines without text have no row. Equal
    lines are of one class, and lines of at least ``min_chars`` code points within ``edits``
    insertions, deletions or substitutions of each other, and what such links reach. A class is
    named by its first line, by id (NULL first) and number, and that line is kept. Rows that
    repeat an id and text repeat their lines' rows. NULL and empty texts have no line.
    """
    texts = docs.select(
        F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{id_column}`").alias("id")
    )
    lines = cut(_occurrences(texts))
    first = F.min(F.struct("id", "line")).alias("one")
    distinct = cut(lines.groupBy("unit", "grp", "n").agg(first))
    units = distinct.where(F.col("n") >= min_chars)

    def passes(n_a, n_b, mark_a, mark_b):
        unlike = mark_a ^ mark_b
        chars = np.bitwise_count(unlike & CHAR_BITS) <= 2 * edits
        return (
            (np.abs(n_a - n_b) <= edits)
            & chars
            & (np.bitwise_count(unlike >> CHAR_CLASSES) <= 4 * edits)
        )

    labels = linked_components(
        _postings(texts, edits, min_chars),
        units.select("unit", "grp"),
        passes,
        f"abs(x.n - y.n) <= {edits} AND bit_count((x.pos ^ y.pos) & {CHAR_BITS}) <= {2 * edits} "
        f"AND bit_count(shiftright(x.pos ^ y.pos, {CHAR_CLASSES})) <= {4 * edits}",
        lambda pairs: _verified(pairs, texts, units, edits),
    )
    # A line without links is the head of its own class.
    named = cut(
        distinct.join(labels, F.col("unit") == F.col("node")).select("unit", "component", "one")
    )
    heads = named.groupBy("component").agg(F.min("one").alias("head"))
    heads = named.join(heads, "component").select(F.col("unit").alias("node"), "head")
    heads = distinct.join(heads, F.col("unit") == F.col("node"), "left").select(
        F.col("unit").alias("u"), F.coalesce("head", "one").alias("head")
    )
    kept = F.col("id").eqNullSafe(F.col("head.id")) & (F.col("line") == F.col("head.line"))
    return lines.join(heads, F.col("unit") == F.col("u")).select(
        F.col("id").alias(id_column),
        "line",
        F.col("head.id").alias("class_id"),
        F.col("head.line").alias("class_line"),
        kept.alias("kept"),
    )


def drop_repeated_lines(
    docs: DataFrame, classes: DataFrame, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """``docs`` without the lines that ``classes`` does not keep; empty lines stay."""
    lost, there = scratch_names(docs, "lost", "there")
    gone = (
        classes.where(~F.col("kept"))
        .groupBy(F.col(id_column).alias(there))
        .agg(F.collect_set("line").alias(lost))
    )
    joined = docs.join(gone, F.col(f"`{id_column}`").eqNullSafe(F.col(there)), "left")
    lines = F.transform(
        F.split(F.col(f"`{text}`"), "\n"),
        lambda x, i: F.struct(x.alias("x"), i.cast("long").alias("i")),
    )
    stay = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(lost, x["i"]), F.lit(False)))
    cleaned = F.array_join(F.transform(stay, lambda x: x["x"]), "\n")
    return joined.select(
        *[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    )
