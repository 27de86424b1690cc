"""op10: signatures never part lines within two edits, and tell variants apart."""

import random

import numpy as np

from freightmill.llm.line_dedup import CHAR_BITS, CHAR_CLASSES, signatures


def marks_of(lines):
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    return signatures(np.array([len(x) for x in lines]), codes)


def test_signatures_bound_edits():
    draw = random.Random(8)
    alphabet = "abcdefgh iöß漢😀"
    for _ in range(300):
        line = "".join(draw.choices(alphabet, k=draw.randint(20, 60)))
        other = list(line)
        for _ in range(2):
            at, what = draw.randrange(len(other)), draw.choice(alphabet)
            other[at : at + draw.randint(0, 1)] = draw.choice(([], [what]))
        a, _, b = marks_of([line, "between", "".join(other)])
        assert marks_of([line])[0] == a
        assert int(np.bitwise_count((a ^ b) & CHAR_BITS)) <= 4
        assert int(np.bitwise_count((a ^ b) >> CHAR_CLASSES)) <= 8


def test_signatures_tell_variants_apart():
    words = "the quick brown fox jumps over a lazy dog while nine other men of the town look on in awe".split()
    variants = [" ".join(words[:k] + words[k + 1 :]) for k in range(len(words))]
    marks = marks_of(variants)
    passed = pairs = 0
    for i, a in enumerate(variants):
        for j in range(i):
            unlike = marks[i] ^ marks[j]
            if abs(len(a) - len(variants[j])) <= 2:
                pairs += 1
                passed += bool(
                    np.bitwise_count(unlike & CHAR_BITS) <= 4
                    and np.bitwise_count(unlike >> CHAR_CLASSES) <= 8
                )
    assert passed <= 0.35 * pairs
