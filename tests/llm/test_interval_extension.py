"""op7: suffixes that are told apart are not sorted again, and windows end at separators."""

import numpy as np
import pytest

from freightmill.llm import substring_dedup
from freightmill.llm.substring_dedup import equal_windows


def test_only_suffixes_not_told_apart_are_sorted_again(monkeypatch):
    draw = np.random.default_rng(3)
    text = draw.integers(1, 257, 20_000).astype(np.uint16)
    text[15_000:15_300] = text[2_000:2_300]
    sorted_sizes = []

    def counted(values, *settings, **named):
        sorted_sizes.append(len(values))
        return argsort(values, *settings, **named)

    argsort = np.argsort
    monkeypatch.setattr(substring_dedup.np, "argsort", counted)
    kinds = equal_windows(text, 100)
    assert (kinds[15_000:15_201] == kinds[2_000:2_201]).all()
    assert len(set(kinds.tolist())) == len(text) - 201
    assert sum(sorted_sizes) < 1.5 * len(text)


@pytest.mark.parametrize("length", [1, 2, 6, 7, 8, 9, 14, 15, 23])
def test_equal_windows_up_to_separators(length):
    draw = np.random.default_rng(length)
    for _ in range(60):
        sizes = draw.integers(1, 40, 12)
        texts = [draw.integers(1, 3, size) for size in sizes]
        texts += [t.copy() for t in texts[:4]]
        text = np.concatenate([np.append(t, 257) for t in texts]).astype(np.uint16)
        room = np.concatenate([np.arange(len(t), -1, -1) for t in texts]).astype(np.int32)
        kinds = equal_windows(text, length, room)
        known: dict = {}
        for at in np.flatnonzero(room >= length).tolist():
            known.setdefault(text[at : at + length].tobytes(), set()).add(int(kinds[at]))
        assert all(len(found) == 1 for found in known.values())
        whole = {found for kinds_of in known.values() for found in kinds_of}
        assert len(whole) == len(known)
        short = kinds[room < length].tolist()
        assert len(set(short)) == len(short) and not whole & set(short)
