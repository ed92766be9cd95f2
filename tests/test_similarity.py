"""LCS lengths and windows of whole batches, against plain Python for each pair."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from millrace.functions import similarity as S

words = st.text(alphabet="abc ", max_size=12)


def lcs_length(a: str, b: str) -> int:
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        match = masks.get(c)
        if match:
            both = row & match
            row = ((row + both) | (row - both)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """0 to 1; two empty strings are equal."""
    total = len(a) + len(b)
    return 2 * lcs_length(a, b) / total if total else 1.0


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string with a window of the longer one.

    Windows have the shorter one's length, or less where they overlap an end.
    """
    if not a or not b:
        return 1.0 if not a and not b else 0.0

    def best(short: str, long: str) -> float:
        top, inside = 0.0, set(short)
        for at in range(1 - len(short), len(long)):
            window = long[max(0, at) : at + len(short)]
            # A best window starts or ends in a character that the shorter string has.
            if window[-1] in inside or window[0] in inside:
                top = max(top, ratio(short, window))
                if top == 1:
                    break
        return top

    if len(a) == len(b):
        return max(best(a, b), best(b, a))
    return best(*sorted((a, b), key=len))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the common tokens, and those followed by either side's own ones."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common, only_x, only_y = x & y, x - y, y - x
    if common and not (only_x and only_y):
        return 1.0
    base, dx, dy = " ".join(sorted(common)), " ".join(sorted(only_x)), " ".join(sorted(only_y))
    gap = 1 if base else 0
    long_x, long_y = len(base) + gap + len(dx), len(base) + gap + len(dy)
    # Both begin with the common part, so only their ends have to be compared.
    ends = 2 * (len(base) + gap + lcs_length(dx, dy)) / (long_x + long_y)
    if not base:
        return ends
    return max(ends, 2 * len(base) / (len(base) + long_x), 2 * len(base) / (len(base) + long_y))


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@given(st.lists(st.tuples(words, words), min_size=1, max_size=20))
def test_lcs(pairs):
    a, b = map(list, zip(*pairs, strict=True))
    want = [plain_lcs(x, y) for x, y in pairs]
    assert S.lcs_lengths(a, b).tolist() == want == [lcs_length(x, y) for x, y in pairs]


def test_long_texts_and_other_scripts(monkeypatch):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdé日本語 \U0001f600") for _ in range(n))
    a = [text(rng.choice([0, 5, 63, 64, 65, 128, 300])) for _ in range(60)]
    b = [text(rng.choice([0, 5, 63, 64, 65, 128, 300])) for _ in range(60)]
    for cells in (S._CELLS, 500):
        monkeypatch.setattr(S, "_CELLS", cells)
        assert S.lcs_lengths(a, b).tolist() == [lcs_length(x, y) for x, y in zip(a, b, strict=True)]
        assert S.partial_ratios(a[:25], b[:25]) == pytest.approx([partial_ratio(x, y) for x, y in zip(a[:25], b[:25], strict=True)])


@given(st.lists(st.tuples(words, words), min_size=1, max_size=8))
def test_partial_is_the_best_window(pairs):
    a, b = map(list, zip(*pairs, strict=True))
    got = S.partial_ratios(a, b)
    assert got == pytest.approx([partial_ratio(x, y) for x, y in pairs])
    for x, y, p in zip(a, b, got, strict=True):
        if x and y and len(x) != len(y):
            short, long = sorted((x, y), key=len)
            assert p == pytest.approx(max(ratio(short, long[max(0, i) : i + len(short)]) for i in range(1 - len(short), len(long))))


@given(words, words)
def test_range_and_symmetry(a, b):
    for f in (ratio, token_sort_ratio, token_set_ratio, partial_ratio):
        assert 0 <= f(a, b) <= 1 + 1e-12
        assert f(a, b) == pytest.approx(f(b, a))


def test_known_values():
    assert token_sort_ratio("b a", "a b") == 1 and token_set_ratio("acme delta", "delta acme corp") == 1
    assert S.partial_ratios(["acme", "", "a", ""], ["the acme company", "", "", "a"]).tolist() == [1, 1, 0, 0]
    assert S.lcs_lengths(["abcd"], ["abxd"]).tolist() == [3] and ratio("abcd", "abxd") == 0.75
    assert ratio("", "") == token_sort_ratio("", "") == 1 and token_set_ratio("", "") == token_set_ratio("a", "") == ratio("a", "") == 0


def test_groups_cover_everything():
    sizes = np.array([5, 1, 10**7, 3, 0, 7])
    assert sorted(np.concatenate(list(S._groups(sizes))).tolist()) == list(range(6))
