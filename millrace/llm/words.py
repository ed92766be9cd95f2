"""Word sequences, as the licence scan and decontamination compare them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Hashable, Sequence

#: A-Z to lower case; every other ASCII byte that is no letter or digit to a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def longest_common_subsequence(a: Sequence[Hashable], b: Sequence[Hashable]) -> int:
    """Its length, by bit-parallel rows (Hyyro's form); ``a``'s positions are the bits."""
    masks: dict[Hashable, int] = defaultdict(int)
    for i, w in enumerate(a):
        masks[w] |= 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        match = masks.get(w, 0)
        if match:
            both = row & match
            row = ((row + both) | (row - both)) & full
    return len(a) - row.bit_count()
