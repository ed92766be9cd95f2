"""Similarities of strings, in numpy over whole Arrow batches.

``ratio`` is the Indel similarity 2 LCS / (|a| + |b|). The longest common
subsequences of all pairs of a batch are found at once, by bit-parallel rows: a
row of bits for each pair, the positions of the shorter string, and one step of
a few array operations for each character of the longer one. Spark's
``levenshtein`` is another measure. What is not an LCS (sorting and comparing
tokens, the quotients) is left to built-in functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from millrace.functions.text import tokens

#: Array cells that a group of pairs may take (of characters, or of masks).
_CELLS = 1 << 21
_WORD = 64


def _codes(texts: list[str], width: int) -> np.ndarray:
    """(texts, width) code points, padded with 0."""
    return np.array(texts, f"U{max(width, 1)}").view(np.uint32).reshape(len(texts), -1)


def _groups(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Indices by size, as many at a time as make about ``_CELLS`` cells."""
    order, at = np.argsort(sizes, kind="stable"), 0
    while at < len(order):
        n = int(np.searchsorted(np.maximum(sizes[order[at:]], 1) * np.arange(1, len(order) - at + 1), _CELLS, "right"))
        yield order[at : at + max(n, 1)]
        at += max(n, 1)


def _masks(codes: np.ndarray, alphabet: int) -> np.ndarray:
    """(words, texts, alphabet): the positions of each symbol in each text, 64 to a word; symbol 0 has none."""
    n, width = codes.shape
    masks, rows = np.zeros((-(-width // _WORD), n, alphabet), np.uint64), np.arange(n)
    for i in range(width):
        masks[i // _WORD, rows, codes[:, i]] |= np.uint64(1 << (i % _WORD))
    masks[:, :, 0] = 0
    return masks


def _step(row: np.ndarray, match: np.ndarray) -> None:
    """One character: ``row`` and ``match`` are (words, rows); sums carry from word to word."""
    carry = np.uint64(0)
    for w in range(len(row)):
        both = row[w] & match[w]
        low = row[w] + both
        total = low + carry
        if w + 1 < len(row):
            carry = ((low < both) | (total < low)).astype(np.uint64)
        row[w] = total | (row[w] & ~match[w])


def _common(row: np.ndarray) -> np.ndarray:
    return np.bitwise_count(~row).sum(0).astype(np.int64)


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """The length of the longest common subsequence of every pair."""
    swap = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b, strict=True)]
    sizes, out = np.array([len(y) for _, y in swap], np.int64), np.zeros(len(swap), np.int64)
    for group in _groups(sizes):
        short, long = ([swap[i][k] for i in group] for k in (0, 1))
        if not (width := max(map(len, short))):
            continue
        for part, x, y, alphabet in _encoded(short, long, width, int(sizes[group].max())):
            masks, rows = _masks(x, alphabet), np.arange(len(part))
            row = np.full((len(masks), len(part)), np.iinfo(np.uint64).max)
            for j in range(y.shape[1]):
                _step(row, masks[:, rows, y[:, j]])
            out[group[part]] = _common(row)
    return out


def _encoded(short: list[str], long: list[str], width: int, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Parts of a group whose masks fit ``_CELLS``: indices, both sides' symbols (0 pads), the number of symbols."""
    x, y = _codes(short, width), _codes(long, length)
    top = int(max(x.max(), y.max())) + 1
    number = np.zeros(top, np.int32)
    number[x] = number[y] = 1
    number[0] = 0
    number = np.cumsum(number, dtype=np.int32) * number
    x, y, alphabet = number[x], number[y], int(number.max()) + 1
    step = max(1, _CELLS // (alphabet * -(-width // _WORD)))
    for at in range(0, len(short), step):
        yield np.arange(at, min(at + step, len(short))), x[at : at + step], y[at : at + step], alphabet


def partial_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """The best ratio of the shorter string with a window of the longer one; of equally long ones either may give it.

    Windows have the shorter one's length, or less where they overlap an end. Two empty strings are equal; one alone
    has nothing in common.
    """
    out = np.array([float(not x and not y) for x, y in zip(a, b, strict=True)])
    jobs = [(i, x, y) for i, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and len(x) <= len(y)]
    jobs += [(i, y, x) for i, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and len(y) <= len(x) and x != y]
    sizes = np.array([(len(x) + len(y)) ** 2 for _, x, y in jobs], np.int64)
    for group in _groups(sizes):
        of, short, long = ([jobs[i][k] for i in group] for k in range(3))
        n_short, n_long = np.array([len(x) for x in short]), np.array([len(y) for y in long])
        for part, x, y, alphabet in _encoded(short, long, int(n_short.max()), int(n_long.max())):
            best = _best_windows(x, y, n_short[part], n_long[part], alphabet)
            np.maximum.at(out, np.array(of)[part], best)
    return out


def _best_windows(short: np.ndarray, long: np.ndarray, n_short: np.ndarray, n_long: np.ndarray, alphabet: int) -> np.ndarray:
    masks, width = _masks(short, alphabet), short.shape[1]
    padded = np.pad(long, ((0, 0), (width, 2 * width)))  # position q of a text stands at width + q
    count = n_short + n_long - 1
    pair = np.repeat(np.arange(len(short)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + 1 - n_short[pair]  # where a window begins
    low, high = np.maximum(at, 0), np.minimum(at + n_short[pair], n_long[pair])
    ends = [masks[:, pair, padded[pair, width + q]].any(0) for q in (low, high - 1)]
    keep = np.flatnonzero(ends[0] | ends[1])  # a best window begins or ends in a character that the shorter string has
    best = np.zeros(len(short))
    pair, at, low, high = pair[keep], at[keep], low[keep], high[keep]
    row = np.full((len(masks), len(pair)), np.iinfo(np.uint64).max)
    for j in range(width):
        inside = (j < n_short[pair]) & (at + j >= 0)
        _step(row, masks[:, pair, np.where(inside, padded[pair, width + at + j], 0)])
    np.maximum.at(best, pair, 2 * _common(row) / (n_short[pair] + high - low))
    return best


@F.pandas_udf(ArrayType(IntegerType()))
def _lcs_of_all(*sides: pd.Series) -> pd.Series:
    """For columns a1, b1, a2, b2, ... the LCS lengths of a1 with b1, a2 with b2, ..."""
    found = [lcs_lengths(a.tolist(), b.tolist()) for a, b in zip(sides[::2], sides[1::2], strict=True)]
    return pd.Series(list(np.stack(found, 1).astype(np.int32)))


@F.pandas_udf(DoubleType())
def fuzz_partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(partial_ratios(a.tolist(), b.tolist()))


def common_lengths(pairs: list[tuple[Column, Column]]) -> Column:
    """An array of the LCS lengths of all pairs of columns, in one Arrow stage."""
    return _lcs_of_all(*(c for pair in pairs for c in pair))


def ratio(a: Column, b: Column, common: Column) -> Column:
    """0 to 1; two empty strings are equal."""
    total = F.length(a) + F.length(b)
    return F.when(total > 0, 2 * common / total).otherwise(1.0)


def sorted_tokens(s: Column) -> Column:
    return F.array_join(F.array_sort(tokens(s)), " ")


def token_sets(a: Column, b: Column) -> list[Column]:
    """The common tokens, and those of either side alone, sorted and joined."""
    x, y = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    return [F.array_join(F.array_sort(s), " ") for s in (F.array_intersect(x, y), F.array_except(x, y), F.array_except(y, x))]


def token_set_ratio(a: Column, b: Column, base: Column, only_a: Column, only_b: Column, common: Column) -> Column:
    """The best ratio among the common tokens, and those followed by either side's own ones.

    ``common`` is the LCS length of ``only_a`` and ``only_b``: both texts begin with the common tokens, so only their
    ends have to be compared.
    """
    n = F.length(base)
    start = n + F.when(n > 0, 1).otherwise(0)
    long_a, long_b = start + F.length(only_a), start + F.length(only_b)
    ends = 2 * (start + common) / (long_a + long_b)
    best = F.when(n == 0, ends).otherwise(F.greatest(ends, 2 * n / (n + long_a), 2 * n / (n + long_b)))
    none = (F.trim(a) == "") | (F.trim(b) == "")
    return F.when(none, 0.0).when((n > 0) & ((only_a == "") | (only_b == "")), 1.0).otherwise(best)
