"""Leaf-wise gradient-boosted trees over histograms, for binary labels.

Features are cut into at most ``MAX_BINS`` bins at quantiles. A tree grows by
splitting the leaf whose best split gains most, until it has ``leaves`` leaves
or none may be split; only the smaller child's histogram is summed, the other
is the difference. Fitting is in memory, on the bounded sample that the caller
gathers; scoring is a few array operations a tree level and runs wherever the
features are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

MAX_BINS = 255
#: The usual least rows and least sum of second derivatives of a leaf.
LEAST_ROWS = 20
LEAST_HESSIAN = 1e-3


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def log_loss(y: np.ndarray, margin: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, margin) - y * margin))


def quantile_cuts(x: np.ndarray, bins: int = MAX_BINS) -> np.ndarray:
    """Rising thresholds between values: all of them if there are few, else those nearest to the quantiles."""
    values = np.unique(x)
    if len(values) > bins:
        values = np.unique(np.quantile(x, np.linspace(0, 1, bins), method="inverted_cdf"))
    return (values[1:] + values[:-1]) / 2


@dataclass
class Tree:
    """Nodes in arrays. A node of ``feature`` -1 is a leaf; others go left where the value is at most ``cut``."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, x in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.value, value)):
            column.append(x)
        return len(self.value) - 1

    def margins(self, x: np.ndarray) -> np.ndarray:
        feature, cut, left, right, value = (np.array(c) for c in (self.feature, self.cut, self.left, self.right, self.value))
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while (inner := feature[at] >= 0).any():
            to = np.where(x[rows, np.maximum(feature[at], 0)] <= cut[at], left[at], right[at])
            at = np.where(inner, to, at)
        return value[at]


@dataclass
class Boosted:
    """The model: a first margin, trees, and what their splits on each feature gained."""

    base: float
    trees: list[Tree]
    gains: list[float]

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.margins(x)
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margins(x))


class _Grower:
    def __init__(self, codes: np.ndarray, cuts: list[np.ndarray], leaves: int, depth: int) -> None:
        self.cuts, self.leaves, self.depth = cuts, leaves, depth
        self.width = max(len(c) for c in cuts) + 1
        self.codes = np.asfortranarray(codes, np.uint8)  # a byte each, feature by feature
        allowed = np.arange(self.width)[None, :] < np.array([len(c) for c in cuts])[:, None]
        self.allowed = allowed  # (features, bins): a split after this bin

    def _histogram(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """(3, features, bins): sums of first and second derivatives, and rows."""
        sums = np.empty((3, self.codes.shape[1], self.width))
        weights = g[rows], h[rows], None
        for f in range(self.codes.shape[1]):
            own = self.codes[:, f][rows].astype(np.intp)
            for k, w in enumerate(weights):
                sums[k, f] = np.bincount(own, weights=w, minlength=self.width)
        return sums

    def _split(self, sums: np.ndarray, use: np.ndarray) -> tuple[float, int, int]:
        """Gain, feature and bin of the best split."""
        left = np.cumsum(sums, axis=2)
        total = left[:, :, -1:]
        right = total - left
        able = self.allowed & use[:, None]
        for side in (left, right):
            able = able & (side[2] >= LEAST_ROWS) & (side[1] >= LEAST_HESSIAN)
        score = lambda s: np.square(s[0]) / np.maximum(s[1], 1e-12)
        gain = np.where(able, score(left) + score(right) - score(total), -np.inf)
        best = int(gain.argmax())
        return float(gain.reshape(-1)[best]), best // self.width, best % self.width

    def grow(self, g: np.ndarray, h: np.ndarray, use: np.ndarray, rate: float) -> tuple[Tree, np.ndarray, np.ndarray]:
        """A tree, what it adds to each row's margin, and the gain by feature."""
        tree, gains, add = Tree(), np.zeros(len(use)), np.zeros(len(g))
        output = lambda rows: -rate * float(g[rows].sum()) / max(float(h[rows].sum()), 1e-12)
        every = np.arange(len(g))
        open_: list[tuple[float, int, int, int, np.ndarray, np.ndarray, int]] = []

        def consider(node: int, rows: np.ndarray, sums: np.ndarray, level: int) -> None:
            add[rows] = tree.value[node]
            if level < self.depth and len(rows) >= 2 * LEAST_ROWS:
                gain, feature, bin_ = self._split(sums, use)
                if gain > 0:
                    open_.append((gain, node, feature, bin_, rows, sums, level))

        consider(tree.add(output(every)), every, self._histogram(every, g, h), 0)
        for _ in range(self.leaves - 1):
            if not open_:
                break
            k = max(range(len(open_)), key=lambda i: (open_[i][0], -open_[i][1]))
            gain, node, feature, bin_, rows, sums, level = open_.pop(k)
            gains[feature] += gain
            to_left = self.codes[rows, feature] <= bin_
            parts = rows[to_left], rows[~to_left]
            small = int(len(parts[1]) < len(parts[0]))
            own = self._histogram(parts[small], g, h)
            histograms = (own, sums - own) if small == 0 else (sums - own, own)
            children = [tree.add(output(p)) for p in parts]
            tree.feature[node], tree.cut[node], (tree.left[node], tree.right[node]) = feature, float(self.cuts[feature][bin_]), children
            for child, part, s in zip(children, parts, histograms, strict=True):
                consider(child, part, s, level + 1)
        return tree, add, gains


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int,
    rate: float,
    leaves: int = 31,
    depth: int = 6,
    columns: float = 0.8,
    valid: tuple[np.ndarray, np.ndarray] | None = None,
    patience: int = 50,
    seed: int = 42,
) -> Boosted:
    """Boost on log-loss. Each tree sees a part ``columns`` of the features. With ``valid`` rows, boosting ends once their
    loss has not fallen for ``patience`` rounds, and the trees up to the best round are kept."""
    share = min(max(float(y.mean()), 1e-9), 1 - 1e-9) if len(y) else 0.5
    model = Boosted(float(np.log(share / (1 - share))), [], [0.0] * x.shape[1])
    cuts = [quantile_cuts(x[:, f].astype(float)) for f in range(x.shape[1])]
    if len(y) < 2 * LEAST_ROWS or share in (1e-9, 1 - 1e-9) or not any(map(len, cuts)):
        return model
    codes = np.empty(x.shape, np.uint8, order="F")  # MAX_BINS at most
    for f, c in enumerate(cuts):
        codes[:, f] = np.searchsorted(c, x[:, f].astype(float), "left")
    grower, rng = _Grower(codes, cuts, leaves, depth), np.random.default_rng(seed)
    margin, held = np.full(len(y), model.base), None if valid is None else np.full(len(valid[1]), model.base)
    best, best_round, by_round = np.inf, 0, []
    for k in range(rounds):
        use = np.zeros(x.shape[1], bool)
        use[rng.choice(x.shape[1], max(1, round(columns * x.shape[1])), replace=False)] = True
        p = sigmoid(margin)
        tree, add, gains = grower.grow(p - y, p * (1 - p), use, rate)
        model.trees.append(tree)
        by_round.append(gains)
        margin += add
        if held is not None and len(held):
            held += tree.margins(valid[0])
            loss = log_loss(valid[1], held)
            if loss < best:
                best, best_round = loss, k + 1
            elif k + 1 - best_round >= patience:
                break
    if held is not None and len(held):
        model.trees, by_round = model.trees[:best_round], by_round[:best_round]
    model.gains = [float(v) for v in np.sum(by_round, axis=0)] if by_round else model.gains
    return model
