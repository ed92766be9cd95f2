"""Boosted trees (:mod:`boost`) on all rows of a table, however many.

Histograms know rows by their bins alone, so rows of the same bins and fold are
counted once (:func:`coded`), after bins are cut at exact quantiles of all rows
(:func:`exact_cuts`). A tree is grown level by level, which takes one pass over
the blocks for each level, and cut back to the splits that leaf-wise growth takes.
The passes run where the blocks are; if there are few, in the driver. Sums are of
integers (multiples of 2 ** -30), so they do not depend on where and in what order
they are made.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.scratch import delete, scratch_dir

from . import boost
from .boost import LEAST_ROWS, MAX_BINS, Boosted, Tree, sigmoid

#: Up to so many different rows the driver makes the sums itself: about 100 bytes a row. The sums are the same.
IN_DRIVER = 1_000_000
#: Different rows of a block, and trees after which blocks are written anew with their margins.
BLOCK, SAVED = 1 << 17, 8
_UNIT = float(1 << 30)

Block = tuple[np.ndarray, np.ndarray, np.ndarray]  # codes (rows, features), counts (4, rows): all, positive, all and positive held out; margins


def exact_cuts(rows: DataFrame, names: list[str], bins: int = MAX_BINS) -> list[np.ndarray]:
    """:func:`boost.quantile_cuts` of each column, over all rows. The driver gets counts of cells (upper halves of the
    numbers) and the values at the quantiles."""

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            x = np.concatenate(held, 1)
            parts = [(f, *np.unique(column, return_counts=True)) for f, column in enumerate(x)]
            value = np.concatenate([v for _, v, _ in parts])
            bits = value.view(np.int32)
            cell = (bits ^ ((bits >> 31) & 0x7FFFFFFF)) >> 16  # in the order of the values
            of = np.concatenate([np.full(len(v), f, np.int32) for f, v, _ in parts])
            return pa.RecordBatch.from_arrays([pa.array(of), pa.array(cell.astype(np.int32)), pa.array(value), pa.array(np.concatenate([n for *_, n in parts]).astype(np.int64))], names=["f", "cell", "value", "n"])

        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.float32) + np.float32(0))
            if sum(x.shape[1] for x in held) >= 200_000:
                yield counted()
                held = []
        if held:
            yield counted()

    every = rows.select(*(F.col(c).cast("float") for c in names)).mapInArrow(values, "f int, cell int, value float, n long").groupBy("f", "cell", "value").agg(F.sum("n").alias("n")).persist()
    cells: list[list[tuple[int, int, int]]] = [[] for _ in names]
    for r in every.groupBy("f", "cell").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d")).collect():
        cells[r["f"]].append((r["cell"], r["n"], r["d"]))
    wanted = []
    for f, found in enumerate(cells):
        found.sort()
        before = np.cumsum([0, *(n for _, n, _ in found)])
        if sum(d for *_, d in found) <= bins:
            wanted += [(f, cell, 0, None) for cell, *_ in found]
            continue
        place = before[-1] * np.linspace(0, 1, bins) - 1
        place = np.unique(np.maximum(np.ceil(place), 0).astype(np.int64))  # the inverted distribution function
        inside = np.searchsorted(before, place, "right") - 1
        wanted += [(f, found[c][0], int(before[c]), place[inside == c].tolist()) for c in np.unique(inside)]
    taken = every.join(F.broadcast(rows.sparkSession.createDataFrame(wanted, "f int, cell int, before long, places array<long>")), ["f", "cell"])
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("f", "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    at = F.col("places").isNull() | F.exists("places", lambda p: (p >= F.col("upto") - F.col("n")) & (p < F.col("upto")))
    picked: list[list[float]] = [[] for _ in names]
    for r in taken.withColumn("upto", upto).filter(at).select("f", "value").collect():
        picked[r["f"]].append(r["value"])
    every.unpersist()
    ends = [np.unique(np.array(v, float)) for v in picked]
    return [(v[1:] + v[:-1]) / 2 for v in ends]


def coded(rows: DataFrame, names: list[str], cuts: list[np.ndarray]) -> DataFrame:
    """``size, codes, counts, margins`` of blocks: the different rows by their bins, with how many there are. ``rows`` has the
    columns ``names``, ``label`` and ``held`` (1 for rows that only end the boosting)."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, held, *x = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            codes = np.stack([np.searchsorted(c, v.astype(np.float32).astype(float), "left") for c, v in zip(cuts, x, strict=True)], 1).astype(np.uint8)
            keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(cuts)), len(codes), [None, pa.py_buffer(codes.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([keys, pa.array(label), pa.array(held)], names=["code", "label", "held"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                counts = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns[1:]]).astype(np.int64)
                out = [b"".join(part.column(0).to_pylist()), counts.tobytes(), np.zeros(part.num_rows).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([part.num_rows]), *(pa.array([x], pa.binary()) for x in out)], names=["size", "codes", "counts", "margins"])

    each = rows.select(F.col("label").cast("long"), F.col("held").cast("long"), *(F.col(c).cast("float") for c in names)).mapInArrow(code, "code binary, label long, held long")
    learnt = 1 - F.col("held")
    counts = [F.sum(learnt), F.sum(learnt * F.col("label")), F.sum("held"), F.sum(F.col("held") * F.col("label"))]
    return each.groupBy("code").agg(*(c.alias(f"n{k}") for k, c in enumerate(counts))).mapInArrow(pack, "size long, codes binary, counts binary, margins binary")


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    for size, codes, counts, margins in zip(*(batch.column(c).to_pylist() for c in ("size", "codes", "counts", "margins")), strict=True):
        yield np.asfortranarray(np.frombuffer(codes, np.uint8).reshape(size, -1)), np.frombuffer(counts, np.int64).reshape(4, size), np.frombuffer(margins)


def _leaf(tree: Tree, codes: np.ndarray) -> np.ndarray:
    """The node of each row; ``tree`` splits after bins."""
    feature, cut, left, right = (np.array(c) for c in (tree.feature, tree.cut, tree.left, tree.right))
    at, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
    while (inner := feature[at] >= 0).any():
        to = np.where(codes[rows, np.maximum(feature[at], 0)] <= cut[at], left[at], right[at])
        at = np.where(inner, to, at)
    return at


def _moved(block: Block, trees: list[Tree]) -> np.ndarray:
    return reduce(lambda margin, tree: margin + np.array(tree.value)[_leaf(tree, block[0])], trees, block[2])


def _tally(block: Block, margin: np.ndarray, tree: Tree, nodes: list[int], width: int) -> tuple[np.ndarray, int]:
    """(nodes, 3, features, bins) of the rows in ``nodes``: sums of first and second derivatives in units, and rows; and the
    loss of held-out rows in units."""
    codes, (n, positive, held, held_positive), _ = block
    p = sigmoid(margin)
    slot = np.full(len(tree.value), -1)
    slot[nodes] = np.arange(len(nodes))
    slot = slot[_leaf(tree, codes)]
    rows = np.flatnonzero((slot >= 0) & (n > 0))
    start = slot[rows] * width
    weights = np.rint((p * n - positive) * _UNIT)[rows], np.rint(p * (1 - p) * n * _UNIT)[rows], n[rows].astype(float)
    out = np.empty((len(nodes), 3, codes.shape[1], width), np.int64)
    for f in range(codes.shape[1]):
        own = start + codes[:, f][rows]
        for k, w in enumerate(weights):
            out[:, k, f] = np.bincount(own, weights=w, minlength=len(nodes) * width).reshape(len(nodes), width)
    loss = np.rint((held * np.logaddexp(0, margin) - held_positive * margin) * _UNIT)
    return out, sum(map(int, loss.astype(np.int64)[held > 0]))


class _Driver:
    """Blocks as one, in the driver."""

    def __init__(self, blocks: DataFrame, width: int) -> None:
        codes, counts = [], []
        for r in blocks.select("size", "codes", "counts").toLocalIterator():
            codes.append(np.frombuffer(r["codes"], np.uint8).reshape(r["size"], -1))
            counts.append(np.frombuffer(r["counts"], np.int64).reshape(4, -1))
        self.block = np.asfortranarray(np.concatenate(codes)), np.concatenate(counts, 1), np.zeros(sum(map(len, codes)))
        self.width = width

    def sums(self, tree: Tree, nodes: list[int]) -> tuple[np.ndarray, int]:
        return _tally(self.block, self.block[2], tree, nodes, self.width)

    def add(self, tree: Tree) -> None:
        self.block = *self.block[:2], _moved(self.block, [tree])

    def close(self) -> None:
        pass


class _Cluster:
    """Blocks where they are; margins are those written last and what the trees since add."""

    def __init__(self, blocks: DataFrame, path: str, width: int, features: int) -> None:
        self.blocks, self.path, self.width, self.features = blocks, path, width, features
        self.trees: list[Tree] = []

    def sums(self, tree: Tree, nodes: list[int]) -> tuple[np.ndarray, int]:
        trees, width, shape = self.trees, self.width, (len(nodes), 3, self.features, self.width)

        def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, loss = np.zeros(shape, np.int64), 0
            for batch in batches:
                for block in _blocks(batch):
                    more, lost = _tally(block, _moved(block, trees), tree, nodes, width)
                    out, loss = out + more, loss + lost
            parts = [*(x.tobytes() for x in out), np.array([loss], np.int64).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.binary())], names=["node", "sums"])

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for node, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    total[node] = total.get(node, 0) + np.frombuffer(part, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["node", "sums"])

        kind = "node long, sums binary"
        got = {r["node"]: np.frombuffer(r["sums"], np.int64) for r in self.blocks.mapInArrow(tally, kind).repartition("node").mapInArrow(add_up, kind).collect()}
        return np.stack([got[k].reshape(shape[1:]) for k in range(len(nodes))]), int(got[len(nodes)][0])

    def add(self, tree: Tree) -> None:
        self.trees = [*self.trees, tree]
        if len(self.trees) < SAVED:
            return
        trees, spark, old = self.trees, self.blocks.sparkSession, self.path

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margins = pa.array([_moved(b, trees).tobytes() for b in _blocks(batch)], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], margins], names=["size", "codes", "counts", "margins"])

        self.path, self.trees = scratch_dir(spark, "margins"), []
        self.blocks.mapInArrow(move, self.blocks.schema).write.parquet(self.path)
        self.blocks = spark.read.parquet(self.path)
        delete(spark, old)

    def close(self) -> None:
        delete(self.blocks.sparkSession, self.path)


def _grown(at: _Driver | _Cluster, root: np.ndarray, grower: boost._Grower, use: np.ndarray, rate: float) -> tuple[Tree, Tree, np.ndarray]:
    """A tree that splits at values, the same that splits after bins, and the gain by feature."""
    full, sums, splits = Tree(), {0: root}, {}
    value = lambda s: -rate * float(s[0]) / max(float(s[1]), 1e-12 * _UNIT)
    full.add(value(root[:, 0].sum(1)))
    level = [0]
    for deep in range(grower.depth):
        families = []
        for node in level:
            s = sums[node]
            if s[2, 0].sum() < 2 * LEAST_ROWS:
                continue
            gain, feature, bin_ = grower._split(s / np.array([_UNIT, _UNIT, 1.0])[:, None, None], use)
            if gain <= 0:
                continue
            left = s[:, feature, : bin_ + 1].sum(1)
            totals = left, s[:, feature].sum(1) - left
            children = [full.add(value(t)) for t in totals]
            full.feature[node], full.cut[node], (full.left[node], full.right[node]) = feature, float(bin_), children
            splits[node] = gain
            small = int(totals[1][2] < totals[0][2])
            if deep + 1 < grower.depth and max(t[2] for t in totals) >= 2 * LEAST_ROWS:
                families.append((node, children[small], children[1 - small]))
        if not families:
            break
        got, _ = at.sums(full, [small for _, small, _ in families])
        for (node, small, large), own in zip(families, got, strict=True):
            sums[small], sums[large] = own, sums[node] - own
        level = [child for _, *both in families for child in sorted(both)]
        sums = {node: sums[node] for node in level}

    real, binned, gains = Tree(), Tree(), np.zeros(len(use))
    of = {real.add(full.value[0]): 0}
    binned.add(full.value[0])
    for _ in range(grower.leaves - 1):
        able = [n for n, m in of.items() if m in splits and real.feature[n] < 0]
        if not able:
            break
        node = max(able, key=lambda n: (splits[of[n]], -n))
        m = of[node]
        feature, bin_ = full.feature[m], int(full.cut[m])
        gains[feature] += splits[m]
        for tree, cut in ((real, float(grower.cuts[feature][bin_])), (binned, float(bin_))):
            tree.feature[node], tree.cut[node] = feature, cut
            tree.left[node], tree.right[node] = (tree.add(full.value[c]) for c in (full.left[m], full.right[m]))
        of |= {real.left[node]: full.left[m], real.right[node]: full.right[m]}
    return real, binned, gains


def fit(
    labelled: DataFrame,
    names: list[str],
    rounds: int,
    rate: float,
    leaves: int = 31,
    depth: int = 6,
    columns: float = 0.8,
    valid: DataFrame | None = None,
    patience: int = 50,
    seed: int = 42,
    in_driver: int | None = None,
) -> Boosted:
    """:func:`boost.fit` on all rows of ``labelled`` (columns ``names`` and ``label``), ended by all rows of ``valid``."""
    spark = labelled.sparkSession
    read = scratch_dir(spark, "pairs")  # what follows has a short plan, and no pair is made twice
    for held, df in enumerate([labelled] if valid is None else [labelled, valid]):
        df.select("label", *(F.col(c).cast("float") for c in names)).write.parquet(f"{read}/held={held}")
    rows = spark.read.parquet(read)
    cuts = exact_cuts(rows.filter("held = 0"), names)
    path = scratch_dir(spark, "coded")
    coded(rows, names, cuts).write.parquet(path)
    delete(spark, read)
    blocks = spark.read.parquet(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([int(v)]) for v in (size, *np.frombuffer(counts, np.int64).reshape(4, -1).sum(1))], names=["size", "n", "positive", "held", "held_positive"])

    counts = blocks.select("size", "counts").mapInArrow(count, "size long, n long, positive long, held long, held_positive long")
    different, n, positive, held, _ = (int(v or 0) for v in counts.agg(*(F.sum(c) for c in counts.columns)).first())
    share = min(max(positive / n, 1e-9), 1 - 1e-9) if n else 0.5
    model = Boosted(float(np.log(share / (1 - share))), [], [0.0] * len(names))
    if n < 2 * LEAST_ROWS or share in (1e-9, 1 - 1e-9) or not any(map(len, cuts)):
        delete(spark, path)
        return model
    grower = boost._Grower(np.empty((0, len(names))), cuts, leaves, depth)
    at = _Driver(blocks, grower.width) if different <= (IN_DRIVER if in_driver is None else in_driver) else _Cluster(blocks, path, grower.width, len(names))
    start = Tree()
    start.add(model.base)
    at.add(start)
    rng, best, best_round, by_round, single = np.random.default_rng(seed), None, 0, [], Tree()
    single.add(0.0)
    for k in range(rounds + 1):
        if k == rounds and not held:
            break
        (root,), loss = at.sums(single, [0])  # and the loss of the trees so far
        if held and k and (best is None or loss < best):
            best, best_round = loss, k
        elif held and k - best_round >= patience:
            break
        if k == rounds:
            break
        use = np.zeros(len(names), bool)
        use[rng.choice(len(names), max(1, round(columns * len(names))), replace=False)] = True
        real, binned, gains = _grown(at, root, grower, use, rate)
        model.trees.append(real)
        by_round.append(gains)
        at.add(binned)
    at.close()
    delete(spark, path)
    if held:
        model.trees, by_round = model.trees[:best_round], by_round[:best_round]
    model.gains = [float(v) for v in np.sum(by_round, axis=0)] if by_round else model.gains
    return model
