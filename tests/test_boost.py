"""Boosted trees: splits by brute force, early stopping, determinism."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import boost as B
from millrace.operators import model as M


def data(n=2000, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    x[:, 4] = rng.integers(0, 3, n)
    margin = 2 * x[:, 0] * (x[:, 1] > 0) + (x[:, 4] == 1) - 0.5
    return x, (rng.random(n) < B.sigmoid(margin)).astype(float), margin


def test_first_split_by_brute_force():
    x, y, _ = data(300)
    p = np.full(300, y.mean())
    g, h = p - y, p * (1 - p)
    best = (-np.inf,)
    for f in range(5):
        for cut in B.quantile_cuts(x[:, f]):
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= B.LEAST_ROWS:
                gain = sum(g[s].sum() ** 2 / h[s].sum() for s in (left, ~left)) - g.sum() ** 2 / h.sum()
                best = max(best, (gain, f, cut))
    tree = B.fit(x, y, 1, 1.0, leaves=2, columns=1.0).trees[0]
    assert (tree.feature[0], tree.cut[0]) == (best[1], best[2])
    left = x[:, best[1]] <= best[2]
    assert tree.margins(x) == pytest.approx(np.where(left, -g[left].sum() / h[left].sum(), -g[~left].sum() / h[~left].sum()))


def test_margins_seen_in_training_are_those_of_scoring():
    x, y, _ = data()
    model = B.fit(x, y, 30, 0.1)
    cuts = [B.quantile_cuts(x[:, f]) for f in range(5)]
    codes = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    grower = B._Grower(codes, cuts, 31, 6)
    p = np.full(len(y), y.mean())
    tree, add, _ = grower.grow(p - y, p * (1 - p), np.ones(5, bool), 0.1)
    assert tree.margins(x) == pytest.approx(add)
    assert max(sum(f < 0 for f in t.feature) for t in model.trees) <= 31


def test_learns_and_stops_early():
    x, y, _ = data(4000)
    vx, vy, truth = data(2000, seed=1)
    model = B.fit(x, y, 300, 0.1, valid=(vx, vy), patience=20)
    losses = [B.log_loss(vy, B.Boosted(model.base, model.trees[:k], []).margins(vx)) for k in range(len(model.trees) + 1)]
    assert 5 < len(model.trees) < 300 and losses[-1] == min(losses)
    assert losses[-1] - B.log_loss(vy, truth) < 0.2 * (losses[0] - B.log_loss(vy, truth))  # most of what can be learned
    assert max(model.gains) == model.gains[0]
    again = B.fit(x, y, 300, 0.1, valid=(vx, vy), patience=20)
    assert again.margins(vx).tolist() == model.margins(vx).tolist()


def test_nothing_to_learn():
    x = np.zeros((100, 3))
    assert B.fit(x, np.arange(100) % 2.0, 10, 0.1).probabilities(x) == pytest.approx(np.full(100, 0.5))
    assert B.fit(x + np.arange(3), np.ones(100), 10, 0.1).trees == []
    assert B.fit(np.zeros((0, 3)), np.zeros(0), 10, 0.1).trees == []


def test_margin_of_rows_on_a_cut():
    cuts = B.quantile_cuts(np.array([0.0, 1.0, 1.0, 2.0]))
    assert cuts.tolist() == [0.5, 1.5]
    assert len(B.quantile_cuts(np.arange(10_000.0))) < 255


def test_fit_holds_a_byte_for_a_feature_of_a_row():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40_000, 23)).astype(np.float32)
    y = (x[:, 0] > 0).astype(float)
    tracemalloc.start()
    B.fit(x, y, 2, 0.1, valid=(x[:100], y[:100]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * x.size  # eight bytes a feature, twice over, were more than double that


def test_the_driver_gets_the_rows_of_the_smallest_hashes_alone(spark, monkeypatch):
    names = M.FEATURE_NAMES
    rows = spark.range(5000).select(F.concat(F.lit("S1-"), "id").alias("s1_id"), F.lit("S2-1").alias("t_id"), (F.col("id") % 3 == 0).cast("int").alias("label"),
                                    *((F.col("id") * (k + 1) / 7).alias(n) for k, n in enumerate(names))).repartition(7)
    first = rows.withColumn("k", F.xxhash64(F.lit(42), *names, "label", "s1_id", "t_id")).orderBy("k").toPandas()

    def no_sort(*_):
        raise AssertionError("every partition would send the driver that many rows")

    monkeypatch.setattr(DataFrame, "limit", no_sort)
    for n in (1, 700, 4999, 5000, 9000):
        x, y = M._gather(rows, n, 42)
        assert x.dtype == np.float32 and (x == first[names].to_numpy(np.float32)[:n]).all() and y.tolist() == first["label"].tolist()[:n]
    x, y = M._gather(rows.filter("label > 1"), 10, 42)
    assert x.shape == (0, len(names)) and len(y) == 0
    assert M.BoostedTrees().fit(rows, rounds=3, valid=rows, max_pairs=300).model.trees
