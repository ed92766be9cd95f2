"""Boosted trees on all rows: the cuts and trees of fitting in memory, wherever the sums are made."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from millrace.operators import boost as B
from millrace.operators import model as M
from millrace.operators import whole as W


def table(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).astype(np.float32)
    x[:, 2] = rng.integers(-2, 3, n)
    x[:, 3] = rng.integers(0, 1000, n) / np.float32(7)
    y = (rng.random(n) < B.sigmoid(2 * x[:, 0] * (x[:, 1] > 0) + (x[:, 2] == 1))).astype(int)
    frame = pd.DataFrame(x, columns=list("abcd")).assign(label=y)
    return x, y.astype(float), spark.createDataFrame(frame).repartition(5).cache()


def test_trees_of_all_rows_are_those_of_fitting_in_memory(spark, monkeypatch):
    monkeypatch.setattr(W, "SAVED", 2)
    monkeypatch.setattr(W, "BLOCK", 700)
    x, y, rows = table(spark, 6000, 0)
    vx, vy, valid = table(spark, 1000, 1)
    for f, cuts in enumerate(W.exact_cuts(rows, list("abcd"))):
        assert cuts.tolist() == B.quantile_cuts(x[:, f].astype(float)).tolist()
    wanted = B.fit(x, y, 5, 0.1, leaves=12, valid=(vx, vy))
    here, there = (W.fit(rows, list("abcd"), 5, 0.1, leaves=12, valid=valid, in_driver=n) for n in (10**6, 0))
    assert here == there  # to the last digit
    assert [(t.feature, t.cut) for t in here.trees] == [(t.feature, t.cut) for t in wanted.trees]
    assert here.gains == pytest.approx(wanted.gains, rel=1e-4)
    assert here.margins(vx) == pytest.approx(wanted.margins(vx), abs=1e-5)


def test_boosting_ends_by_all_held_out_rows(spark):
    x, y, rows = table(spark, 3000, 2)
    vx, vy, valid = table(spark, 500, 3)
    model, wanted = W.fit(rows, list("abcd"), 200, 0.3, valid=valid, patience=5), B.fit(x, y, 200, 0.3, valid=(vx, vy), patience=5)
    assert 0 < len(model.trees) == len(wanted.trees) < 200
    assert W.fit(rows.filter("label > 1"), list("abcd"), 3, 0.1).trees == []


def test_the_scorer_fits_on_every_row(spark, monkeypatch):
    def sampled(*_):
        raise AssertionError("a sample came to the driver")

    monkeypatch.setattr(M, "_gather", sampled)
    _, _, rows = table(spark, 400, 4)
    made = rows.selectExpr("label", *(f"{'abcd'[k % 4]} as {n}" for k, n in enumerate(M.FEATURE_NAMES)))
    assert len(M.BoostedTrees().fit(made, rounds=2).model.trees) == 2
