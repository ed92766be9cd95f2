from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import ann as A
from millrace.llm import queries


def brute(vectors, queries_, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], float)
    out = {}
    for q in queries_:
        d = np.sqrt(np.square(x - np.array(vectors[q], float)).sum(1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def results(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return got


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(0)
    vectors = {i: rng.normal(size=8).tolist() for i in range(60)}
    vectors |= {100 + i: vectors[0] for i in range(30)}  # ties, of which the smaller ids win
    df = spark.createDataFrame([(i, [float(x) for x in v], "x") for i, v in vectors.items()], "vec_id long, embedding array<double>, score string")
    got = results(A.nearest_neighbours(df, F.col("vec_id") % 10 == 0, 10))
    want = brute(vectors, [i for i in vectors if i % 10 == 0], 10)
    assert got.keys() == want.keys()
    for q, rows in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in rows]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in rows], abs=1e-12)


def test_recall_over_blocks(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = results(A.nearest_neighbours(df, F.col("vec_id") % 100 == 0, 10, block_rows=1500))  # four cells
    want = brute(dict(enumerate(x)), range(0, 6000, 100), 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_ranges_hold_the_longest_prefix_matches():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 16))
    planes = A.Planes(x, 16, trees=4)
    forest = A.Forest(planes, np.arange(500), x)
    low, high = forest.ranges(x[:20], 100)
    strings = planes.strings(x)
    for q in range(20):
        assert (high[:, q] - low[:, q]).sum() >= 100
        for tree in range(4):
            inside = set(forest.order[tree, low[tree, q] : high[tree, q]].tolist())
            shared = [int(A.BITS - int(s ^ strings[tree, q]).bit_length()) for s in strings[tree]]
            least = min(shared[i] for i in inside)
            assert all(i in inside for i in range(500) if shared[i] > least) and q in inside


def test_k_neighbours_beside_copies():
    """A copy of the query stands beside it in every tree; the search still ascends to k others."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 16))
    x[1] = x[0]
    forest = A.Forest(A.Planes(x, 16), np.arange(400), x)
    q, found, score = forest.nearest(np.array([0]), x[:1], 10, 0.0)
    assert len(found) == 10 and found[0] == 1 and score[0] == 0


def test_routing_loses_nothing():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 6))[rng.integers(0, 40, 3000)] + 0.05 * rng.normal(size=(3000, 6))
    router = A.Router(x, 6, 32)
    cells = router.cells(x)
    assert len(np.unique(cells)) > 10
    for q in range(0, 3000, 60):
        distance = np.sqrt(np.square(x - x[q]).sum(1))
        radius = np.sort(distance)[10]
        visited = router.within(x[q], radius)
        assert len(visited) == len(set(visited)) and cells[q] not in visited
        assert {*visited, cells[q]} >= set(cells[distance <= radius].tolist())


def clustered(n, dim=32):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(max(5, n // 100), dim))
    return centres[rng.integers(0, len(centres), n)] + 0.15 * rng.normal(size=(n, dim))


@pytest.mark.parametrize("n", [500, 2000, 50000])
def test_clustered_vectors(spark, n, monkeypatch):
    """Recall of 0.9 or more from few candidates and, where there are several cells, few visits."""
    x, shares = clustered(n), []
    measured = A.measured_share
    monkeypatch.setattr(A, "measured_share", lambda *a: shares.append((measured(*a), a)) or shares[-1][0])
    ids = np.arange(n)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = results(A.nearest_neighbours(df, F.col("vec_id") % 100 == 0))
    norms, hits = np.square(x).sum(1), 0
    for q in range(0, n, 100):
        near = norms - 2 * x @ x[q]
        near[q] = np.inf
        hits += len(set(np.argpartition(near, 10)[:10].tolist()) & {i for i, _ in got[q]})
    assert len(got) == len(ids[::100]) and hits >= 0.9 * 10 * len(got)
    (share, (planes, parts, k)), = shares
    for part in parts:
        forest = A.Forest(planes, np.arange(len(part)), part)
        assert np.mean([len(c) for c in forest.candidates(part[:50], forest.wanted(k, share))]) < 0.3 * len(part)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]), (6, [2.0, 0.0]), (7, []), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (6, [2.0, 0.0]), (100, [1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = results(A.nearest_neighbours(df, F.col("vec_id") % 100 == 0, 10))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [100, 6], 100: [0, 6]}
    assert A.nearest_neighbours(df.filter("vec_id = -1"), F.col("vec_id") == 0).count() == 0
    assert A.nearest_neighbours(df.filter("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).count() == 0
    assert A.nearest_neighbours(df, F.lit(None).cast("boolean")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    vectors = {r.vec_id: list(map(float, r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    want = brute(vectors, [i for i in vectors if i % 100 == 0], 10)
    got = results(queries.op4_nearest_neighbours(spark, sf))
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))
