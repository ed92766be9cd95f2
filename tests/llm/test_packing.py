from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import packing as P
from millrace.llm import queries, tokens

from .conftest import MESSY


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.tokenizer_path())


def test_encoder_equals_the_tokenizer(tokenizer):
    spec = open(queries.tokenizer_path(), encoding="utf-8").read()
    assert not tokens.unreachable(spec)  # so ranked merges are those by pairs
    enc, rng = tokens.MemoEncoder(spec, frozenset()), random.Random(1)
    letters = "abcdeéèñßœfghij ''''stredll0123²¼.,!?&*# \n\tÀÉİıſ×÷ªº—日本<|endoftext|>\x85\xa0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [t or "" for _, t in MESSY]
    for text, ids in zip(texts, enc.encode(texts), strict=True):
        assert ids == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_unreachable_tokens():
    spec = '{"model": {"end_of_word_suffix": "</w>", "vocab": {}, "merges": [["a", "b"], ["b", "c"], ["ab", "c"], ["a", "bc"], ["x", "bc"]]}}'
    assert tokens.unreachable(spec) == frozenset()
    spec = '{"model": {"end_of_word_suffix": "</w>", "vocab": {}, "merges": [["b", "c"], ["a", "b"], ["ab", "c"]]}}'
    assert tokens.unreachable(spec) == {"abc"}


def check(rows, capacity):
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert all(n <= capacity for n in at.values())
    return at


@pytest.mark.parametrize("capacity", [16, 4096])
def test_messy_round_trip(spark, messy, tokenizer, capacity):
    rows = P.pack_documents(messy, queries.tokenizer_path(), capacity).collect()
    check(rows, capacity)
    got = {}
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.piece)):
        assert r.start == r.piece * capacity and len(r.ids) == 4 * r.length
        got.setdefault((r.doc_id, r.piece), []).append(bytes(r.ids))
    want = {}
    for doc, text in MESSY:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for p in range(0, len(ids), capacity):
            want.setdefault((doc, p // capacity), []).append(ids[p : p + capacity].tobytes())
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_empty(none):
    assert P.pack_documents(none, queries.tokenizer_path()).count() == 0


def triplets(n, capacity, seed=0):
    """Sizes of which three each fill a sequence: best-fit decreasing pairs them badly."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(n):
        a = int(rng.integers(int(0.38 * capacity), int(0.49 * capacity)))
        b = int(rng.integers(capacity // 4, (capacity - a) // 2 + 1))
        out += [a, b, capacity - a - b]
    return rng.permutation(np.array(out))


def best_fit_decreasing(sizes, capacity=4096):
    return P.best_fit(sizes, np.argsort(-sizes, kind="stable"), np.full(len(sizes), -1, np.int32), capacity)


def test_genetic_steps_keep_every_piece():
    rng = np.random.default_rng(0)
    for sizes in (rng.integers(1, 4096, 500), triplets(100, 4096), np.array([4000])):
        a, b = P.evolve(sizes, [], 4096, 1)[:2]
        for child in (P.breed(sizes, a, b, 4096, rng), *P.evolve(sizes, [a, b], 4096, 2)):
            assert (child >= 0).all() and np.bincount(child, weights=sizes).max() <= 4096
            assert set(child.tolist()) == set(range(child.max() + 1))
        first = best_fit_decreasing(sizes)
        assert P.fitness(sizes, P.evolve(sizes, [first], 4096, 3)[0], 4096) >= P.fitness(sizes, first, 4096)


def test_crossover_injects_whole_sequences():
    sizes, rng = triplets(60, 4096), np.random.default_rng(4)
    a = best_fit_decreasing(sizes)
    b = np.zeros(len(sizes), np.int32)
    whole = P.evolve(sizes, [], 4096, 9)[-1]
    b[:] = whole
    fill = np.bincount(b, weights=sizes)
    child = P.crossover(sizes, a, b, 4096, rng)
    assert (child < 0).any() and set(child[child >= 0].tolist()) == set(range(child.max() + 1))
    groups = {frozenset(np.flatnonzero(child == s).tolist()) for s in range(child.max() + 1)}
    from_b = groups & {frozenset(np.flatnonzero(b == s).tolist()) for s in np.flatnonzero(fill >= P.WELL_FILLED * 4096)}
    from_a = groups & {frozenset(np.flatnonzero(a == s).tolist()) for s in range(a.max() + 1)}
    assert from_b and groups == from_a | from_b


def test_crossover_runs_and_beats_best_fit_decreasing(monkeypatch):
    calls, crossover = [], P.crossover
    monkeypatch.setattr(P, "crossover", lambda *a: calls.append(1) or crossover(*a))
    small = np.random.default_rng(1).integers(1, 900, 400)
    P.evolve(small, [], 4096, 1)
    assert len(calls) >= P.POPULATION  # even where best-fit decreasing has reached the bound already
    sizes = triplets(60, 4096)
    found = P.evolve(sizes, [], 4096, 1)[0]
    assert len(set(found.tolist())) < len(set(best_fit_decreasing(sizes).tolist())) - 2


def test_migration_brings_an_elite(spark):
    """Two islands of the same pieces, one with a far better packing: after an epoch both have it or a better one."""
    sizes = triplets(40, 4096)
    good = P.evolve(sizes, [], 4096, 1)
    for e in range(2, 5):
        good = P.evolve(sizes, good, 4096, e)
    bad = np.arange(len(sizes), dtype=np.int32)  # every piece alone
    uids = np.arange(len(sizes), dtype=np.int64)
    rows = [(0, k, uids.tobytes(), sizes.astype(np.int64).tobytes(), [p.astype(np.int32).tobytes()]) for k, p in ((0, good[0]), (1, bad))]
    islands = spark.createDataFrame([(a, i, bytearray(u), bytearray(s), [bytearray(x) for x in p]) for a, i, u, s, p in rows], P._ISLAND)
    moved = {r.island: [np.frombuffer(p, np.int32) for p in r.population] for r in P._migrate(islands).collect()}
    assert len(moved[1]) == 2 and np.array_equal(moved[1][1], good[0]) and np.array_equal(moved[0][1], bad)
    after = P.evolve(sizes, list(moved[1]), 4096, 7)[0]
    alone = P.evolve(sizes, [bad], 4096, 7)[0]
    assert P.fitness(sizes, after, 4096) >= P.fitness(sizes, good[0], 4096) >= P.fitness(sizes, alone, 4096)


def test_query_form_on_triplets(spark):
    sizes = triplets(50, 4096, 3)
    pieces = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "uid long, length long")
    placed = P.pack_pieces(pieces, 4096).join(pieces, "uid").collect()
    assert len(check(placed, 4096)) < len(set(best_fit_decreasing(sizes).tolist())) - 2


def test_packs_near_the_bound_over_many_islands(spark):
    pieces = spark.range(20000).select(F.col("id").alias("uid"), (F.pmod(F.xxhash64("id"), F.lit(1500)) + 1).alias("length"))
    placed = P.pack_pieces(pieces, 4096).join(pieces, "uid").collect()
    assert len({r.uid for r in placed}) == len(placed) == 20000
    at = check(placed, 4096)
    assert len(at) <= 1.002 * sum(r.length for r in placed) / 4096 + 1


def test_pieces_that_never_fit_together(spark):
    pieces = spark.range(9000).select(F.col("id").alias("uid"), F.lit(3000).cast("long").alias("length"))
    assert P.pack_pieces(pieces, 4096).select("sequence_id").distinct().count() == 9000


def test_query(spark):
    rows = queries.op1_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    text = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    one = next(r for r in rows if r.piece == 0 and r.length < 4096)
    ids = [*Tokenizer.from_file(queries.tokenizer_path()).encode(text[one.doc_id], add_special_tokens=False).ids, 1]
    assert one.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert len(check(rows, 4096)) == -(-sum(r.length for r in rows) // 4096)
