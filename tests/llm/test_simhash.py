from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import queries
from millrace.llm import simhash as S

from .conftest import MESSY


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """rows: (id, fingerprint) -> smallest id reachable, for each row."""
    label = [i if i is not None else float("inf") for i, _ in rows]
    near = [[j for j, (_, g) in enumerate(rows) if (f ^ g).bit_count() <= 4] for _, f in rows]
    while True:
        new = [min(label[j] for j in n) for n in near]
        if new == label:
            return [None if x == float("inf") else x for x in label]
        label = new


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4), st.integers(0, 50))
def test_every_near_pair_collides(fp, flips, seed):
    other = fp ^ sum(1 << b for b in flips)
    masks = S.covering_masks(4, seed)
    assert len(masks) == 31 and any((fp ^ other) & m == 0 for m in masks)


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "one Two three", "a b c d", "É À ñ 日本 x y z", "a b c d " * 300, *(t for _, t in MESSY)])
def test_fingerprint(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


def run(spark, rows, bucket):
    got = S.links(spark.createDataFrame([(f,) for f in rows], "fp long"), 4, bucket)
    labels = spark.createDataFrame([(f, i) for i, f in enumerate(rows)], "node long, label int")
    return {r.node: r.label for r in S.components(got, labels).collect()}


@pytest.mark.parametrize("bucket", [7, 2000])
def test_links_and_components(spark, bucket):
    rng = random.Random(bucket)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    fps = set(seeds)
    for s in seeds:  # chains and clouds around each seed
        for _ in range(25):
            s ^= sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 3)))
            fps.add(s)
        for _ in range(25):
            fps.add(s ^ (1 << rng.randrange(64)))
    signed = [int(np.array([f], np.uint64).view(np.int64)[0]) for f in sorted(fps)]
    want = plain_components([(i, f & (1 << 64) - 1) for i, f in enumerate(signed)])
    assert run(spark, signed, bucket) == dict(zip(signed, want, strict=True))


def test_messy(messy):
    got = S.near_duplicates(messy).collect()
    rows = [(i, plain_fingerprint(t)) for i, t in MESSY]
    want = sorted(map(str, zip((i for i, _ in rows), (f for _, f in rows), plain_components(rows), strict=True)))
    assert sorted(str((r.doc_id, r.fp & (1 << 64) - 1, r.component_id)) for r in got) == want
    stay = S.one_of_each(messy)
    assert stay.columns == messy.columns
    kept = [(r.doc_id, r.text) for r in stay.collect()]
    groups = plain_components([(k, f) for k, (_, f) in enumerate(rows)])  # an id with two texts may name two groups
    assert len(kept) == len(set(kept)) == len(set(groups))
    assert {i for i, _ in kept} == set(plain_components(rows))


def test_rows_without_any_id(spark):
    rows = [(None, "one two three four five"), (None, "one two three four five"), (None, "quite another text than that one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert S.one_of_each(df).count() == 2
    assert {r.component_id for r in S.near_duplicates(df).collect()} == {None}


def test_empty(none):
    assert S.near_duplicates(none).count() == 0 and S.one_of_each(none).count() == 0


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(d.doc_id, plain_fingerprint(d.text)) for d in docs]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: (f"{f:016x}", c) for (i, f), c in zip(rows, plain_components(rows), strict=True)}


def test_hex(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,)], "fp long").select(S.hex_fingerprint(F.col("fp")).alias("h"))
    assert [r.h for r in df.collect()] == ["f" * 16, "0" * 16, "0" * 15 + "1"]
