"""Near copies of the pipeline: five words, similarity 0.8, against sets in plain Python."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as C
from millrace.llm import common
from millrace.llm import nearcopies as N
from millrace.llm import simhash as S


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    """rows: (id, text) -> the smallest id of each component of 0.8 links."""
    sets = {i: plain_set(t) for i, t in rows}
    near = {i: [j for j, y in sets.items() if x == y or (x & y and len(x & y) >= 0.8 * len(x | y))] for i, x in sets.items()}
    label = {i: i for i in sets}
    while (new := {i: min(label[j] for j in near[i]) for i in sets}) != label:
        label = new
    return set(label.values())


def copies():
    """Texts of 300 words, each with copies in which 1 to 12 words are others (similarities from 0.98 to 0.65)."""
    rng, rows = random.Random(5), []
    for k in range(30):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        rows.append((100 * k, " ".join(words)))
        for n in range(1, 13):
            other = list(words)
            for at in rng.sample(range(300), n):
                other[at] = f"x{rng.randrange(5000)}"
            rows.append((100 * k + n, " ".join(other)))
    return [*rows, (9001, None), (9002, ""), (9003, " \n"), (9004, "one two"), (9005, "ONE  two"), (9006, "one three")]


def test_stage_finds_copies_beyond_four_bits(spark):
    rows = copies()
    fps = {i: S.fingerprint(t) for i, t in rows}
    assert sum((fps[100 * k] ^ fps[100 * k + n]).bit_count() > 4 for k in range(30) for n in range(1, 6)) > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in C.near_dedup(spark, docs, "").collect()} == plain_kept(rows)


def test_messy(messy, none):
    stay = N.one_of_each(messy)
    assert stay.columns == messy.columns
    kept = [(r.doc_id, r.text) for r in stay.collect()]
    assert len(kept) == len(set(kept)) == len({frozenset(plain_set(r.text)) for r in messy.select("text").collect()})
    assert N.one_of_each(none).count() == 0


def test_no_bucket_gives_all_its_pairs(spark, monkeypatch):
    """400 near copies of a text, all in common buckets: links are proposed to pivots, not between all."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(400):
        other = list(words)
        for at in rng.sample(range(400), 4):
            other[at] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(other)))
    seen, verified = [], N._verified
    monkeypatch.setattr(N, "_verified", lambda pairs, *a: seen.append(pairs.count()) or verified(pairs, *a))
    stay = N.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id for r in stay} == plain_kept(rows)
    assert sum(seen) < 400 * 32 < 400 * 399 / 2


def test_what_is_dealt_does_not_stay(spark, monkeypatch):
    """When pairs are verified, neither all sets' rare shingles nor the covering tables are still on disk."""
    alive, verified = [], N._verified
    mark = common.written()
    monkeypatch.setattr(N, "_verified", lambda *a: alive.append([p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in common._written[mark:]]) or verified(*a))
    stay = N.one_of_each(spark.createDataFrame(copies(), "doc_id long, text string").repartition(3))
    assert alive == [["copies-rows", "copies-nodes", "copies-met", "copies-pairs"], ["copies-rows", "copies-nodes", "copies-links", "copies-more"]]
    assert {r.doc_id for r in stay.collect()} == plain_kept(copies())
    common.release(spark, mark)


def test_sketches_rule_out_no_pair_that_is_similar():
    rng = np.random.default_rng(3)
    ruled_out = 0
    for n in (1, 2, 3, 30, 256, 257, 1000, 5000):
        for share in (0.0, 0.3, 0.6, 0.8, 0.9, 1.0):
            a, more = (rng.integers(0, 1 << 64, n, np.uint64) for _ in range(2))
            b = np.unique(np.concatenate([a[: round(share * n)], more[: round((1 - share) * n * 0.7)]]))
            a = np.unique(a)
            most, own = N.most_similar(N.sketch(a), N.sketch(b)), N.similarity(a, b)
            assert own <= most <= 1 and most == N.most_similar(N.sketch(b), N.sketch(a))
            ruled_out += own < 0.6 and most < 0.8 and n >= 30
    assert ruled_out == 5 * 3  # all pairs that share 0, 0.3 or 0.6
    full = np.arange(300, dtype=np.uint64) << np.uint64(20)  # all in one cell: more than a byte holds
    assert N.sketch(full) == b"" == N.sketch(full[:0]) and N.most_similar(N.sketch(full), N.sketch(a)) == 1
    assert 8 * 300 / 20 <= len(N.sketch(rng.integers(0, 1 << 64, 300, np.uint64))) <= 300


def test_whole_sets_are_made_for_likely_pairs_only(spark, monkeypatch):
    """Texts that share a rare sentence and nothing else meet, but their sets go nowhere."""
    rows = [(k, " ".join([f"w{k}x{i}" for i in range(60)] + [f"shared{i}" for i in range(25)])) for k in range(40)]
    rows += [(100 + k, t + " end") for k, t in rows[:3]]
    made, plain = [], N._made
    monkeypatch.setattr(N, "_made", lambda docs, nodes, pairs, text_col, make: made.append((make, pairs.count())) or plain(docs, nodes, pairs, text_col, make))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in N.one_of_each(docs).collect()} == plain_kept(rows) == set(range(40))
    assert sum(n for make, n in made if make is N.sketch) >= 3 and sum(n for make, n in made if make is not N.sketch) <= 6


def test_shingles_of_one_set_are_not_dealt(spark, monkeypatch):
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(100))) for k in range(50)] + [(100, " ".join(f"w0x{i}" for i in range(99)))]
    counts, materialize = {}, N.materialize

    def counted(df, label):
        out = materialize(df, label)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(N, "materialize", counted)
    assert N.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).count() == 50
    assert 2 <= counts["copies-met"] <= 2 * 21


def test_sets_with_a_fifth_of_their_own_meet_nobody(spark, monkeypatch):
    """Passages that few documents share, however many passages there are, propose no pair where the rest differs."""
    rows = [(k, " ".join([f"w{k}x{i}" for i in range(60)] + [f"p{k % 100}x{i}" for i in range(40)])) for k in range(300)]
    rows += [(1000 + k, t + " end") for k, t in rows[:3]]
    seen, verified = [], N._verified
    monkeypatch.setattr(N, "_verified", lambda pairs, *a: seen.append(pairs.count()) or verified(pairs, *a))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in N.one_of_each(docs).collect()} == plain_kept(rows) == set(range(300))
    assert sum(seen) <= 6


def test_shared_shingles_are_counted_over_sets():
    rng = np.random.default_rng(4)
    values, nodes = rng.integers(0, 400, 3000, np.uint64), rng.integers(0, 1 << 64, 9, np.uint64)[rng.integers(0, 9, 3000)]
    values[:500] += np.uint64(1 << 60)
    pairs = set(zip(values.tolist(), nodes.tolist(), strict=True))
    counts = Counter(v for v, _ in pairs)
    got = list(zip(*(x.tolist() for x in N.shared_shingles(values, nodes)), strict=True))
    assert len(got) == len(set(got)) and set(got) == {(v, n, counts[v]) for v, n in pairs if counts[v] > 1}
    assert [len(x) for x in N.shared_shingles(values[:0], nodes[:0])] == [0, 0, 0]


@pytest.mark.parametrize("most", [1 << 23, 20])
def test_rarest_are_exact(spark, monkeypatch, most):
    """In more regions than a byte tells apart, too: what is dealt is each set's first fifth by exact counts."""
    monkeypatch.setattr(N, "REGION_SHINGLES", most)
    rows = copies()
    sets = {N.set_hash(s): s.tolist() for s in (N.shingle_set(t) for _, t in rows)}
    counts = Counter(v for s in sets.values() for v in s)
    signed = lambda x: x - (x >> 63 << 64)
    want = set()
    for node, own in sets.items():
        order = sorted(own, key=lambda v: (counts[v], signed(v)) if counts[v] > 1 else (1, 0))
        first = len(own) - int(np.ceil(0.8 * len(own) - 1e-9)) + 1 if own else 0
        want |= {(signed(v), signed(node), len(own), k) for k, v in enumerate(order[:first]) if counts[v] > 1}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    nodes = N._sets(docs, "doc_id", "text").select("node", "n").distinct()
    assert len(want) > 1000 and {tuple(r) for r in N._rare(docs, nodes, "text", 0.8).collect()} == want
