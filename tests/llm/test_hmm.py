from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import hmm as H
from millrace.llm import queries

from .conftest import MESSY


def model(k=3, classes=5, seed=0):
    rng = np.random.default_rng(seed)
    return H.HMM(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(classes), k).T)


def plain_log(m, x):
    a = m.start * m.emit[x[0]]
    log = np.log(a.sum())
    a /= a.sum()
    for w in x[1:]:
        a = (a @ m.move) * m.emit[w]
        log += np.log(a.sum())
        a /= a.sum()
    return log


def test_exact_likelihood():
    m, rng = model(), np.random.default_rng(1)
    docs = [rng.integers(0, 5, n).astype(np.uint16) for n in (1, 2, 1023, 1024, 1025, 2048, 2049, 9000)]
    assert H.log_likelihoods(m, docs) == pytest.approx([plain_log(m, d) for d in docs], rel=1e-12)
    assert H.log_likelihoods(m, docs[:1]) == pytest.approx([plain_log(m, docs[0])])


def test_baum_welch_counts_and_monotony():
    m, rng = model(), np.random.default_rng(2)
    x = rng.integers(0, 5, 6).astype(np.uint16)
    # All state paths, one by one.
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    total = 0.0
    for path in np.ndindex(*[3] * 6):
        p = m.start[path[0]] * m.emit[x[0], path[0]]
        for t in range(1, 6):
            p *= m.move[path[t - 1], path[t]] * m.emit[x[t], path[t]]
        total += p
        start[path[0]] += p
        for t in range(6):
            emit[x[t], path[t]] += p
            if t:
                move[path[t - 1], path[t]] += p
    got = H.expected_counts(m, [x])
    assert got[0] == pytest.approx(start / total) and got[1] == pytest.approx(move / total) and got[2] == pytest.approx(emit / total) and got[3] == pytest.approx(np.log(total))
    docs = [rng.integers(0, 5, n).astype(np.uint16) for n in (40, 100, 7)]
    likelihood = []
    for _ in range(6):
        *counts, log = H.expected_counts(m, docs)
        likelihood.append(log)
        m = H.HMM(counts[0] / counts[0].sum(), counts[1] / counts[1].sum(1, keepdims=True), counts[2] / counts[2].sum(0))
    assert all(b >= a - 1e-9 for a, b in zip(likelihood, likelihood[1:]))


def words(text):
    return (text or "").encode().lower().split() + [b""]


def expect(rows, train):
    c = Counter(w for (i, t) in rows if train(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    return n, sorted((str(i), len(words(t)), sum(c[w] > 0 for w in words(t)), round(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for i, t in rows)


@pytest.mark.parametrize("chunk_bytes", [50, 1 << 20])
def test_counts_on_messy_rows(messy, chunk_bytes):
    encoded, totals = H.encode_documents(messy, F.col("doc_id") % 2 == 1, chunk_bytes=chunk_bytes)
    n, want = expect(MESSY, lambda i: i is not None and i % 2 == 1)
    rows = encoded.collect()
    assert totals.tokens == n
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == want
    assert all(len(r.classes) == 2 * r.n_tokens for r in rows)


def test_expected_counts_do_not_depend_on_segments(monkeypatch):
    m, rng = model(), np.random.default_rng(6)
    docs = [rng.integers(0, 5, n).astype(np.uint16) for n in (1000, 1, 333, 64, 65)]
    monkeypatch.setattr(H, "SEGMENT", 10_000)
    whole = H.expected_counts(m, docs)
    assert whole[1].sum() == pytest.approx(sum(len(d) - 1 for d in docs)) and whole[2].sum() == pytest.approx(sum(map(len, docs)))
    for segment, cells in ((64, 1 << 18), (7, 40)):
        monkeypatch.setattr(H, "SEGMENT", segment)
        monkeypatch.setattr(H, "_CELLS", cells)
        for got, want in zip(H.expected_counts(m, docs), whole, strict=True):
            assert np.abs(np.asarray(got) - want).max() < 1e-9
        assert H.log_likelihoods(m, docs).sum() == pytest.approx(whole[3], rel=1e-12)


def test_weights_that_are_scaled_seldom_do_not_vanish(monkeypatch):
    """Class probabilities as small as they get, lanes of many lengths: the same as with a scaling at every class."""
    m, rng = model(k=4, classes=7), np.random.default_rng(8)
    m.emit[:3] *= 1e-14
    docs = [rng.integers(0, 7, n).astype(np.uint16) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 31, 32, 33, 400, 400)]
    docs.append(np.zeros(300, np.uint16))
    monkeypatch.setattr(H, "SEGMENT", 32)
    seldom = H.log_likelihoods(m, docs), H.expected_counts(m, docs)
    monkeypatch.setattr(H, "_UNSCALED", 1)
    always = H.log_likelihoods(m, docs), H.expected_counts(m, docs)
    assert seldom[0] == pytest.approx(always[0], rel=1e-12) and seldom[0] == pytest.approx([plain_log(m, d) for d in docs], rel=1e-12)
    for got, want in zip(seldom[1], always[1], strict=True):
        assert np.abs(np.asarray(got) - np.asarray(want)).max() < 1e-9
    assert seldom[1][2].sum() == pytest.approx(sum(map(len, docs))) and seldom[1][1].sum() == pytest.approx(sum(len(d) - 1 for d in docs))


def test_word_probabilities_sum_to_one(spark, messy):
    """The sum of P(word | class) over a class's words and one unknown word, and of P(class | state) over classes, is 1."""
    encoded, totals = H.encode_documents(messy, F.lit(True))
    counts = Counter(w for _, t in MESSY for w in words(t))
    assert totals.class_tokens.sum() == totals.tokens == sum(counts.values()) and totals.class_distinct.sum() == totals.distinct == len(counts)
    df = spark.createDataFrame([(w.decode(), n) for w, n in counts.items()], "word string, n long")
    of = df.select("n", H.word_class(F.col("word"), F.col("n"), totals.tokens).alias("class")).collect()
    total = np.zeros(H.N_CLASSES)
    for r in of:
        total[r["class"]] += (r.n + 1) / (totals.class_tokens[r["class"]] + totals.class_distinct[r["class"]] + 1)
    unknown = 1 / (totals.class_tokens + totals.class_distinct + 1)
    assert total + unknown == pytest.approx(np.ones(H.N_CLASSES))
    assert H.HMM.initial(totals.class_tokens).emit.sum(0) == pytest.approx(np.ones(H.STATES))


def test_scores_by_brute_force(spark, messy):
    """The whole query on a few rows: counts, classes and the forward recursion in plain Python."""
    train = lambda i: i is not None and i % 2 == 1
    encoded, totals = H.encode_documents(messy, F.col("doc_id") % 2 == 1)
    m = H.baum_welch(encoded, totals, iterations=2)
    counts = Counter(w for i, t in MESSY if train(i) for w in words(t))
    every = sorted({w for _, t in MESSY for w in words(t)})
    df = spark.createDataFrame([(w.decode(), counts[w]) for w in every], "word string, n long")
    of = {r.word.encode(): r["class"] for r in df.select("word", H.word_class(F.col("word"), F.col("n"), totals.tokens).alias("class")).collect()}
    class_total = Counter()
    for w in every:
        class_total[of[w]] += counts[w] + (counts[w] > 0)
    want = []
    for i, t in MESSY:
        own = words(t)
        word_logs = sum(np.log10((counts[w] + 1) / (class_total[of[w]] + 1)) for w in own)
        want.append((str(i), round(plain_log(m, [of[w] for w in own]) / np.log(10) + word_logs, 6)))
    rows = H.score_documents(messy, F.col("doc_id") % 2 == 1, iterations=2).collect()
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in rows) == sorted(want)


def test_no_training_rows_and_no_rows(messy, none):
    rows = H.score_documents(messy, F.lit(False), iterations=1).collect()
    assert len(rows) == len(MESSY) and {r.train_tokens for r in rows} == {0} and all(r.base_score == 0 and np.isfinite(r.score) for r in rows)
    assert H.score_documents(none, F.lit(True), iterations=1).count() == 0


def test_query_beats_the_base_on_held_out_texts(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op5_hmm_scoring(spark, sf).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    n, want = expect(texts, lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == want
    assert {r.train_tokens for r in rows} == {n}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    assert sum(r.score - r.base_score for r in held) > 0.3 * sum(r.n_tokens for r in held)
