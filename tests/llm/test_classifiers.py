"""Quality and language: held-out accuracy, gradients by finite differences, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid as L
from millrace.llm import quality as Q
from millrace.llm import queries

from .conftest import MESSY

SF = "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(str(i).encode())


def test_quality_of_held_out_documents(spark):
    rows = {r.doc_id: r for r in queries.op7_quality_classifier(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (crc(i) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in rows.items())
    held = [rows[i].predicted == y for i, y in labels.items() if rows[i].held_out]
    assert len(held) > 50 and np.mean(held) >= 0.95


def test_language_of_held_out_documents(spark):
    rows = {r.doc_id: r for r in queries.op8_language_id(spark, SF).collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows.keys() == lang.keys()
    assert all(r.held_out == (crc(i) % 4 == 2) and 0 <= r.score <= 1 for i, r in rows.items())
    assert np.mean([rows[i].lang_pred == y for i, y in lang.items() if rows[i].held_out]) >= 0.97


def test_table_lookups_equal_the_convolution():
    rng = np.random.default_rng(0)
    net = L.ByteConvNet(["a", "b", "c"], seed=4)
    x = rng.integers(0, 256, (7, L.WINDOW)).astype(np.uint8)
    pooled = []
    for w in L.WIDTHS:
        emb = net.p["E"][x]
        conv = np.stack([emb[:, i : i + w].reshape(len(x), -1) @ net.p[f"W{w}"] for i in range(L.WINDOW - w + 1)], 1)
        pooled.append(conv.max(1) + net.p[f"b{w}"])
    z = np.maximum(np.concatenate(pooled, 1), 0) @ net.p["O"] + net.p["o"]
    want = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    assert net.compile().probabilities(x) == pytest.approx(want, rel=1e-4)


def test_windows_cover_whole_texts():
    texts = [b"", b"a" * L.WINDOW, b"b" * (2 * L.WINDOW + 1), b"c"]
    x, owner, filled = L.windows_of(texts)
    assert owner.tolist() == [1, 2, 2, 2, 3] and filled.tolist() == [L.WINDOW, L.WINDOW, L.WINDOW, 1, 1]
    assert b"".join(bytes(r[:f]) for r, f in zip(x, filled, strict=True)) == b"".join(texts)


def test_passages_cover_whole_texts():
    texts = [b"", b"x", b"ab " * 1000, b"!" * Q.PASSAGE]
    x, n = Q.passages_of(texts)
    assert n.tolist() == [1, 1, 3, 1] and x.shape == (6, Q.N_FEATURES) and np.isfinite(x).all()
    assert x[2, 258] > 0.9 and x[1, 258] == 0  # repetition of words


def test_mil_learns_from_one_passage_of_many():
    rng = np.random.default_rng(3)
    n = rng.integers(1, 6, 300)
    y = rng.integers(0, 2, 300).astype(float)
    x = rng.normal(0, 0.1, (n.sum(), Q.N_FEATURES)).astype(np.float32)
    starts = np.cumsum(n) - n
    for k in np.flatnonzero(y):
        x[starts[k] + rng.integers(n[k]), 5] += 3
    net = Q.AttentionMIL().fit(x, n, y)
    f = net._forward((x - net.mean) * net.scale, n)
    assert np.mean((f["score"] >= 0.5) == (y > 0.5)) > 0.97
    assert np.add.reduceat(f["a"], starts) == pytest.approx(np.ones(300))


def test_messy_quality(spark, messy, none):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1), (None, 1), (9, None), (77, 0)], "doc_id long, quality int")
    model = Q.train_quality(messy, labels)
    out = Q.score_quality(messy, model)
    assert out.columns == [*messy.columns, "quality_score"]
    rows = out.collect()
    assert len(rows) == len(MESSY) and all(0 <= r.quality_score <= 1 for r in rows)
    same = {r.quality_score for r in rows if r.doc_id == 3 and r.text.startswith("the")}
    assert len(same) == 1 and len({r.quality_score for r in rows if not r.text}) == 1
    assert Q.score_quality(none, model).count() == 0
    assert Q.train_quality(messy, labels.filter("false")) is None
    assert {r.quality_score for r in Q.score_quality(messy, None).collect()} == {0.5}


def test_messy_language(spark, messy, none):
    labelled = messy.withColumn("lang", F.when(F.col("doc_id") == 7, "en").when(F.col("doc_id") == 8, "xx"))
    net = L.train_langid(labelled)
    assert net.languages == ["en", "xx"]
    rows = L.predict_language(messy, net).collect()
    assert len(rows) == len(MESSY)
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (4, 5, 6)} == {("und", 0.0)}
    assert all(r.lang_pred in net.languages for r in rows if r.doc_id in (1, 2, 3, 7, 8))
    digits = spark.createDataFrame([(1, "12 ²! _")], "doc_id long, text string")
    assert L.predict_language(digits, net).first().lang_pred == "und"
    assert L.predict_language(none, net).count() == 0
    assert L.train_langid(labelled.filter("false")) is None
    assert {r.lang_pred for r in L.predict_language(messy, None).collect()} == {"und"}


def test_training_reads_whole_texts(spark, monkeypatch):
    start = "A plain line of good text. " * 4000  # over 100 passages
    docs = spark.createDataFrame([(1, start), (2, start + "@@@ ### " * 12000), (3, "x" * 3000)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(Q.AttentionMIL, "fit", lambda self, x, n, y: seen.append((x, n, y)) or self)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    Q.train_quality(docs, labels)
    (x, n, y), = seen
    want = {r.doc_id: Q.passages_of([r.text.encode()])[0] for r in docs.collect()}
    assert y.tolist() == [0, 1, 1] and sorted(n.tolist()) == sorted(map(len, want.values()))
    assert np.array_equal(x[: n[0]], want[2]) and n.sum() == len(x)
    Q.train_quality(docs, labels, max_bytes=len(start) + 3000)  # the text of document 2 does not fit
    assert seen[1][2].tolist() == [1, 1]


def plain_score(net, text):
    """The forward pass in loops over passages of a text."""
    p, raw = net.p, (text or "").encode()
    bag, total = np.zeros(Q.HIDDEN), 0.0
    for at in range(0, max(len(raw), 1), Q.PASSAGE):
        x = (Q.passages_of([raw[at : at + Q.PASSAGE]])[0][0] - net.mean) * net.scale
        h = np.maximum(p["W"].T @ x + p["b"], 0)
        weight = np.exp(p["w"] @ (np.tanh(p["V"].T @ h) / (1 + np.exp(-(p["U"].T @ h)))))
        bag, total = bag + weight * h, total + weight
    return 1 / (1 + np.exp(-(p["c"] @ (bag / total) + p["d"][0])))


def test_quality_scores_by_brute_force(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    net = queries.quality_model(spark, sf)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.score for r in queries.op7_quality_classifier(spark, sf).collect()}
    assert got == pytest.approx({i: plain_score(net, t) for i, t in texts.items()}, rel=1e-4, abs=1e-6)
    long = "good words here " * 2000 + "&&& " * 9000
    whole = net.scores([long, "", None])
    monkeypatch.setattr(Q, "SLICE_BYTES", 5 * Q.PASSAGE)
    assert net.scores([long, "", None]) == pytest.approx(whole, rel=1e-5) and whole[0] == pytest.approx(plain_score(net, long), rel=1e-4)


def test_passages_by_brute_force():
    rng = np.random.default_rng(2)
    text = bytes(rng.choice(np.frombuffer(b"aabBC  !\n\xc3\xa9", np.uint8), 3000))
    x, n = Q.passages_of([b"first text", text])
    for k in range(n[1]):
        cut = text[k * Q.PASSAGE : (k + 1) * Q.PASSAGE]
        words = cut.split()
        row = x[n[0] + k]
        assert row[:256] == pytest.approx(np.sqrt(np.bincount(np.frombuffer(cut, np.uint8), minlength=256) / len(cut)), abs=1e-6)
        assert row[258:262] == pytest.approx([sum(a == b for a, b in zip(words, words[lag:])) / len(words) for lag in (1, 2, 3, 5)], abs=1e-6)
        assert row[262] == pytest.approx(len(words) / len(cut), abs=1e-6)


def finite(net, loss, names, grad, rng):
    for name in names:
        flat, own = net.p[name].reshape(-1), grad[name].reshape(-1)
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False):
            was, step = flat[i], 1e-6
            flat[i] = was + step
            up = loss()
            flat[i] = was - step
            down = loss()
            flat[i] = was
            assert (up - down) / (2 * step) == pytest.approx(own[i], rel=2e-3, abs=1e-6), name


def test_quality_gradients_by_finite_differences():
    rng = np.random.default_rng(5)
    net = Q.AttentionMIL(seed=3)
    n, y, weight = np.array([1, 3, 2, 5]), np.array([0.0, 1.0, 1.0, 0.0]), np.array([1.0, 0.7, 0.7, 1.3])
    x = rng.normal(size=(n.sum(), Q.N_FEATURES))

    def loss():
        s = net._forward(x, n)["score"]
        return float(np.mean(-weight * (y * np.log(s) + (1 - y) * np.log(1 - s)))) + Q.DECAY / 2 * float(np.square(net.p["W"]).sum())

    finite(net, loss, net.p, net.gradients(x, n, y, weight), rng)


def test_language_gradients_by_finite_differences():
    rng = np.random.default_rng(6)
    net = L.ByteConvNet(["a", "b", "c"], seed=2)
    x, y = rng.integers(0, 256, (5, L.WINDOW)).astype(np.uint8), np.array([0, 2, 1, 1, 0])

    def loss():
        z = np.maximum(np.concatenate([plain_filters(net, x, w) for w in L.WIDTHS], 1), 0) @ net.p["O"] + net.p["o"]
        z -= z.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]))

    finite(net, loss, [k for k in net.p if k != "E"], net.gradients(x, y), rng)
    own, grad = net.p["E"], net.gradients(x, y)["E"]
    for b in x[0, :4]:
        was = own[b, 1]
        own[b, 1] = was + 1e-6
        up = loss()
        own[b, 1] = was - 1e-6
        down = loss()
        own[b, 1] = was
        assert (up - down) / 2e-6 == pytest.approx(grad[b, 1], rel=2e-3, abs=1e-6)


def plain_filters(net, x, w):
    emb = net.p["E"][x]
    conv = np.stack([emb[:, i : i + w].reshape(len(x), -1) @ net.p[f"W{w}"] for i in range(L.WINDOW - w + 1)], 1)
    return conv.max(1) + net.p[f"b{w}"]


def test_language_by_brute_force(spark):
    """Every window by direct convolution, averaged by bytes."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    net = L.train_langid(docs)
    rows = {r.doc_id: r for r in L.predict_language(docs, net).collect()}
    for d in docs.limit(40).collect():
        raw, total = d.text.encode(), np.zeros(len(net.languages))
        for at in range(0, len(raw), L.WINDOW):
            cut = raw[at : at + L.WINDOW]
            x = np.frombuffer(cut.ljust(L.WINDOW, b"\0"), np.uint8)[None]
            z = np.maximum(np.concatenate([plain_filters(net, x, w) for w in L.WIDTHS], 1), 0) @ net.p["O"] + net.p["o"]
            total += len(cut) * np.exp(z[0]) / np.exp(z[0]).sum()
        total /= max(len(raw), 1)
        if L._LETTER.search(d.text):
            assert rows[d.doc_id].lang_pred == net.languages[int(total.argmax())]
            assert rows[d.doc_id].score == pytest.approx(total.max(), rel=1e-3)


def test_language_learns_from_whole_texts_and_rare_languages(spark, monkeypatch):
    rows = [(i, f"word{i} is here", "en") for i in range(3000)] + [(5000, "rare " * 400, "xx"), (5001, "a " * 400 + "z " * 400, "yy")]
    seen = []
    monkeypatch.setattr(L.ByteConvNet, "fit", lambda self, x, y: seen.append((self.languages, x, y)) or self)
    L.train_langid(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), max_docs=30)
    (languages, x, y), = seen
    assert languages == ["en", "xx", "yy"] and np.bincount(y).tolist() == [10, -(-2000 // L.WINDOW), -(-1600 // L.WINDOW)]
    assert (x[y == 2] == ord("z")).any() and (x[y == 2] == ord("a")).any()


def test_samples_of_equal_and_null_rows(spark):
    from millrace.llm.common import hashed_sample

    same = spark.range(10000).select(F.lit(7).alias("k"), F.lit("same").alias("t"))
    assert hashed_sample(same, 100).count() == 100
    assert hashed_sample(same.withColumn("k", F.lit(None).cast("int")), 100).count() == 100
    assert hashed_sample(same.limit(20), 100).count() == 20 and hashed_sample(same.filter("k = 1"), 100).count() == 0
    many = spark.range(20000).select("id", F.pmod("id", F.lit(3)).alias("part"))
    first, again = (sorted(r.id for r in hashed_sample(many.repartition(n), 50).collect()) for n in (2, 5))
    assert first == again and len(first) == 50
    parts = hashed_sample(many, 40, ["id"], stratum="part").groupBy("part").count().collect()
    assert {r["count"] for r in parts} == {40} and len(parts) == 3


def test_a_very_long_text(spark):
    """50 MB of text in one row: scored in parts, in memory of the text and a part."""
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some good words, "), 3_000_000).alias("text"))
    net = Q.AttentionMIL(seed=1)
    assert 0 <= Q.score_quality(docs, net).select("quality_score").first()[0] <= 1


def test_new_column_is_not_lost(messy):
    with pytest.raises(ValueError, match="quality_score"):
        Q.score_quality(messy.withColumn("quality_score", F.lit(9)), None)
    assert Q.score_quality(messy, None, score_col="other").columns[-1] == "other"
