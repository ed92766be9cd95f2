"""Quality classification by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes over its whole text; only
the document carries a label. Each passage is described by numbers that do not
depend on a vocabulary (byte frequencies and repetition of words), encoded by a
layer, and weighed by gated attention, w . (tanh(V h) * sigmoid(U h)), softmax
over the document. The weighted passage representation gives the score. All
weights are learned from the documents' labels by back-propagation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, free_names, hashed_sample, materialize, slices, within_bytes

PASSAGE = 1024
HIDDEN = 24
ATTENTION = 12
#: The sample of labelled rows that training may use: so many rows, bytes of text in all, and bytes of one text.
TRAIN_DOCS = 4000
TRAIN_BYTES = 48 << 20
TRAIN_TEXT = 4 << 20
#: Bytes of text that are described at a time; a longer text is described in parts of so many passages.
SLICE_BYTES = 4 << 20
EPOCHS = 12
#: Small samples get more epochs, until they have had as many steps.
LEAST_STEPS = 400
DECAY = 1e-3

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MIX = np.random.default_rng(7).integers(1, 1 << 62, 65536, dtype=np.int64)
N_FEATURES = 256 + 8


def passages_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of passages of each text (one at least)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    n = np.maximum(1, -(-sizes // PASSAGE))
    flat = np.frombuffer(b"".join(texts), np.uint8)
    start = np.cumsum(sizes) - sizes
    owner = np.repeat(start - PASSAGE * (np.cumsum(n) - n), n) + PASSAGE * np.arange(n.sum())  # where passages begin
    length = np.minimum(PASSAGE, np.repeat(start + sizes, n) - owner)
    passage = np.repeat(np.arange(len(owner)), length)
    counts = np.bincount(passage * 256 + flat, minlength=len(owner) * 256).reshape(-1, 256).astype(np.float32)
    x = np.zeros((len(owner), N_FEATURES), np.float32)
    some = np.maximum(length, 1)[:, None]
    x[:, :256] = np.sqrt(counts / some)
    upper, lower = counts[:, 65:91].sum(1), counts[:, 97:123].sum(1)
    x[:, 256] = upper / np.maximum(upper + lower, 1)
    x[:, 257] = counts[:, 33:48].sum(1) / some[:, 0]
    # Words: a hash of the byte pairs of each run between blanks or passage ends.
    if len(flat):
        space = _SPACE[flat]
        edge = np.r_[True, passage[1:] != passage[:-1]]
        begins = np.flatnonzero(~space & (np.r_[True, space[:-1]] | edge))
        pair = flat.astype(np.int64)
        pair[1:] += 256 * flat[:-1].astype(np.int64)
        mixed = _MIX[pair]
        mixed[begins] = _MIX[flat[begins]]
        mixed[space] = 0
        if len(begins):
            with np.errstate(over="ignore"):
                word = np.add.reduceat(mixed, begins)
            of = passage[begins]
            words = np.bincount(of, minlength=len(owner))
            for k, lag in enumerate((1, 2, 3, 5)):
                same = (word[lag:] == word[:-lag]) & (of[lag:] == of[:-lag])
                x[:, 258 + k] = np.bincount(of[lag:][same], minlength=len(owner)) / np.maximum(words, 1)
            x[:, 262] = words / some[:, 0]
    x[:, 263] = np.log1p(length) / np.log1p(PASSAGE)
    return x, n


def _segments(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class AttentionMIL:
    def __init__(self, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        norm = lambda a, b: rng.normal(0, np.sqrt(1 / a), (a, b))
        self.p = {"W": norm(N_FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": norm(HIDDEN, ATTENTION), "U": norm(HIDDEN, ATTENTION)}
        self.p |= {"w": norm(ATTENTION, 1)[:, 0], "c": norm(HIDDEN, 1)[:, 0], "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(N_FEATURES, np.float32), np.ones(N_FEATURES, np.float32)

    def _forward(self, x: np.ndarray, n: np.ndarray) -> dict:
        p, (starts, of) = self.p, _segments(n)
        z = x @ p["W"] + p["b"]
        h = np.maximum(z, 0)
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        above = np.exp(e - np.maximum.reduceat(e, starts)[of])
        a = above / np.add.reduceat(above, starts)[of]
        bag = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"z": z, "h": h, "t": t, "s": s, "e": e, "a": a, "bag": bag, "of": of, "starts": starts, "score": _sigmoid(bag @ p["c"] + p["d"])}

    def fit(self, x: np.ndarray, n: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.005, seed: int = 2) -> AttentionMIL:
        """Adam on cross-entropy; both labels weigh the same in total."""
        self.mean, self.scale = x.mean(0), 1 / (x.std(0) + 1e-3)
        rng, p, starts = np.random.default_rng(seed), self.p, np.cumsum(n) - n
        weight = np.where(y > 0.5, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
        m = {k: np.zeros_like(v) for k, v in p.items()}
        v = {k: np.zeros_like(q) for k, q in p.items()}
        step = 0
        for _ in range(max(epochs, -(-LEAST_STEPS * batch // len(n)))):
            order = rng.permutation(len(n))
            for at in range(0, len(n), batch):
                bags = order[at : at + batch]
                rows = np.concatenate([np.arange(starts[b], starts[b] + n[b]) for b in bags])
                g = self.gradients((x[rows] - self.mean) * self.scale, n[bags], y[bags], weight[bags])
                step += 1
                for k, q in p.items():
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    q -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def gradients(self, x: np.ndarray, n: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean weighted cross-entropy of some bags plus ``DECAY / 2`` times the squared encoder weights."""
        p, f = self.p, self._forward(x, n)
        d = (f["score"] - y) * weight / len(n)
        dbag = d[:, None] * p["c"]
        da = (dbag[f["of"]] * f["h"]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["starts"])[f["of"]])
        dts = de[:, None] * p["w"]
        dt, ds = dts * f["s"] * (1 - f["t"] ** 2), dts * f["t"] * f["s"] * (1 - f["s"])
        dz = (f["a"][:, None] * dbag[f["of"]] + dt @ p["V"].T + ds @ p["U"].T) * (f["z"] > 0)
        return {
            "c": f["bag"].T @ d, "d": d.sum(keepdims=True), "w": (f["t"] * f["s"]).T @ de,
            "V": f["h"].T @ dt, "U": f["h"].T @ ds, "W": x.T @ dz + DECAY * p["W"], "b": dz.sum(0),
        }

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The score of each text. A text over ``SLICE_BYTES`` is read in parts, in memory of a part and the text."""
        out = np.zeros(len(texts))
        short = [k for k, t in enumerate(texts) if len(t or "") <= SLICE_BYTES // 4]
        if short:
            x, n = passages_of([(texts[k] or "").encode() for k in short])
            out[short] = self._forward((x - self.mean) * self.scale, n)["score"]
        for k in set(range(len(texts))).difference(short):
            out[k] = self._long(texts[k].encode())
        return out.round(12)  # sums in another order differ beyond that

    def _long(self, text: bytes) -> float:
        """The same forward pass with the softmax's sums carried from part to part (parts end where passages do)."""
        p, top, total, bag = self.p, -np.inf, 0.0, np.zeros(HIDDEN)
        step = SLICE_BYTES // PASSAGE * PASSAGE
        for at in range(0, len(text), step):
            x, n = passages_of([text[at : at + step]])
            f = self._forward((x - self.mean) * self.scale, n)
            new = max(top, f["e"].max())
            weights = np.exp(f["e"] - new)
            total, bag, top = total * np.exp(top - new) + weights.sum(), bag * np.exp(top - new) + weights @ f["h"], new
        return float(_sigmoid(bag / total @ p["c"] + p["d"])[0])


def train_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_docs: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES
) -> AttentionMIL | None:
    """Fit on the whole texts of a bounded sample of labelled rows; None if there are none.

    The sample: ``max_docs`` labels, the smallest by a hash; of their documents
    as many, smallest hash first, as take ``max_bytes`` of text together, texts
    over ``TRAIN_TEXT`` left out. A label that is repeated counts by its
    largest value; of different documents that share an id the one of the
    smallest text hash is used. Passages are described on the executors, and
    their descriptions, about as large as the texts, are what the driver gets.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(F.max(label_col).cast("double").alias("y"))
    few = F.broadcast(hashed_sample(known, max_docs, ["label_id"]))  # max_docs rows of two numbers
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(few, F.col("id") == F.col("label_id")).select("id", "text", "y")
    one = materialize(texts.groupBy("id").agg(F.min_by(F.struct("text", "y"), F.struct(F.xxhash64("text"), "text")).alias("d")).select("id", "d.text", "d.y"), "quality-sample")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 50):
            rows = [passages_of([t.encode()])[0].tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["y", "x"])

    rows = within_bytes(one, "text", max_bytes, min(max_bytes, TRAIN_TEXT)).select("y", "text").mapInArrow(describe, "y double, x binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.y, r.x))
    n = np.array([len(r.x) // (4 * N_FEATURES) for r in rows])
    x = np.empty((n.sum(), N_FEATURES), np.float32)
    y = np.array([r.y for r in rows])
    for at in np.cumsum(n)[::-1]:  # each description goes as it is copied
        own = np.frombuffer(rows.pop().x, np.float32).reshape(-1, N_FEATURES)
        x[at - len(own) : at] = own
    return AttentionMIL().fit(x, n, y)


def score_quality(docs: DataFrame, model: AttentionMIL | None, id_col: str = "doc_id", text_col: str = "text", score_col: str = "quality_score") -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1) for every row's whole text; other columns pass through.

    Defined cases: a null or empty text is one empty passage; without any
    training rows every score is 0.5; repeated rows score the same; an empty
    table gives no rows. Texts are described ``SLICE_BYTES`` at a time, so a
    very long one adds its own size and a part's. A column that the input has
    under the new one's name is refused: name another ``score_col``.
    """
    if free_names(docs, score_col) != [score_col]:
        raise ValueError(f"the input has a column {score_col}")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # parameters of a fixed architecture

    @F.pandas_udf("double")
    def score(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        net = shared.value
        if net is None:
            return pd.Series(np.full(len(texts), 0.5))
        parts = [net.scores(some) for some in byte_slices(texts, SLICE_BYTES)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(score_col, score(F.col(text_col)))
