"""Language identification by a byte convolutional network, in numpy.

Texts are cut into non-overlapping windows of ``WINDOW`` bytes (the last one
padded with zeros). The network embeds bytes, runs filters of several widths
over a window, takes each filter's maximum and ends in a softmax over the
languages seen in training. A document's prediction averages the windows'
distributions, weighted by their bytes, over the whole text.

For scoring, embedding and filters are multiplied out into tables over pairs
of bytes, so that a filter of width w costs w/2 look-ups a position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, hashed_sample, materialize, within_bytes

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: The sample of labelled rows that training may use: so many rows (the same number for each language), bytes of text in
#: all, and bytes of one text.
TRAIN_DOCS = 1200
TRAIN_BYTES = 8 << 20
TRAIN_TEXT = 1 << 20
#: Bytes of text that are cut into windows at a time.
SLICE_BYTES = 1 << 20
EPOCHS = 6
UNDETERMINED = "und"
_BLOCK = 256

_LETTER = regex.compile(r"\p{L}")


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows as rows of bytes, the text each belongs to, and its bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    n = -(-sizes // WINDOW)
    flat = np.frombuffer(b"".join(t + bytes(int(k) * WINDOW - len(t)) for t, k in zip(texts, n, strict=True)), np.uint8)
    owner = np.repeat(np.arange(len(texts)), n)
    filled = np.full(len(owner), WINDOW, np.int64)
    last = np.cumsum(n)[n > 0] - 1
    filled[last] = (sizes - (n - 1) * WINDOW)[n > 0]
    return flat.reshape(-1, WINDOW), owner, filled


def _softmax(logits: np.ndarray) -> np.ndarray:
    prob = np.exp(logits - logits.max(1, keepdims=True))
    return prob / prob.sum(1, keepdims=True)


class ByteConvNet:
    def __init__(self, languages: list[str], seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"E": rng.normal(0, 0.5, (256, EMBED))}
        for w in WIDTHS:
            self.p[f"W{w}"] = rng.normal(0, np.sqrt(2 / (w * EMBED)), (w * EMBED, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p["O"] = rng.normal(0, np.sqrt(1 / (FILTERS * len(WIDTHS))), (FILTERS * len(WIDTHS), len(languages)))
        self.p["o"] = np.zeros(len(languages))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.01, seed: int = 2) -> ByteConvNet:
        """Adam on cross-entropy."""
        rng, p = np.random.default_rng(seed), self.p
        m = {k: np.zeros_like(v) for k, v in p.items()}
        v = {k: np.zeros_like(q) for k, q in p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                g = self.gradients(x[order[at : at + batch]], y[order[at : at + batch]])
                step += 1
                for k, q in p.items():
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    q -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of some windows. A filter's gradient flows through the position of its maximum."""
        p, rows = self.p, np.arange(len(x))
        emb = p["E"][x]
        pooled, patches = [], []
        for w in WIDTHS:
            view = np.lib.stride_tricks.sliding_window_view(emb, w, axis=1).transpose(0, 1, 3, 2).reshape(len(x), WINDOW - w + 1, w * EMBED)
            conv = view @ p[f"W{w}"]
            top = conv.argmax(1)
            pooled.append(np.take_along_axis(conv, top[:, None, :], 1)[:, 0] + p[f"b{w}"])
            patches.append((top, view[rows[:, None], top]))
        z = np.concatenate(pooled, 1)
        hidden = np.maximum(z, 0)
        d = _softmax(hidden @ p["O"] + p["o"])
        d[rows, y] -= 1
        d /= len(x)
        g = {"O": hidden.T @ d, "o": d.sum(0), "E": np.zeros_like(p["E"])}
        dz = (d @ p["O"].T) * (z > 0)
        for k, w in enumerate(WIDTHS):
            dw = dz[:, k * FILTERS : (k + 1) * FILTERS]
            top, patch = patches[k]
            g[f"b{w}"] = dw.sum(0)
            g[f"W{w}"] = np.einsum("nf,nfe->ef", dw, patch)
            back = (dw[:, :, None] * p[f"W{w}"].T[None]).reshape(len(x), FILTERS, w, EMBED)
            for j in range(w):
                np.add.at(g["E"], x[rows[:, None], top + j], back[:, :, j])
        return g

    def compile(self) -> ByteConvNet:
        """Tables over byte pairs (and one over bytes for an odd width) for every width."""
        self.tables = {}
        for w in WIDTHS:
            by = [(self.p["E"] @ self.p[f"W{w}"][j * EMBED : (j + 1) * EMBED]).astype(np.float32) for j in range(w)]
            pairs = [(by[j][:, None, :] + by[j + 1][None, :, :]).reshape(65536, FILTERS) for j in range(0, w - 1, 2)]
            self.tables[w] = (pairs, by[-1] if w % 2 else None)
        return self

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """A distribution over the languages for each window."""
        out = np.empty((len(x), len(self.languages)))
        for at in range(0, len(x), _BLOCK):
            b = x[at : at + _BLOCK]
            pair = b[:, :-1].astype(np.int32) * 256 + b[:, 1:]
            pooled = []
            for w in WIDTHS:
                n = WINDOW - w + 1
                pairs, odd = self.tables[w]
                conv = pairs[0][pair[:, :n]]
                for j, t in enumerate(pairs[1:], 1):
                    conv += t[pair[:, 2 * j : 2 * j + n]]
                if odd is not None:
                    conv += odd[b[:, w - 1 :]]
                pooled.append(conv.max(1) + self.p[f"b{w}"])
            out[at : at + _BLOCK] = _softmax(np.maximum(np.concatenate(pooled, 1), 0) @ self.p["O"] + self.p["o"])
        return out

    def documents(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lettered = [bool(t) and _LETTER.search(t) is not None for t in texts]
        x, owner, filled = windows_of([t.encode() if ok else b"" for t, ok in zip(texts, lettered, strict=True)])
        prob = self.probabilities(x) * filled[:, None]
        total = np.zeros((len(texts), len(self.languages)))
        np.add.at(total, owner, prob)
        total /= np.maximum(np.bincount(owner, weights=filled, minlength=len(texts)), 1)[:, None]
        best = total.argmax(1)
        return (
            [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)],
            [min(1.0, float(total[i, b])) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, lettered, strict=True))],
        )


def train_langid(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", max_docs: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES
) -> ByteConvNet | None:
    """Fit on the whole texts of a bounded sample of rows with a language; None if there are none.

    The sample: of each language as many different texts, the smallest by a
    hash, as give ``max_docs`` rows in all (one at least); of those as many,
    smallest hash first, as take their language's part of ``max_bytes``; texts
    over ``TRAIN_TEXT`` and texts without a letter are left out. All windows of
    a text take part in training.
    """
    known = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.octet_length("text") <= TRAIN_TEXT))
    n = known.select("lang").distinct().count()
    if not n:
        return None
    sample = materialize(hashed_sample(known, max(1, max_docs // n), ["text"], stratum="lang").distinct(), "langid-sample")
    rows = sorted((r.lang, r.text.encode()) for r in within_bytes(sample, "text", max_bytes, TRAIN_TEXT, by="lang", groups=n).collect())
    languages = sorted({lang for lang, _ in rows})
    x, owner, _ = windows_of([t for _, t in rows])
    return ByteConvNet(languages).fit(x, np.array([languages.index(rows[k][0]) for k in owner]))


def predict_language(docs: DataFrame, net: ByteConvNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``' id, ``lang_pred`` and ``score`` for every row.

    Defined cases: a null text, or one without a letter, is ``und`` with score
    0, and so is every row if there was nothing to train on; repeated rows get
    equal results; an empty table gives no rows. Windows are scored a block at a
    time, so a very long text adds a few times its own size; other columns are
    ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    model = docs.sparkSession.sparkContext.broadcast(net)  # parameters of a fixed architecture

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        net = net and net.compile()
        for batch in batches:
            at = 0
            for texts in byte_slices((t.as_py() for t in batch.column(1)), SLICE_BYTES):
                lang, score = net.documents(texts) if net else ([UNDETERMINED] * len(texts), [0.0] * len(texts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])
                at += len(texts)

    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
