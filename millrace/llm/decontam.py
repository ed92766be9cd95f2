"""Benchmark decontamination by latent semantic retrieval.

Passages of the corpus and of the benchmark are TF-IDF vectors over the
benchmark's vocabulary, with document frequencies counted over every text. A
randomised SVD of the passages, distributed over the partitions, gives a latent
space of ``LATENT`` dimensions:

1. Z = A' A G for a random matrix G; each partition sums x (x' G) over its
   passages x, the sums meet by slices;
2. Q = qr(Z), and M = (A Q)' (A Q), again a sum over partitions, p x p;
3. the eigenvectors of M turn Q into the leading right singular vectors of A.

There each direction is divided by the root of its eigenvalue, so that what the
whole corpus says (its function words) does not drown what few passages say.
A passage of a document is a candidate for each benchmark passage of cosine
``COSINE`` or more, and, since words around a short item turn the passage away
from it, for each on which its projection has ``CONTAINED`` of that passage's
length. Passages whose words weigh less than ``ENERGY`` of the
lightest benchmark passage cannot hold the most of any and are not looked up. Candidates are verified on the words around them: the
longest common subsequence with the whole item must cover ``SURE`` of its words,
or ``LIKELY`` of them and of its answer, the item's last sentence, so that a
paraphrase which keeps the answer is caught and a text that only shares the
phrasing is not.

Texts are read once: each becomes a row of vocabulary codes, two bytes a word,
and all passes read those. The benchmark is taken in blocks of ``BLOCK_BYTES``,
so what every task holds (a block's words, a V x p matrix) is bounded however
large the benchmark is.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, materialize, slices, text_hash
from .words import FOLD, longest_common_subsequence

PASSAGE = 32
STEP = 16
LATENT = 128
OVERSAMPLE = 8
COSINE = 0.35
CONTAINED = 0.4
#: Part of a benchmark passage's squared weights that a passage must hold.
ENERGY = 0.4
SURE = 0.75
LIKELY = 0.6
#: Part of a benchmark passage's words that one window must hold for LIKELY of the item to be around.
IN_WINDOW = 0.45
#: Items of fewer words have no passage worth the name: they are found as they are written, or not.
LEAST_WORDS = 6
BLOCK_BYTES = 4 << 20
_WINDOWS = 2048
_HEAD = 4


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of non-ASCII characters, in lower case."""
    return (text or "").lower().encode().translate(FOLD).split()


#: Letters of scripts that are written without blanks, and their punctuation: Thai, Lao, Burmese, Khmer, kana, Han, full-width forms.
_DENSE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u31f0-\u31ff\u3400-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff"
_dense = re.compile(f"[{_DENSE}]").match
_dense_blank = re.compile(f"(?<=[{_DENSE}]) | (?=[{_DENSE}])")


def written(text: str | None) -> str:
    """The words between single blanks, without blanks beside letters of scripts that have none."""
    return _dense_blank.sub("", " ".join(w.decode() for w in words_of(text)))


def _bound(inner: str, outer: str) -> bool:
    """Whether what ends in ``inner`` may end before ``outer``: not within a word."""
    return not outer or bool(_dense(inner) or _dense(outer)) or not (outer.isalnum() or unicodedata.category(outer)[0] == "M")


def find_written(item: str, text: str) -> int:
    """Where ``item`` stands in ``text`` as whole words, or -1; both as :func:`written`."""
    at = text.find(item)
    while at >= 0:
        end = at + len(item)
        if _bound(item[0], text[at - 1 : at] if at else "") and _bound(item[-1], text[end : end + 1]):
            return at
        at = text.find(item, at + 1)
    return -1


@dataclass
class Item:
    id: int
    codes: list[int]
    answer: list[int]


@dataclass
class Benchmark:
    """A block of items with their passages (starts and codes); ``short`` are those under ``LEAST_WORDS`` words."""

    vocab: dict[bytes, int] = field(default_factory=dict)
    items: list[Item] = field(default_factory=list)
    short: list[tuple[int, str]] = field(default_factory=list)

    @classmethod
    def build(cls, rows: list[tuple[int, str]]) -> Benchmark:
        out = cls()
        code = lambda w: out.vocab.setdefault(w, len(out.vocab))
        for item_id, text in sorted(set(rows)):
            words = words_of(text)
            if len(words) < LEAST_WORDS:
                if words:
                    out.short.append((item_id, written(text)))
                continue
            codes = [code(w) for w in words]
            sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if words_of(s)]
            answer = [code(w) for w in words_of(sentences[-1])] if sentences else []
            out.items.append(Item(item_id, codes, answer))
        return out

    @property
    def size(self) -> int:
        return len(self.vocab)

    def passages(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passages, PASSAGE) codes, padded with ``size``; the item of each and where in it the passage starts."""
        rows, owner, start = [], [], []
        for k, item in enumerate(self.items):
            for at in range(0, max(1, len(item.codes) - PASSAGE + STEP), STEP):
                cut = item.codes[at : at + PASSAGE]
                rows.append(cut + [self.size] * (PASSAGE - len(cut)))
                owner.append(k)
                start.append(at)
        return np.array(rows, np.int64).reshape(-1, PASSAGE), np.array(owner, np.int64), np.array(start, np.int64)


    def members(self) -> np.ndarray:
        """Item number times (vocabulary + 1) plus word, of every word of every item, sorted."""
        return np.unique(np.concatenate([k * (self.size + 1) + np.array(item.codes, np.int64) for k, item in enumerate(self.items)]))


def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of ``wanted`` are in the sorted ``keys``."""
    return keys[np.minimum(keys.searchsorted(wanted), len(keys) - 1)] == wanted


def _windows(codes: np.ndarray, none: int) -> np.ndarray:
    """(windows, PASSAGE) codes at every ``STEP``-th word, padded with ``none``."""
    n = max(1, -(-max(len(codes) - (PASSAGE - STEP), 1) // STEP))
    padded = np.full((n - 1) * STEP + PASSAGE, none, np.int64)
    padded[: len(codes)] = codes[: len(padded)]
    return np.lib.stride_tricks.sliding_window_view(padded, PASSAGE)[::STEP]


def _energy(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Squared TF-IDF weights of each row's words."""
    return np.square(idf)[rows].sum(1)


def _project(rows: np.ndarray, weighted: np.ndarray) -> np.ndarray:
    """TF-IDF rows times a matrix: ``weighted`` holds idf times the matrix, and a row of zeros for padding."""
    half = PASSAGE // 2
    out = np.empty((len(rows), weighted.shape[1]), weighted.dtype)
    for at in range(0, len(rows), 256):
        part = rows[at : at + 256]
        out[at : at + 256] = weighted[part[:, :half]].sum(1) + weighted[part[:, half:]].sum(1)
    return out


def _unpack(column: pa.Array, dtype: str) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype) for b in column.to_pylist()]


def _code_type(size: int) -> str:
    return "<u2" if size < 65535 else "<u4"


def encode_texts(docs: DataFrame, bench: Benchmark, kind: str) -> DataFrame:
    """``doc_id, tid, codes`` of the texts that hold any word of the benchmark; other words are ``bench.size``."""
    shared, dtype, none = docs.sparkSession.sparkContext.broadcast(bench.vocab), _code_type(bench.size), bench.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in slices(batches):
            keep, codes = [], []
            for k, text in enumerate(batch.column(2).to_pylist()):
                words = words_of(text)
                own = np.fromiter(map(get, words, repeat(none)), np.int64, len(words))
                if len(own) and own.min() < none:
                    keep.append(k)
                    codes.append(own.astype(dtype).tobytes())
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(codes, pa.binary())], names=["doc_id", "tid", "codes"])

    return docs.mapInArrow(run, f"doc_id {kind}, tid long, codes binary")


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of vectors that each partition gave in slices of 64."""
    sums = parts.groupBy("slice").agg(*(F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(64))).toPandas()
    total = np.zeros((-(-size // 64), 64))
    if len(sums):
        total[sums["slice"].to_numpy()] = sums[[f"s{j}" for j in range(64)]].to_numpy()
    return total.reshape(-1)[:size]


def _slices(total: np.ndarray) -> pa.RecordBatch:
    padded = np.pad(total.reshape(-1), (0, -total.size % 64)).reshape(-1, 64)
    keep = np.flatnonzero(padded.any(1))
    return pa.RecordBatch.from_arrays([pa.array(keep, pa.int32()), pa.array(list(padded[keep]), pa.list_(pa.float64()))], names=["slice", "sums"])


_SLICES = "slice int, sums array<double>"


def document_frequencies(coded: DataFrame, bench: Benchmark) -> np.ndarray:
    dtype, size = _code_type(bench.size), bench.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size + 1)
        seen = np.zeros(size + 1, bool)
        for batch in batches:
            for codes in _unpack(batch.column(0), dtype):
                seen[:] = False
                seen[codes] = True
                df += seen
        yield _slices(df[:size])

    return _summed(coded.select("codes").mapInArrow(run, _SLICES), size)


@dataclass
class Space:
    """The latent space: ``idf`` (0 for words outside), the least energy of a passage worth a look, and the basis."""

    idf: np.ndarray
    least: float
    basis: np.ndarray  # (V + 1, p)

    def weighted(self) -> np.ndarray:
        return (self.idf[:, None] * self.basis).astype(np.float32)


def _passing(batch: pa.RecordBatch, column: int, space: Space, dtype: str, every: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Windows whose energy reaches the least: the document's row, the window's number, its codes, its energy."""
    none = len(space.idf) - 1
    held: list[tuple[int, int, np.ndarray]] = []  # a document's row, the number of its first window here, windows

    def flush() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        rows = np.concatenate([w for _, _, w in held])
        energy = _energy(rows, space.idf)
        good = np.flatnonzero(energy >= space.least)
        if len(good):
            of = np.repeat([d for d, _, _ in held], [len(w) for _, _, w in held])
            number = np.concatenate([(first + np.arange(len(w))) * every for _, first, w in held])
            yield of[good], number[good], rows[good], energy[good]

    size = 0
    for k, codes in enumerate(_unpack(batch.column(column), dtype)):
        windows = _windows(codes, none)[::every]
        for at in range(0, len(windows), _WINDOWS):
            held.append((k, at, windows[at : at + _WINDOWS]))
            size += len(held[-1][2])
            if size >= _WINDOWS:
                yield from flush()
                held, size = [], 0
    if held:
        yield from flush()


def latent_space(coded: DataFrame, bench: Benchmark, n_docs: int, latent: int = LATENT, seed: int = 9) -> Space:
    """Randomised SVD over the corpus's passages (every second, so without overlap) and the benchmark's own, each
    scaled to unit energy."""
    spark, size, dtype = coded.sparkSession, bench.size, _code_type(bench.size)
    idf = np.append(np.log((n_docs + 1) / (document_frequencies(coded, bench) + 1)) + 0.05, 0.0)
    own, _, _ = bench.passages()
    own_energy = _energy(own, idf)
    least = ENERGY * float(own_energy.min())
    p = max(1, min(latent + OVERSAMPLE, size))
    first = np.vstack([np.random.default_rng(seed).normal(size=(size, p)), np.zeros((1, p))])

    def both(space: Space, rows: np.ndarray, energy: np.ndarray) -> np.ndarray:
        """Sum of x (x' G) over unit rows x, as (V, p)."""
        y = (_project(rows, space.weighted()) / energy[:, None]).astype(np.float32)
        out = np.zeros((size + 1, p))
        for at in range(0, len(rows), 256):
            some = rows[at : at + 256]
            words, inside = np.unique(some, return_inverse=True)
            counts = np.bincount(np.repeat(np.arange(len(some)), PASSAGE) * len(words) + inside.reshape(-1), minlength=len(some) * len(words))
            out[words] += counts.reshape(len(some), -1).T.astype(np.float32) @ y[at : at + 256]
        return out[:size] * space.idf[:size, None]

    def gram(space: Space, rows: np.ndarray, energy: np.ndarray) -> np.ndarray:
        y = (_project(rows, space.weighted()) / np.sqrt(energy)[:, None]).astype(np.float64)
        return y.T @ y

    def over_all(space: Space, f, shape: tuple[int, int]) -> np.ndarray:  # noqa: ANN001
        now = spark.sparkContext.broadcast(space)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                for _, _, rows, energy in _passing(batch, 0, now.value, dtype, every=2):
                    total += f(now.value, rows, energy)
            yield _slices(total)

        corpus = _summed(coded.select("codes").mapInArrow(run, _SLICES), shape[0] * shape[1]).reshape(shape)
        return corpus + f(space, own, own_energy)

    z = over_all(Space(idf, least, first), both, (size, p))
    q = np.vstack([np.linalg.qr(z)[0], np.zeros((1, min(p, size)))])
    values, vectors = np.linalg.eigh(over_all(Space(idf, least, q), gram, (p, p)))
    leading = np.argsort(-values)[:latent]
    return Space(idf, least, q @ vectors[:, leading] / np.sqrt(np.maximum(values[leading], 1e-6 * max(values.max(), 1e-12))))


_HITS = [("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64()), ("answer", pa.float64())]


def _hit_batch(batch: pa.RecordBatch, rows: pa.Array, hits: list[tuple]) -> pa.RecordBatch:
    """``hits`` beside the id and the text hash of the ``rows`` they are in."""
    found = [pa.array([h[n] for h in hits], kind) for n, (_, kind) in enumerate(_HITS)]
    return pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *found], names=["doc_id", "tid", *(n for n, _ in _HITS)])


def _verify(codes: np.ndarray, at: int, item: Item) -> tuple[int, float, float]:
    """Where the common subsequence may start, and how much of the item and of its answer the words from there hold."""
    slack = STEP + len(item.codes) // 4  # the item may start up to STEP - 1 words after the window
    low = max(0, at - slack)
    region = codes[low : at + len(item.codes) + slack].tolist()
    ratio = longest_common_subsequence(item.codes, region) / len(item.codes)
    answer = longest_common_subsequence(item.answer, region) / len(item.answer) if item.answer else ratio
    return max(0, at), ratio, answer


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Documents that hold a benchmark item: ``doc_id, tid`` (a hash of the text), ``item_id, start_word, n_words,
    cosine, lcs, answer``, one row per document and item.

    Words are as in :func:`words_of`. ``start_word`` is about where the item starts, ``lcs`` the part
    of the item's words in common and in order, ``answer`` the same for its last
    sentence.

    Items under ``LEAST_WORDS`` words are found where a document has all of them
    in sequence as whole words (in scripts without blanks, character by
    character); ``cosine``, ``lcs`` and ``answer`` are then 1.

    Defined cases: a null or empty text holds nothing; null and empty items and
    those without a letter or digit are skipped; repeated rows are found each
    for itself, a repeated item counts by its id; without items, or without
    documents, there are no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.select(F.col(id_col).alias("doc_id"), text_hash(F.col(text_col)).alias("tid"), F.col(text_col).alias("text"))
    items = benchmark.filter(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull()).select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_docs, n_blocks = docs.count(), max(1, -(-size // BLOCK_BYTES))
    found = None
    for k in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == k).collect()  # about BLOCK_BYTES
        bench = Benchmark.build([(r.id, r.text) for r in rows])
        if n_docs:
            parts = [_search(wanted, bench, n_docs, kind)] if bench.items else []
            parts += [_search_short(wanted, bench, kind)] if bench.short else []
            for hits in parts:
                found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], f"doc_id {kind}, tid long, item_id long, start_word long, n_words long, cosine double, lcs double, answer double")
    return found


def _search(docs: DataFrame, bench: Benchmark, n_docs: int, kind: str) -> DataFrame:
    coded = materialize(encode_texts(docs, bench, kind), "decontam-codes")
    space = latent_space(coded, bench, n_docs)
    shared, dtype = docs.sparkSession.sparkContext.broadcast((bench, space)), _code_type(bench.size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench, space = shared.value
        own, owner, start = bench.passages()
        weighted = space.weighted()
        unit = lambda y: y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)
        target = _project(own, weighted)
        length = np.maximum(np.linalg.norm(target, axis=1), 1e-9)
        target = unit(target).T
        member = bench.members()
        few = IN_WINDOW * (own < bench.size).sum(1)
        squares, own_energy = np.square(space.idf), _energy(own, space.idf)
        for batch in slices(batches, 2000):
            best: dict[tuple[int, int], tuple] = {}
            codes = _unpack(batch.column(2), dtype)
            for of, number, rows, _ in _passing(batch, 2, space, dtype):
                latent = _project(rows, weighted)
                spread = np.linalg.norm(latent, axis=1, keepdims=True)
                latent /= np.maximum(spread, 1e-9)
                for low in range(0, len(rows), 512):
                    cosine = latent[low : low + 512] @ target
                    w, b = np.nonzero(cosine >= np.minimum(COSINE, CONTAINED * length / spread[low : low + 512]))
                    # Words of the window that the item holds: an upper bound on what is in common.
                    held = _among(member, owner[b][:, None] * (bench.size + 1) + rows[low + w])
                    good = np.flatnonzero(held.sum(1) >= few[b])
                    w, b, held = w[good], b[good], held[good]
                    good = (held * squares[rows[low + w]]).sum(1) >= ENERGY * own_energy[b]
                    for i, j in zip(w[good].tolist(), b[good].tolist(), strict=True):
                        doc, item = int(of[low + i]), bench.items[owner[j]]
                        so_far = best[doc, item.id][3] if (doc, item.id) in best else 0.0
                        if so_far < 1:
                            at, ratio, answer = _verify(codes[doc], int(number[low + i]) * STEP - int(start[j]), item)
                            if ratio > so_far and (ratio >= SURE or ratio >= LIKELY and answer >= LIKELY):
                                best[doc, item.id] = (at, len(item.codes), float(cosine[i, j]), ratio, answer)
            docs_ = [d for d, _ in best]
            hits = [(item_id, *found) for (_, item_id), found in best.items()]
            rows_ = pa.array(docs_, pa.int64())
            yield _hit_batch(batch, rows_, hits)

    return coded.mapInArrow(run, f"doc_id {kind}, tid long, item_id long, start_word long, n_words long, cosine double, lcs double, answer double")


def _search_short(docs: DataFrame, bench: Benchmark, kind: str) -> DataFrame:
    """Hits of the short items. Those whose first ``_HEAD`` characters a text has are looked for in it."""
    shared = docs.sparkSession.sparkContext.broadcast(bench.short)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: dict[str, list[tuple[int, str]]] = defaultdict(list)
        for item_id, item in shared.value:
            heads[item[:_HEAD]].append((item_id, item))
        sizes = sorted({len(h) for h in heads})
        for batch in slices(batches):
            rows, hits = [], []
            for k, text in enumerate(batch.column(2).to_pylist()):
                own, seen = written(text), {}
                for size in sizes:
                    for head in heads.keys() & {own[i : i + size] for i in range(len(own) - size + 1)}:
                        for item_id, item in heads[head]:
                            at = -1 if item_id in seen else find_written(item, own)
                            if at >= 0:
                                seen[item_id] = (item_id, len(own[: at + 1].split()) - 1, len(item.split()), 1.0, 1.0, 1.0)
                rows += [k] * len(seen)
                hits += seen.values()
            taken = pa.array(rows, pa.int64())
            yield _hit_batch(batch, taken, hits)

    return docs.mapInArrow(run, f"doc_id {kind}, tid long, item_id long, start_word long, n_words long, cosine double, lcs double, answer double")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, unchanged."""
    own_id, own_tid = free_names(docs, "hit_id", "hit_tid")
    hits = contaminated(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(own_id), F.col("tid").alias(own_tid)).distinct()
    hits = materialize(hits, "decontam-hits")
    return docs.join(hits, F.col(id_col).eqNullSafe(F.col(own_id)) & (text_hash(F.col(text_col)) == F.col(own_tid)), "left_anti")
