"""Language-model scoring with a class-based hidden Markov model.

Every token belongs to a class: words of at least ``FREQUENT`` of all tokens
hash to classes of their own kind, the others to a class of their last letters,
so the classes are bounded while words are not. The model is

    P(w_t | state) = P(class(w_t) | state) * P(w_t | class(w_t)),

the second factor from smoothed counts of all training tokens. Transitions and
class emissions are trained by Baum-Welch: each partition of training documents
sums its expected counts, the sums over partitions give the next model, until
the training likelihood hardly grows. The score is the exact likelihood of a
document's whole token sequence by the scaled forward recursion. In both, a long
document's segments are run side by side as matrices and then chained, which is
the same recursion in another order.

Words and their counts never come together as one table on a machine. A chunk
(some of the documents of a partition) numbers its distinct words and names
each of them once with its count; one aggregation by word adds up the counts of
all chunks, and each chunk gets those of its own words back by a join, to encode
its documents with.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, release, slices, written

STATES = 8
#: Rounds of Baum-Welch at most; they end when a token's mean log-likelihood (natural) grows by less than ``GAIN``.
ITERATIONS = 10
GAIN = 0.005
#: Part of all tokens from which on a word is frequent.
FREQUENT = 2e-5
FREQUENT_CLASSES = 1 << 14
ENDING_CLASSES = 1 << 12
N_CLASSES = FREQUENT_CLASSES + ENDING_CLASSES + 1
ENDING_LETTERS = 3
#: Characters of text in a chunk; also at most what a partition of the input holds.
CHUNK_BYTES = 16 << 20
#: Classes of a sequence that are followed one after another; and classes that are followed at a time.
SEGMENT = 1024
_CELLS = 1 << 18
#: Documents that are followed together: the more, the nearer are the lengths of those that run side by side.
_ROWS = 10_000
#: Classes after which state weights are scaled, where only the last are wanted: a probability of a class is no less than
#: some 1e-14, so they stay far from the least number.
_UNSCALED = 4

END = ""  # the end token: no word is empty


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


# Counting and encoding


def chunk_codes(docs: DataFrame, kind: str, chunk_bytes: int) -> DataFrame:
    """Rows of two sorts. With ``code`` null, a document: ``chunk, doc_id, train, codes, rare``; otherwise a word of a
    chunk: ``chunk, code, word, n`` (its count in the chunk's training documents, 0 if it is only in others).

    Codes are a chunk's own numbers of its words, most frequent first: two bytes a token in ``codes``, 65535 standing
    for the next of the four-byte codes in ``rare``.
    """
    schema = pa.schema([("chunk", pa.int64()), ("doc_id", docs_type(docs)), ("train", pa.bool_()), ("codes", pa.binary()), ("rare", pa.binary()), ("code", pa.int32()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        chunk = (context.partitionId() if context else 0) << 32
        held: list[tuple] = []
        size, numbers = 0, _numbering()

        def flush() -> Iterator[pa.RecordBatch]:
            words = list(numbers)
            seen = np.bincount(np.concatenate([c for _, _, c in held]), minlength=len(words))
            n = np.bincount(np.concatenate([np.zeros(0, np.uint32), *(c for _, train, c in held if train)]), minlength=len(words))
            order = np.argsort(-seen, kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            for at in range(0, len(held), 500):
                some = held[at : at + 500]
                codes = [rank[c] for _, _, c in some]
                yield _batch(schema, chunk=[chunk] * len(some), doc_id=[d for d, _, _ in some], train=[t for _, t, _ in some],
                             codes=[np.minimum(c, RARE).astype("<u2").tobytes() for c in codes], rare=[c[c >= RARE].astype("<u4").tobytes() for c in codes])
            for at in range(0, len(words), 50_000):
                part = order[at : at + 50_000]
                yield _batch(schema, chunk=[chunk] * len(part), code=np.arange(at, at + len(part)), word=pa.array([words[i] for i in part], pa.binary()).cast(pa.string()), n=n[part])

        for batch in slices(batches):
            for doc, train, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = _words(text)
                words.append(b"")
                held.append((doc, train, np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)).astype(np.uint32)))
                size += len(text or "")
                if size >= chunk_bytes:
                    yield from flush()
                    held, size, numbers, chunk = [], 0, _numbering(), chunk + 1
        if held:
            yield from flush()

    return docs.mapInArrow(run, f"chunk long, doc_id {kind}, train boolean, codes binary, rare binary, code int, word string, n long")


RARE = 65535


def _numbering() -> defaultdict:
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    return numbers


def docs_type(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema["doc_id"].dataType)


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:  # noqa: ANN003
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def word_class(word: Column, count: Column, total: int) -> Column:
    frequent = F.pmod(F.xxhash64(word), F.lit(FREQUENT_CLASSES))
    ending = F.pmod(F.xxhash64(F.right(word, F.lit(ENDING_LETTERS))), F.lit(ENDING_CLASSES)) + FREQUENT_CLASSES
    return F.when(word == END, F.lit(N_CLASSES - 1)).when(count >= total * FREQUENT, frequent).otherwise(ending).cast("int")


@dataclass
class Totals:
    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_distinct: np.ndarray


_ENCODED = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("word_score", pa.float64()), ("classes", pa.binary())]


def encode_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, Totals]:
    """``doc_id, train``, token counts, base score, the words' part of the score and the class sequence (two bytes a
    token) of every row; and totals over the training tokens."""
    kind, mark = docs.schema[id_col].dataType.simpleString(), written()
    wanted = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    coded = materialize(chunk_codes(wanted, kind, chunk_bytes), "lm-codes")
    words = coded.filter("code is not null").select("chunk", "code", "word", "n")
    total = words.agg(F.sum("n")).first()[0] or 0
    counts = words.groupBy("word").agg(F.sum("n").alias("c")).select(F.col("word").alias("c_word"), "c", word_class(F.col("word"), F.col("c"), total).alias("class"))
    counts = materialize(counts, "lm-counts")  # a plain side, so that Spark may split a word that very many chunks share
    by_class = counts.filter("c > 0").groupBy("class").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()  # a row a class
    class_tokens, class_distinct = np.zeros(N_CLASSES, np.int64), np.zeros(N_CLASSES, np.int64)
    for r in by_class:
        class_tokens[r["class"]], class_distinct[r["class"]] = r["c"], r["v"]
    totals = Totals(total, int(class_distinct.sum()), class_tokens, class_distinct)
    log_base = float(np.log10(totals.tokens + totals.distinct + 1))
    log_class = docs.sparkSession.sparkContext.broadcast(np.log10(class_tokens + class_distinct + 1))

    def run(texts: pa.Table, table: pa.Table) -> pa.Table:
        code = table["code"].to_numpy()
        count, of = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        count[code], of[code] = table["c"].to_numpy(), table["class"].to_numpy()
        logs = np.log10(count + 1)
        word_logs = logs - log_class.value[of]
        rows = []
        for codes, rare in zip(texts["codes"].to_pylist(), texts["rare"].to_pylist(), strict=True):
            own = np.frombuffer(codes, "<u2").astype(np.int64)
            own[own == RARE] = np.frombuffer(rare, "<u4")
            rows.append((len(own), int((count[own] > 0).sum()), float((logs[own] - log_base).sum()), float(word_logs[own].sum()), of[own].astype("<u2").tobytes()))
        return pa.table([texts["doc_id"], texts["train"], *(pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(_ENCODED))], names=["doc_id", "train", *(n for n, _ in _ENCODED)])

    texts = coded.filter("code is null").select("chunk", "doc_id", "train", "codes", "rare")
    tables = words.join(counts, words.word == counts.c_word).select(F.col("chunk").alias("t_chunk"), "code", "c", "class")
    out = f"doc_id {kind}, train boolean, n_tokens long, n_known long, base_score double, word_score double, classes binary"
    encoded = texts.groupBy("chunk").cogroup(tables.groupBy("t_chunk")).applyInArrow(run, out)
    encoded = materialize(encoded, "lm-encoded")
    release(docs.sparkSession, mark, encoded)
    return encoded, totals


# The model


@dataclass
class HMM:
    start: np.ndarray  # (K,)
    move: np.ndarray  # (K, K)
    emit: np.ndarray  # (classes, K): P(class | state)

    @classmethod
    def initial(cls, class_tokens: np.ndarray, states: int = STATES, seed: int = 5) -> HMM:
        """States near the unigram model, each disturbed in its own way, that tend to stay."""
        rng = np.random.default_rng(seed)
        base = (class_tokens + 0.1)[:, None] * rng.uniform(0.6, 1.4, (len(class_tokens), states))
        move = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move / move.sum(1, keepdims=True), base / base.sum(0))

    def reestimate(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> HMM:
        """From expected counts, with pseudo-counts that keep every class and move possible."""
        start, move, emit = start + 0.1, move + 0.1, emit + 0.01
        return HMM(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _lanes(parts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sequences side by side, longest first, about ``_CELLS`` classes at a time: which they are, classes (time, lane),
    and how many lanes still run at each time."""
    n = np.array([len(p) for p in parts])
    order = np.argsort(-n, kind="stable")
    at = 0
    while at < len(order):
        steps = int(n[order[at]])
        ids = order[at : at + max(1, _CELLS // steps)]
        at += len(ids)
        x = np.zeros((steps, len(ids)), np.int64)
        for k, i in enumerate(ids):
            x[: n[i], k] = parts[i]
        yield ids, x, np.searchsorted(-n[ids], -np.arange(1, steps + 1), side="right")


def _forward(model: HMM, x: np.ndarray, alive: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward recursion in lanes. ``entry``: (lanes, rows, K), weights of states at the first class, for as many
    rows as are followed at once. The last state weights (each lane's sum to 1) and the log of what they were scaled by."""
    state, logs = entry.copy(), np.zeros(x.shape[1])
    rows, k = entry.shape[1:]
    ones = np.ones(rows * k)
    for t, m in enumerate(alive):
        s = state[:m] if t == 0 else (state[:m].reshape(-1, k) @ model.move).reshape(m, rows, k)
        np.multiply(s, model.emit.take(x[t, :m], axis=0)[:, None, :], out=state[:m])
        if t % _UNSCALED == _UNSCALED - 1 or t == len(alive) - 1 or alive[t + 1] < m:
            scale = state[:m].reshape(m, -1) @ ones
            state[:m] /= scale[:, None, None]
            logs[:m] += np.log(scale)
    return state, logs


class _Segments:
    """The segments of some sequences, and what enters each from the left and from the right.

    A later segment is followed from every state at once, as a K x K matrix;
    the weights of states then pass the matrices from left to right, and what
    the rest of a sequence is worth to each state from right to left. Nothing is
    cut at a border, so the sums over segments are those over whole sequences.
    """

    def __init__(self, model: HMM, docs: list[np.ndarray], backward: bool) -> None:
        k = len(model.start)
        self.parts = [d[at : at + SEGMENT] for d in docs for at in range(0, len(d), SEGMENT)]
        self.count = np.array([-(-len(d) // SEGMENT) for d in docs], np.int64)
        self.first = np.cumsum(self.count) - self.count
        n = len(self.parts)
        self.entry = np.tile(model.start, (n, 1))  # weights of states at the first class
        self.before = np.zeros((n, k))  # those at the class before
        self.after = np.ones((n, k))
        self.last, self.logs = np.zeros((n, k)), np.zeros(n)
        heads = [i for i, c in zip(self.first, self.count, strict=True) if c > 1 or not backward]
        for ids, x, alive in _lanes([self.parts[i] for i in heads]):
            own = np.array(heads)[ids]
            state, logs = _forward(model, x, alive, self.entry[own, None, :])
            self.last[own], self.logs[own] = state[:, 0], logs
        tails = [f + j for f, c in zip(self.first, self.count, strict=True) for j in range(1, c)]
        matrix = np.zeros((n if tails else 0, k, k))
        for ids, x, alive in _lanes([self.parts[i] for i in tails]):
            own = np.array(tails)[ids]
            matrix[own], self.logs[own] = _forward(model, x, alive, np.broadcast_to(model.move, (len(own), k, k)))
        for f, c in zip(self.first, self.count, strict=True):
            for i in range(f + 1, f + c):
                self.before[i] = self.last[i - 1]
                v = self.last[i - 1] @ matrix[i]
                self.logs[i] += np.log(v.sum())
                self.last[i] = v / v.sum()
                self.entry[i] = self.before[i] @ model.move
            for i in range(f + c - 1, f, -1) if backward else ():
                rest = matrix[i] @ self.after[i]
                self.after[i - 1] = rest / rest.max()


def expected_counts(model: HMM, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch's sums over some class sequences, exact however long they are."""
    k = len(model.start)
    start, move, emit, loglik = np.zeros(k), np.zeros((k, k)), np.zeros(model.emit.shape), 0.0
    back, ones = np.ascontiguousarray(model.move.T), np.ones(k)
    all_ = _Segments(model, docs, backward=True)
    begins = np.zeros(len(all_.parts), bool)
    begins[all_.first] = True
    for ids, x, alive in _lanes(all_.parts):
        steps, lanes = x.shape
        alpha, beta, scale = np.zeros((steps, lanes, k)), np.zeros((steps, lanes, k)), np.ones((steps, lanes))
        seen = model.emit.take(x, axis=0)
        for t, m in enumerate(alive):
            a = all_.entry[ids] if t == 0 else alpha[t - 1, :m] @ model.move
            a *= seen[t, :m]
            np.matmul(a, ones, out=scale[t, :m])
            np.divide(a, scale[t, :m, None], out=alpha[t, :m])
        loglik += float(np.log(scale).sum())
        seen /= scale[:, :, None]
        last = _last_steps(alive, lanes)
        final = alpha[last, np.arange(lanes)]
        beta[last, np.arange(lanes)] = all_.after[ids] / (final * all_.after[ids]).sum(1, keepdims=True)
        for t in range(steps - 1, 0, -1):
            m = alive[t]
            np.matmul(seen[t, :m] * beta[t, :m], back, out=beta[t - 1, :m])
        seen *= beta  # what follows a move, this class included; 0 where a lane has ended
        move += model.move * (alpha[:-1].reshape(-1, k).T @ seen[1:].reshape(-1, k) + all_.before[ids].T @ seen[0])
        alpha *= beta
        weights = alpha.reshape(-1, k)
        for s in range(k):
            emit[:, s] += np.bincount(x.reshape(-1), weights=weights[:, s], minlength=len(emit))
        start += alpha[0, begins[ids]].sum(0)
    return start, move, emit, loglik


def _last_steps(alive: np.ndarray, lanes: int) -> np.ndarray:
    """The last time at which each lane runs."""
    return (np.arange(lanes)[None, :] < alive[:, None]).sum(0) - 1


def log_likelihoods(model: HMM, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log of each sequence's exact probability, by the scaled forward recursion."""
    if not docs:
        return np.zeros(0)
    all_ = _Segments(model, docs, backward=False)
    return np.add.reduceat(all_.logs, all_.first)


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint16) for b in column.to_pylist()]


def baum_welch(encoded: DataFrame, totals: Totals, states: int = STATES, iterations: int = ITERATIONS) -> HMM:
    """Train on all rows with ``train``; each round sums the partitions' expected counts."""
    model, before = HMM.initial(totals.class_tokens, states), -np.inf
    training = encoded.filter("train").select("classes")
    size = states + states * states + N_CLASSES * states + 1
    for _ in range(iterations):
        now = encoded.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            total = np.zeros(size)
            for batch in batches:
                for at in range(0, batch.num_rows, _ROWS):
                    start, move, emit, loglik = expected_counts(now.value, _sequences(batch.column(0).slice(at, _ROWS)))
                    total += np.concatenate([start, move.reshape(-1), emit.reshape(-1), [loglik]])
            # Sums leave in slices, so that adding them up is spread over tasks.
            padded = np.pad(total, (0, -size % 64)).reshape(-1, 64)
            keep = np.flatnonzero(padded.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int32()), pa.array(list(padded[keep]), pa.list_(pa.float64()))], names=["slice", "sums"])

        parts = training.mapInArrow(run, "slice int, sums array<double>")
        sums = parts.groupBy("slice").agg(*(F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(64))).toPandas()
        now.unpersist()
        total = np.zeros((-(-size // 64), 64))
        if len(sums):
            total[sums["slice"].to_numpy()] = sums[[f"s{j}" for j in range(64)]].to_numpy()
        *counts, loglik = total.reshape(-1)[:size]
        counts = np.array(counts)
        model = model.reestimate(counts[:states], counts[states : states + states * states].reshape(states, states), counts[states + states * states :].reshape(-1, states))
        if loglik - before < GAIN * totals.tokens:
            break
        before = loglik
    return model


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """Train on the rows where ``train`` holds, then score every row's whole text.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``:
    base_score is the smoothed unigram log10 probability, score the hidden
    Markov model's.

    Defined cases: a null, empty or blank text is the end token alone; with no
    training rows all counts are 0 and both scores follow from the smoothing;
    repeated rows score the same; an empty table gives no rows; other columns,
    whatever their names, are ignored. A very long text is a single value and a
    chunk of its own, so a task needs some ten times its size.
    """
    encoded, totals = encode_documents(docs, train, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(baum_welch(encoded, totals, states, iterations))
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = np.concatenate([log_likelihoods(model.value, _sequences(batch.column(1).slice(at, _ROWS))) for at in range(0, batch.num_rows, _ROWS)]) if batch.num_rows else np.zeros(0)
            score = logs / np.log(10) + batch.column(2).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), batch.column(4), batch.column(5), batch.column(6), pa.array(score)], names=["doc_id", "train", "n_tokens", "n_known", "base_score", "score"])

    scored = encoded.select("doc_id", "classes", "word_score", "train", "n_tokens", "n_known", "base_score").mapInArrow(run, f"doc_id {kind}, train boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score")
