"""Tokenisation of whole documents into pieces of at most a sequence's length.

BPE of a pre-token does not depend on its neighbours, so each distinct
pre-token is encoded once per worker process and then looked up. The pattern
below splits as the tokenizer's own pattern does for texts of Latin letters
(up to U+017F, where NFC changes nothing); any other text, and any that holds
the string of a special token, goes through the tokenizer as a whole.

A new pre-token is merged by rank: the byte FF, which UTF-8 never holds, stands
for the end of a word, and a token's rank is its id, which grows with the order
of the merges. Merging by rank joins any neighbours that form a token, merging
by pairs only those of its merge. The two agree but for tokens that their own
string's merges do not lead to; ``unreachable`` finds those, and they are left
out of the ranks.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LETTER = "a-zªµºß-öø-ÿĀ-ſ"
_DIGIT = "0-9²³¹¼½¾"
_PRETOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^\s{_LETTER}{_DIGIT}]+")
_OTHER = re.compile(r"[^\n\t\r -~\xa1-ſ]|<\|(?:start|end)oftext\|>")
#: Fixed value: the splitting pattern that the fast path reproduces.
_KNOWN_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_END = b"\xff"
MEMO_WORDS = 300_000
GROUP_CHARS = 1 << 20

_workers: dict[int, MemoEncoder] = {}


def _merges(model: dict) -> list[tuple[str, str]]:
    return [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]


@lru_cache(4)
def unreachable(spec: str) -> frozenset[str]:
    """Tokens that merging by pairs does not make of their own string."""
    model = json.loads(spec)["model"]
    order = {m: k for k, m in enumerate(_merges(model))}
    suffix, never, out = model["end_of_word_suffix"], len(order), []
    for a, b in order:
        token = a + b
        ends = token.endswith(suffix)
        parts = list(token[: -len(suffix)] if ends else token)
        if ends:
            parts[-1] += suffix
        while len(parts) > 1:
            ranks = [order.get(p, never) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == never:
                out.append(token)
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return frozenset(out)


def byte_ranks(spec: str, without: frozenset[str]) -> dict[bytes, int] | None:
    """Tokens as bytes with their ids as ranks; None if ids do not follow the order of the merges."""
    model = json.loads(spec)["model"]
    vocab = model["vocab"]
    made = [vocab[a + b] for a, b in _merges(model)]
    if any(x >= y for x, y in zip(made, made[1:])) or made and min(made) < 512:
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    suffix, ranks = model["end_of_word_suffix"], {}
    for token, i in vocab.items():
        ends = token.endswith(suffix)
        chars = token[: -len(suffix)] if ends else token
        if token not in without and all(c in byte_of for c in chars) and not (chars.startswith("<|") and len(chars) > 2):
            ranks[bytes(byte_of[c] for c in chars) + _END * ends] = i
    return ranks


class _Memo(dict):
    def __init__(self, ranks: dict[bytes, int]) -> None:
        import tiktoken

        super().__init__()
        self.one = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = array("I", self.one(word.encode() + _END)).tobytes()
        return ids


class MemoEncoder:
    """ids of a text as little-endian unsigned 32-bit bytes."""

    def __init__(self, spec: str, without: frozenset[str]) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        known = json.dumps(_KNOWN_PATTERN)[1:-1] in spec and all(f'"{x}"' in spec for x in ("NFC", "Lowercase", "end_of_word_suffix"))
        ranks = byte_ranks(spec, without) if known else None
        self.memo = _Memo(ranks) if ranks else None

    def encode(self, texts: list[str]) -> list[bytes]:
        memo = self.memo
        if memo is None:
            return [self._whole(t) for t in texts]
        if len(memo) > MEMO_WORDS:
            memo.clear()
        get = memo.__getitem__
        return [self._whole(t) if _OTHER.search(t) else b"".join(map(get, _PRETOKEN.findall(t.lower()))) for t in texts]

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def encoder(spec: str, without: frozenset[str]) -> MemoEncoder:
    """One encoder per worker process; its memo serves all tasks that run there."""
    key = hash(spec)
    if key not in _workers:
        _workers.clear()
        _workers[key] = MemoEncoder(spec, without)
    return _workers[key]


def groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of a batch's texts of about ``GROUP_CHARS`` characters; nulls are empty."""
    start, held, size = 0, [], 0
    for k, text in enumerate(batch.column(column).to_pylist()):
        held.append(text or "")
        size += len(held[-1])
        if size >= GROUP_CHARS:
            yield start, held
            start, held, size = k + 1, [], 0
    if held:
        yield start, held


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids`` for every row's ids followed by ``end_id``.

    Only documents longer than ``max_tokens`` are cut, into pieces of that many
    ids; ``ids`` holds them as little-endian unsigned 32-bit numbers. A null or
    empty text gives one piece that is the end id alone.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((spec, unreachable(spec)))  # a vocabulary: its size does not depend on the corpus
    kind = docs.schema[id_col].dataType.simpleString()
    end, step = array("I", [end_id]).tobytes(), 4 * max_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(*shared.value)
        for batch in batches:
            for first, texts in groups(batch, 1):
                row, piece, start, length, ids = [], [], [], [], []
                for k, packed in enumerate(enc.encode(texts)):
                    packed += end
                    for p, at in enumerate(range(0, len(packed), step)):
                        cut = packed[at : at + step]
                        row.append(first + k)
                        piece.append(p)
                        start.append(at // 4)
                        length.append(len(cut) // 4)
                        ids.append(cut)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")
