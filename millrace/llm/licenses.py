"""Licence scans: a positional index of rare licence words.

The words of the templates (whole licence texts and the notices below) are
weighed by their document frequency in the scanned corpus (one counting pass
over every text). Each template is then indexed by its rarest words: postings of
(template, position in the template). A file is tokenised once; its licence
words of highest IDF are looked up, and postings are intersected by relative
position (word position in the file minus position in the template): hits of a
template whose relative positions agree, but for a quarter of its length that
words put in or left out may shift them, are one place. A place that enough
different rare words vote for is verified: the template's key phrases must stand
there word for word, and its score is the part of its words found there in
order.

The index and the frequencies cover the templates' own vocabulary, some hundreds
of words, so what every executor receives does not grow with the corpus.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .license_texts import TEXTS
from .words import FOLD, longest_common_subsequence

#: Fixed values: (label, notice, key phrases that must stand in place).
NOTICES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted", "free of charge"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    ("apache", "you may not use this file except in compliance with the license", ["except in compliance with the license"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["under the terms of the gnu general public license"]),
    ("lgpl", "under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license", ["gnu affero general public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nc", "creative commons attribution noncommercial", ["creative commons attribution noncommercial"]),
    ("cc-by-sa", "creative commons attribution sharealike", ["creative commons attribution sharealike"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["redistribution and use in source and binary forms"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee is hereby granted"]),
    ("reserved", "all rights reserved", ["all rights reserved"]),
]
#: Phrases that count as base evidence, and their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

TEMPLATES = [*NOTICES, *TEXTS]

#: Rare words that index a template: so many, or one in ``WORDS_PER_ANCHOR`` of its words if that is more.
ANCHORS = 4
WORDS_PER_ANCHOR = 12
MIN_SCORE = 0.6

def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """Number of texts, and of those that hold each licence word."""
    vocabulary = frozenset(w for _, text, _ in TEMPLATES for w in words_of(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                df.update(vocabulary.intersection(words_of(text)))
            df[b""] += batch.num_rows
        yield pa.RecordBatch.from_pydict({"word": [w.decode() for w in df], "df": list(df.values())}, schema=pa.schema([("word", pa.string()), ("df", pa.int64())]))

    rows = docs.select(text_col).mapInArrow(count, "word string, df long").groupBy("word").agg(F.sum("df").alias("df")).collect()
    df = {r.word.encode(): r.df for r in rows}  # a row for each word of the notices at most
    return df.pop(b"", 0), df


def build_index(n_docs: int, df: dict[bytes, int]) -> tuple[dict[bytes, float], dict[bytes, list[tuple[int, int]]]]:
    """IDF of the licence words; postings of each template's rarest words."""
    templates = [words_of(text) for _, text, _ in TEMPLATES]
    idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) for words in templates for w in words}
    postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    for k, words in enumerate(templates):
        rarest = sorted(range(len(words)), key=lambda i: (-idf[words[i]], words[i], i))[: max(ANCHORS, len(words) // WORDS_PER_ANCHOR)]
        for i in rarest:
            postings[words[i]].append((k, i))
    return idf, dict(postings)


def _stands(phrase: list[bytes], words: list[bytes]) -> bool:
    return any(words[i : i + len(phrase)] == phrase for i, w in enumerate(words) if w == phrase[0])


class Scanner:
    def __init__(self, idf: dict[bytes, float], postings: dict[bytes, list[tuple[int, int]]]) -> None:
        self.postings, self.rare = postings, frozenset(postings)
        self.templates = [words_of(text) for _, text, _ in TEMPLATES]
        anchors = Counter(k for own in postings.values() for k, _ in own)
        self.need = [min(len(words), max(2, anchors[k] // 3)) for k, words in enumerate(self.templates)]
        self.phrases = [[words_of(p) for p in phrases] for _, _, phrases in TEMPLATES]
        self.key_words = [frozenset(w for p in phrases for w in p) for phrases in self.phrases]
        self.base = [(words_of(phrase), label) for phrase, label in BASE]

    def base_hits(self, words: list[bytes], present: set[bytes]) -> list[tuple[int, str]]:
        hits = []
        for phrase, label in self.base:
            if present.issuperset(phrase):
                at = -1
                try:
                    while True:
                        at = words.index(phrase[0], at + 1)
                        if words[at : at + len(phrase)] == phrase:
                            hits.append((at, label))
                except ValueError:
                    pass
        return hits

    def places(self, words: list[bytes], present: set[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Of each template the relative positions of the places that enough different rare words vote for, those with
        the most votes first: a place is a span of a quarter of the template's length, its position the one that most
        of the votes agree on."""
        rare = self.rare & present
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        if rare:
            for at, w in enumerate(words):
                if w in rare:
                    for k, i in self.postings[w]:
                        if present.issuperset(self.key_words[k]):
                            hits[k].append((at - i, i))
        for k, own in hits.items():
            own.sort()
            slack, found, high = len(self.templates[k]) // 4, {}, 0
            for low, (start, _) in enumerate(own):
                while high < len(own) and own[high][0] <= start + slack:
                    high += 1
                anchors = len({i for _, i in own[low:high]})
                if anchors >= self.need[k]:
                    votes = Counter(s for s, _ in own[low:high])
                    best = min(votes, key=lambda s: (-votes[s], s))
                    found[best] = max(found.get(best, 0), anchors + votes[best])
            yield k, sorted(found, key=lambda s: (-found[s], s))

    def matches(self, words: list[bytes], present: set[bytes]) -> list[tuple[int, int, float]]:
        """(start, template, score) of every verified place; of places that overlap the one with the most votes."""
        found = []
        for k, starts in self.places(words, present):
            own, taken = self.templates[k], []
            slack = len(own) // 4
            for start in starts:
                near = bisect_left(taken, start)
                if any(abs(start - t) < 0.9 * len(own) for t in taken[max(0, near - 1) : near + 1]):
                    continue
                region = words[max(0, start - slack) : max(0, start + len(own) + slack)]
                if all(_stands(p, region) for p in self.phrases[k]):
                    score = longest_common_subsequence(own, region) / len(own)
                    if score >= MIN_SCORE:
                        insort(taken, start)
                        found.append((start, k, score))
        return sorted(found)

    def scan(self, text: str | None) -> dict:
        words = words_of(text)
        present = set(words)
        hits, found = self.base_hits(words, present), self.matches(words, present)
        at = [p for p, _ in hits]
        return {
            "n_words": len(words),
            "n_base": len(hits),
            "first_word": min(at, default=None),
            "last_word": max(at, default=None),
            "base_labels": ",".join(sorted({label for _, label in hits})),
            "labels": ",".join(sorted({label for _, label in hits} | {TEMPLATES[k][0] for _, k, _ in found})),
            "score": max([1.0] * bool(hits) + [s for _, _, s in found], default=0.0),
            "spans": [{"label": TEMPLATES[k][0], "start": start, "length": len(self.templates[k]), "score": s} for start, k, s in found],
        }


_FIELDS = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64())]))),
]
_SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,start:bigint,length:bigint,score:double>>"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence findings, one row per input row.

    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans``; ``spans`` lists the verified templates with the word they
    start at. Base phrases count wherever their words stand consecutively,
    overlaps included.

    Defined cases: a null text is empty: no words, labels empty, score 0;
    repeated rows are scanned each for itself; an empty table gives no rows;
    other columns, whatever their names, are ignored. A start may be negative
    where a text begins inside a template. A very long text takes some ten times
    its size while its words are looked up.
    """
    idf, postings = build_index(*document_frequencies(docs, text_col))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(idf, postings)
        for batch in slices(batches):
            rows = [scanner.scan(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[n] for r in rows], kind) for n, kind in _FIELDS)], names=["doc_id", *(n for n, _ in _FIELDS)])

    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, f"doc_id {kind}, {_SCHEMA}")
