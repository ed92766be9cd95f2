from __future__ import annotations

import random
import re

import pytest

from millrace.llm import licenses as N
from millrace.llm import queries

from .conftest import MESSY

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    words = WORD.findall((text or "").translate(LOWER))
    at = []
    for phrase, label in N.BASE:
        p = phrase.split()
        at += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def base(r):
    return r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]


@pytest.fixture(scope="module")
def scanner():
    return N.Scanner(*N.build_index(0, {}))


def test_base_against_plain(scanner):
    rng = random.Random(5)
    vocabulary = ["MIT", "license", "Apache", "general", "public", "License,", "mit-license", "été", "x", "\n", "GNU"]
    for _ in range(2000):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 25)))
        assert base(scanner.scan(text)) == plain(text), text
    for _, text in MESSY:
        assert base(scanner.scan(text)) == plain(text)


@pytest.mark.parametrize("k", range(len(N.TEMPLATES)))
def test_every_template_is_found(scanner, k):
    label, text, _ = N.TEMPLATES[k]
    r = scanner.scan(f"some words before. {text.upper()}, and after")
    assert label in r["labels"].split(",") and r["score"] == 1
    assert any(s["label"] == label and s["start"] == 3 and s["score"] == 1 for s in r["spans"])


@pytest.mark.parametrize("k", range(len(N.NOTICES), len(N.TEMPLATES)))
def test_texts_with_words_put_in_and_left_out(scanner, k):
    """Insertions shift what follows; the place is still one, and scored by the words in order."""
    label, text, phrases = N.TEMPLATES[k]
    rng, words = random.Random(k), [w.decode() for w in N.words_of(text)]
    keys = [w.decode() for p in phrases for w in N.words_of(p)]
    kept = [w for w in words if w in keys or rng.random() > 0.1]
    spots = {i for p in phrases for i in range(len(kept)) if kept[i : i + len(p.split())] == p.split() for i in range(i, i + len(p.split()))}
    changed = [x for i, w in enumerate(kept) for x in ([w] if i in spots or rng.random() > 0.06 else [f"own{i}", w])]
    r = scanner.scan("Copyright 2020 by somebody " + " ".join(changed) + " and then some code")
    (own,) = (s["score"] for s in r["spans"] if s["label"] == label and s["length"] == len(words))
    assert label in r["labels"].split(",") and 0.6 <= own < 1
    want = N.longest_common_subsequence(N.words_of(text), N.words_of(" ".join(changed))) / len(words)
    assert own == pytest.approx(want)


def plain_matches(text):
    """Every template at every place of the text, without an index."""
    words, out = N.words_of(text), set()
    for label, template, phrases in N.TEMPLATES:
        own = N.words_of(template)
        slack = len(own) // 4
        for at in range(-slack, len(words)):
            region = words[max(0, at - slack) : at + len(own) + slack]
            if all(N._stands(N.words_of(p), region) for p in phrases) and N.longest_common_subsequence(own, region) >= N.MIN_SCORE * len(own):
                out.add(label)
                break
    return out


def test_labels_against_every_place(spark):
    """The query's labels and score on the documents that hold any key word of a licence, by brute force."""
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in queries.op9_license_scan(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    keyed = [i for i, t in texts.items() if {b"license", b"licensed", b"permission", b"reserved", b"redistribution"} & set(N.words_of(t))]
    assert len(keyed) > 5
    for i in keyed:
        base = set(rows[i].base_labels.split(",")) - {""}
        assert set(rows[i].labels.split(",")) - {""} == base | plain_matches(texts[i]), i
    assert all(rows[i].labels == rows[i].base_labels == "" and rows[i].score == 0 for i in texts if i not in keyed)


def test_verification(scanner):
    assert scanner.scan("licensed under the licence of cc and by and nc")["labels"] == ""
    broken = "licensed under the apache license edition 2 0"  # the key phrase "version 2 0" is missing
    assert scanner.scan(broken)["spans"] == [] and scanner.scan(broken)["labels"] == "apache"
    near = "permission is hereby granted at once free of charge to any person"
    assert scanner.scan(near)["labels"] == ""
    assert scanner.scan("general public license")["labels"] == "gpl"
    assert scanner.scan("under the terms of the gnu lesser general public license")["labels"] == "gpl,lgpl"


def test_messy(spark, messy, none):
    rows = N.scan_licenses(messy).collect()
    assert sorted(map(str, ((r.doc_id, *base(r)) for r in rows))) == sorted(map(str, ((i, *plain(t)) for i, t in MESSY)))
    assert all(r.score == 0 and r.labels == "" for r in rows)
    assert N.scan_licenses(none).count() == 0


def test_idf_orders_the_anchors(spark):
    df = spark.createDataFrame([("released under the license",)] * 50 + [("mit",)], "text string")
    n, freq = N.document_frequencies(df)
    assert n == 51 and freq[b"mit"] == 1 and freq[b"released"] == 50
    idf, postings = N.build_index(n, freq)
    assert idf[b"mit"] > idf[b"released"] and (0, N.NOTICES[0][1].split().index("mit")) in postings[b"mit"]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op9_license_scan(spark, sf).collect()
    assert {r.doc_id: base(r) for r in rows} == {i: plain(t) for i, t in text.items()}
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        if "Licensed under CC BY-NC 4.0." in text[r.doc_id]:
            assert "cc-by-nc" in r.labels
