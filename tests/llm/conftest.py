from __future__ import annotations

import pytest

LONG = "\n".join(f"Line number {i} of a very long text, with some words that only it has: w{i}." for i in range(3000))

#: (doc_id, text): nulls in either, empty and blank texts, repeats, ties, one very long text.
MESSY = [
    (1, "The same line stands in many documents.\nOnly here, first of all."),
    (2, "  THE SAME LINE stands in many documents.\t\nOnly here, second."),
    (3, "the same line stands in many documents.\nthe same line stands in many documents.\nshort"),
    (3, "the same line stands in many documents.\nthe same line stands in many documents.\nshort"),
    (3, "another text under a repeated id"),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (None, "The same line stands in many documents.\na text without an id"),
    (None, None),
    (7, LONG),
    (8, "Éàü ñ ß 日本語 \U0001f600 emoji\x00 and\x1f controls <|endoftext|> it's we'll"),
    (9, "short"),
    (10, "short"),
]
#: Names that operators use inside, as extra columns of the input.
CLASHING = "did long, tid long, fp long, h long, pos int, line string, words string, k long, uid long, piece int, chunk long, code int, n_lines long, score double, label int, prefix string, component_id long, n long, __did long, __tid long, __words string, __id long, _did long, __row_tid long, did_ long, node long, a long, b long, sample_key long, keeper boolean"


@pytest.fixture(scope="session")
def messy(spark):
    extra = (None,) * len(CLASHING.split(","))
    return spark.createDataFrame([(*r, *extra) for r in MESSY], f"doc_id long, text string, {CLASHING}").repartition(3)


@pytest.fixture(scope="session")
def none(messy):
    return messy.filter("doc_id = -5")
