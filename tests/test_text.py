"""Normalisation, checked against hand cases and a plain Python version."""

from __future__ import annotations

import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from millrace.functions import text as T


def normal(spark, rows):
    df = spark.createDataFrame(rows, "i int, business_name string, business_address string")
    return {r.i: r for r in T.normalize(df).collect()}


NAMES = {
    "Acme Co. Ltd.": ("acme co ltd", "acme"),
    "A Private Limited": ("a private limited", "a private limited"),
    "Limited": ("limited", "limited"),
    "Foo S.A.R.L.": ("foo s a r l", "foo s a r l"),
    "http://www.foo-bar.co.in/x": ("foo bar", "foo bar"),
    "Café & Fils": ("cafe and fils", "cafe and fils"),
    "a_b": ("a_b", "a_b"),
    "\tWWW.Acme.com ": ("acme", "acme"),
    None: ("", ""),
    "": ("", ""),
    "NaN": ("", ""),
    "ﬁrst ²": ("first 2", "first 2"),
    "हिन्दी Co": (None, None),
}


def test_names(spark):
    got = normal(spark, [(i, n, None) for i, n in enumerate(NAMES)])
    for i, (name, (clean, core)) in enumerate(NAMES.items()):
        if clean is not None:
            assert (got[i].name_clean, got[i].name_core) == (clean, core), name
    # Vowel signs have combining class 0 and survive folding, but are no word characters.
    hindi = T.strip_accents_plain("हिन्दी co")
    assert got[len(NAMES) - 1].name_clean == " ".join(re.sub(r"[^\w\s]", " ", hindi).split())


@pytest.mark.parametrize(
    ("address", "clean", "postal"),
    [
        ("12345 Rd 560001", "12345 road 560001", "560001"),
        ("12345-6789", "12345 6789", "12345"),
        ("12 St, Fl", "12 street floor", None),
        (None, "", None),
        ("nan", "", None),
        ("85 Wayne Ave & Co 1234567", "85 wayne avenue and co 1234567", None),
    ],
)
def test_addresses(spark, address, clean, postal):
    got = normal(spark, [(0, None, address)])[0]
    assert (got.addr_clean, got.postal) == (clean, postal)


@given(st.text(alphabet=st.characters(max_codepoint=0x17F), max_size=20))
def test_latin_table_is_nfkd(s):
    plain = T.strip_accents_plain(s)
    if not re.search(T._NOT_LATIN, s):
        assert s.translate(str.maketrans(T.LATIN_FROM, T.LATIN_TO)) == plain


def test_fold_accents_mixed(spark):
    df = spark.createDataFrame([(0, "Éa ﬁ"), (1, "abc"), (2, None), (3, "naïve")], "i int, s string")
    got = [r.s for r in T.fold_accents(df, ["s"]).orderBy("i").collect()]
    assert got == ["Ea fi", "abc", None, "naive"]
