"""Normalisation of names and addresses as column expressions.

Everything is JVM-side but accent folding of text outside Latin letters, which
needs Unicode data that Spark SQL has no function for and goes through one
Arrow UDF. Intermediate results are let-bound (:func:`let`): without that the
optimizer would inline each step into all its uses, and the generated code
would outgrow the JVM's limit for a method.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Legal forms of companies.
LEGAL_SUFFIXES = [
    "private limited", "pvt ltd", "pvt limited", "private ltd",
    "limited liability company", "llc",
    "public limited company", "plc",
    "limited liability partnership", "llp",
    "societe a responsabilite limitee", "societe anonyme",
    "societe par actions simplifiee", "societe civile immobiliere",
    "sarl", "sasu", "sas", "eurl", "sci", "snc", "gie",
    "corporation", "corp", "incorporated", "inc",
    "limited", "ltd", "holdings", "company", "co",
]

# Abbreviations of address words.
ADDRESS_ABBREVIATIONS = {
    "st": "street", "str": "street",
    "rd": "road",
    "ave": "avenue", "av": "avenue",
    "blvd": "boulevard", "bvd": "boulevard", "bd": "boulevard",
    "dr": "drive",
    "ln": "lane",
    "ct": "court",
    "hwy": "highway",
    "pkwy": "parkway",
    "ste": "suite",
    "apt": "apartment",
    "bldg": "building",
    "fl": "floor",
    "sq": "square",
    "opp": "opposite",
    "nr": "near",
    "indl": "industrial",
    "ind": "industrial",
    "est": "estate",
    "sec": "sector",
    "dist": "district",
    "po": "post",
    "imp": "impasse",
    "chem": "chemin",
    "all": "allee",
    "pl": "place",
    "rte": "route",
    "r": "rue",
}

# Patterns of the normal forms.
URL_PREFIX = r"^https?://(www\.)?|^www\."
DOMAIN_SUFFIX = r"\.(com|org|net|in|fr|co\.in|co|io|biz|info)(/.*)?$"
NOT_WORD = r"[^\p{L}\p{N}_\s]"
#: A digit is one of any script (Nd); a word character a letter, a number or the underscore, whatever the regex engine thinks.
DIGIT = r"\p{Nd}"
BEFORE_WORD, AFTER_WORD = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
POSTAL = BEFORE_WORD + rf"({DIGIT}{{5}}|{DIGIT}{{6}})" + AFTER_WORD
NUMBER = BEFORE_WORD + rf"({DIGIT}+)" + AFTER_WORD

#: Longest first, so that an alternative is not cut short by one it ends with.
SUFFIX_AT_END = r"\b(" + "|".join(sorted(LEGAL_SUFFIXES, key=len, reverse=True)) + r")\s*$"

#: Letters of Latin-1 and Latin Extended-A that decompose to one ASCII letter and a mark: the fast path's table.
_FOLDS = {chr(c): d[0] for c in range(0xC0, 0x180) if len(d := unicodedata.normalize("NFKD", chr(c))) == 2 and d[0].isascii() and unicodedata.combining(d[1])}
LATIN_FROM, LATIN_TO = "".join(_FOLDS), "".join(_FOLDS.values())
_NOT_LATIN = r"[^\x00-\x7F" + LATIN_FROM + "]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_accents_plain(text: str | None) -> str | None:
    """NFKD without combining marks."""
    return None if text is None else "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def _strip_accents_any(s: pd.Series) -> pd.Series:
    return s.map(strip_accents_plain)


def strip_latin_accents(s: Column) -> Column:
    return F.translate(s, LATIN_FROM, LATIN_TO)


def fold_accents(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with accents of ``columns`` stripped.

    Python sees only the values that hold anything beyond ASCII and the Latin
    letters of the table; all others reach it as nulls.
    """
    out = df
    for c in columns:
        hard = F.col(c).rlike(_NOT_LATIN)
        out = out.withColumn(f"__{c}", _strip_accents_any(F.when(hard, F.col(c))))
        out = out.withColumn(c, F.coalesce(F.col(f"__{c}"), strip_latin_accents(F.col(c)))).drop(f"__{c}")
    return out


def present(s: Column) -> Column:
    """``s``, or the empty text where it is missing (null, empty, or "nan" in any case)."""
    return F.when(s.isNull() | (F.lower(s) == "nan"), F.lit("")).otherwise(s)


def url_strip(s: Column) -> Column:
    return F.regexp_replace(s, URL_PREFIX, "")


def domain_strip(s: Column) -> Column:
    return F.regexp_replace(s, DOMAIN_SUFFIX, "")


def symbol_map(s: Column) -> Column:
    return F.replace(F.replace(F.replace(s, F.lit("&"), F.lit(" and ")), F.lit("@"), F.lit(" at ")), F.lit("+"), F.lit(" "))


def collapse(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def punct_collapse(s: Column) -> Column:
    return collapse(F.regexp_replace(s, NOT_WORD, " "))


def legal_suffix(clean: Column) -> Column:
    """The name without its legal form, twice (``co ltd``); a rest of under two characters is not taken."""

    def once(s: Column) -> Column:
        return let(F.trim(F.regexp_replace(s, SUFFIX_AT_END, "")), lambda t: F.when(F.length(t) >= 2, t).otherwise(s))

    return let(once(clean), lambda s: collapse(once(s)))


def tokens(s: Column) -> Column:
    return F.filter(F.split(s, r"\s+"), lambda t: t != "")


def lowered(s: Column) -> Column:
    return F.lower(F.btrim(present(s), F.lit(" \t\n\x0b\x0c\r")))


def name_clean(folded: Column) -> Column:
    """From the lowered, accent-free name."""
    return punct_collapse(symbol_map(domain_strip(url_strip(folded))))


def postal_extract(folded: Column) -> Column:
    """The last run of five or six digits of the lowered address; null if there is none."""
    return F.try_element_at(F.regexp_extract_all(folded, F.lit(POSTAL), 1), F.lit(-1))


def abbr_expand(words: Column) -> Column:
    pairs = F.create_map(*(F.lit(x) for kv in ADDRESS_ABBREVIATIONS.items() for x in kv))
    return F.transform(words, lambda t: F.coalesce(F.try_element_at(pairs, t), t))


def address_clean(folded: Column) -> Column:
    spaced = F.regexp_replace(F.replace(F.replace(folded, F.lit("&"), F.lit(" and ")), F.lit("-"), F.lit(" ")), NOT_WORD, " ")
    return F.array_join(abbr_expand(tokens(spaced)), " ")


def normalize(records: DataFrame, name: str = "business_name", address: str = "business_address") -> DataFrame:
    """``records`` with ``name_clean, name_core, addr_clean`` (never null) and ``postal`` (nullable) instead of name and address."""
    low = records.withColumn(name, lowered(F.col(name))).withColumn(address, lowered(F.col(address)))
    low = fold_accents(low, [name, address])
    both = low.withColumns({"name_clean": name_clean(F.col(name)), "addr_clean": address_clean(F.col(address)), "postal": postal_extract(F.col(address))})
    return both.withColumn("name_core", legal_suffix(F.col("name_clean"))).drop(name, address)
