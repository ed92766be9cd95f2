"""Every entry of the fixed lists by what it does, with the expected values written out here."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import tuning
from millrace.operators.keys import blocking_keys

# Names whose last words are a legal form, one for each.
WITH_LEGAL_FORM = """
Acme Traders Private Limited; Acme Traders Pvt Ltd; Acme Traders Pvt Limited; Acme Traders Private Ltd;
Acme Traders Limited Liability Company; Acme Traders LLC; Acme Traders Public Limited Company; Acme Traders PLC;
Acme Traders Limited Liability Partnership; Acme Traders LLP; Acme Traders Société à Responsabilité Limitée;
Acme Traders Société Anonyme; Acme Traders Société par Actions Simplifiée; Acme Traders Société Civile Immobilière;
Acme Traders SARL; Acme Traders SASU; Acme Traders SAS; Acme Traders EURL; Acme Traders SCI; Acme Traders SNC;
Acme Traders GIE; Acme Traders Corporation; Acme Traders Corp; Acme Traders Incorporated; Acme Traders Inc;
Acme Traders Limited; Acme Traders Ltd; Acme Traders Holdings; Acme Traders Company; Acme Traders Co
"""

# Address words before and after their abbreviations are written out.
ABBREVIATED = "st str rd ave av blvd bvd bd dr ln ct hwy pkwy ste apt bldg fl sq opp nr indl ind est sec dist po imp chem all pl rte r"
WRITTEN_OUT = (
    "street street road avenue avenue boulevard boulevard boulevard drive lane court highway parkway suite apartment building floor square "
    "opposite near industrial industrial estate sector district post impasse chemin allee place route rue"
)

# Words that make no key of their own.
SILENT = (
    "and the for with from center centre group services consulting solutions international national global holdings enterprises associates "
    "management products systems trading tech india american us de la le des du et en of co corp inc ltd llc sarl sas pvt limited"
)


def test_legal_forms(spark):
    names = [n.strip() for n in WITH_LEGAL_FORM.split(";")]
    df = spark.createDataFrame([(n, None) for n in names], "business_name string, business_address string")
    assert [r.name_core for r in T.normalize(df).collect()] == ["acme traders"] * len(names)
    assert len(names) == len(T.LEGAL_SUFFIXES)


def test_abbreviations(spark):
    df = spark.createDataFrame([(None, ABBREVIATED)], "business_name string, business_address string")
    assert T.normalize(df).first().addr_clean == WRITTEN_OUT
    assert len(ABBREVIATED.split()) == len(T.ADDRESS_ABBREVIATIONS)


def test_stopwords(spark):
    row = ("US", "x", SILENT, SILENT, f"12 {SILENT}", None)
    keys = blocking_keys(spark.createDataFrame([row], "country string, entity_id string, name_clean string, name_core string, addr_clean string, postal string")).collect()
    assert {r.key.split(":")[0] for r in keys} == {"nc", "cmp"} and len(SILENT.split()) == 42


@pytest.mark.parametrize(
    ("url", "rest"),
    [("http://www.a.com", "a"), ("https://a.org/x", "a"), ("www.a.net", "a"), ("a.in", "a"), ("a.fr", "a"), ("a.co.in", "a"), ("a.co", "a"), ("a.io", "a"), ("a.biz", "a"), ("a.info/y", "a"), ("http://a.de", "a.de"), ("a.common", "a.common")],
)
def test_urls(spark, url, rest):
    assert spark.range(1).select(T.domain_strip(T.url_strip(F.lit(url)))).first()[0] == rest


def test_grid_levels():
    levels = [0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85]
    want = {(s, t) for s in levels for t in levels if not (t > s + 0.15 or t < s - 0.20)}
    assert set(tuning.GRID) == want and len(tuning.GRID) == len(want) == 39


@pytest.mark.parametrize(
    ("address", "postal"),
    [("pin ११०००१", "११०००१"), ("a१२३४५ 560001", "560001"), ("12345_ 1", None), ("12345é", None), ("٥٦٠٠٠١ x 1234567", "٥٦٠٠٠١"), ("12345 and 67890", "67890"), ("१२३ 12345,67890x", "12345")],
)
def test_postal_codes_of_any_script(spark, address, postal):
    df = spark.createDataFrame([(None, address)], "business_name string, business_address string")
    assert T.normalize(df).first().postal == postal
