"""Closed contracts, query provenance, requests, raw records and bound payloads against cases written out by hand."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from siftlake.functions import normalise as N
from siftlake.functions.records import author_names, https_addresses, named_strings, publication_types, record_fields
from siftlake.operators import contracts, funnel, ledger, provenance, screening
from siftlake.sources import requests
from siftlake.streaming.ingest import ingest

APPRAISAL = {
    "schema_version": "v", "source_record_id": "a" * 64, "study_identity": "s", "study_design": "cohort", "human_verified": True, "full_text_verified": False, "risk_of_bias": "low",
    "population_applicability": "direct", "harms_assessed": True, "conflicts_assessed": False, "retraction_status": "clear", "effect_estimate": None, "confidence_interval": None,
    "outcome_direction": "mixed", "supporting_quote": "q", "source_locator": None, "assessed_by": "x", "assessed_at": "2024-05-01T10:00:00+02:00", "notes": [],
}
EXTRACTION = {
    "schema_version": "v", "group_id": "b" * 64, "full_text_sha256": "c" * 64, "full_text_verified": True, **{k: "t" for k in (
        "study_design", "population", "condition", "intervention_protocol", "comparator", "follow_up", "adverse_events", "withdrawals", "funding", "conflicts", "extracted_by")},
    "sample_size": 12, "outcomes": ["o"], "effect_estimates": [], "source_locators": ["p"], "risk_of_bias": "unclear", "population_applicability": "unknown", "extracted_at": "2024-05-01T10:00:00Z", "notes": [],
}


def breaches(spark, contract, *documents):
    rows = spark.createDataFrame([(i, d if isinstance(d, str) or d is None else json.dumps(d)) for i, d in enumerate(documents)], "i int, d string")
    return [r.b for r in rows.select("i", contract.breaches(F.col("d")).alias("b")).orderBy("i").collect()]


def test_contracts(spark):
    own = contracts.appraisal_contract("v")
    assert len(APPRAISAL) == 19 and len(EXTRACTION) == 23
    changed = lambda **kw: {**APPRAISAL, **kw}
    without = {k: v for k, v in APPRAISAL.items() if k != "notes"}
    got = breaches(
        spark, own, APPRAISAL, without, changed(extra=1), changed(human_verified="true"), changed(supporting_quote=" "), changed(assessed_at="2024-05-01"), changed(study_design="Cohort"),
        changed(source_record_id="A" * 64), changed(study_identity="x" * 2001), changed(effect_estimate=3), changed(schema_version="w"), "[]", "no json", None, "",
    )
    assert got == [
        [], ["missing:notes"], ["extra:extra"], ["human_verified"], ["supporting_quote", "verified_without_quote"], ["assessed_at"], ["study_design"], ["source_record_id"], ["study_identity"],
        ["effect_estimate"], ["schema_version"], *[["not_an_object"]] * 4,
    ]
    other = contracts.extraction_contract("v")
    bad = lambda **kw: {**EXTRACTION, **kw}
    assert breaches(spark, other, EXTRACTION, bad(full_text_verified=False), bad(sample_size=0), bad(sample_size=True), bad(sample_size="12"), bad(outcomes=[]), bad(outcomes="o"), bad(funding="")) == [
        [], ["full_text_verified"], ["sample_size"], ["sample_size"], ["sample_size"], ["outcomes"], ["outcomes"], ["funding"],
    ]


def test_tiers_of_the_contract(spark):
    rows = spark.createDataFrame([("randomized_controlled_trial", "low"), ("clinical_guideline", "low"), ("nonrandomized_controlled", "some_concerns"), ("mechanistic_human", "unclear"), ("other", "high"), ("cohort", "critical")], "d string, r string")
    assert [x[0] for x in rows.select(N.evidence_tier(rows.d, rows.r)).collect()] == ["T2", "T1", "T3", "T5", "T5", "U"]
    for wrong in (("randomised trial", "low"), ("cohort", "dreadful"), (None, "low"), ("cohort", None)):
        with pytest.raises(Exception, match="no such study design"):
            spark.createDataFrame([wrong], "d string, r string").select(N.evidence_tier(F.col("d"), F.col("r"))).collect()


def test_provenance_tries_four_keys(spark):
    value = "query_id string, expression string, maximum int, negative_control boolean"
    questions = spark.createDataFrame([("q1", "skin", 50, False), ("q2", "scar", 50, True), ("q3", "scar", 20, True)], value)
    compiled = spark.createDataFrame([("q1", "skin", 50, False, "pubmed"), ("q4", "nail", 10, False, "pubmed")], value + ", provider string")
    lookup = provenance.lookup_rows(questions, compiled)
    asked = [("pubmed", "skin", 50), ("openalex", "skin", 50), ("pubmed", "nail", 99), ("openalex", "skin", 99), ("openalex", "scar", 20), ("openalex", "scar", 99), ("openalex", "nail", 10), ("pubmed", None, None)]
    requests_ = spark.createDataFrame([(i, *a, "x") for i, a in enumerate(asked)], "i int, provider string, expression string, maximum int, v string")
    got = {r.i: (r.query_id, r.compiled) for r in provenance.trace_queries(requests_, lookup).collect()}
    assert got == {0: ("q1", True), 1: ("q1", False), 2: ("q4", True), 3: ("q1", False), 4: ("q3", False), 5: ("unmapped", False), 6: ("unmapped", False), 7: ("unmapped", False)}
    twice = lookup.unionByName(lookup.filter("query_id = 'q4'").withColumn("query_id", F.lit("q5")))
    assert provenance.ambiguous(lookup).count() == 0 and provenance.ambiguous(twice).count() == 1
    with pytest.raises(Exception, match="ambiguous"):
        provenance.trace_queries(requests_, twice).collect()


def test_raw_records(spark):
    raw = {
        "publicationTypes": ["Letter", {"name": "review"}], "pubtype": "Trial", "providerRecord": {"pubTypeList": {"pubType": ["letter"]}, "authorString": "A B, , C D", "pmcid": "pmc12", "isRetracted": "Y"},
        "urls": ["http://doi.org/10.1/x", "https://a.example", "ftp://b.example", "https://a.example"],
    }
    assert publication_types(raw) == ["Letter", "letter", "review", "Trial"]
    assert author_names(raw) == ["A B", "C D"] and author_names({"authors": [{"given": "E", "family": "F"}, {"display_name": "G"}, "", None]}) == ["E F", "G"]
    assert https_addresses(raw) == ["https://a.example", "https://doi.org/10.1/x"]
    assert named_strings(None) == [] and named_strings(" x &amp; y ") == ["x & y"] and named_strings({"name": "x"}) == []
    rows = spark.createDataFrame([(1, json.dumps(raw)), (2, None), (3, "[]"), (4, "{")], "i int, j string").select("i", record_fields("j").alias("r")).orderBy("i").collect()
    assert rows[0].r.pmcid == "pmc12" and rows[0].r.provider_retracted == "Y"
    assert all(r.r.authors == [] and r.r.urls == [] and r.r.pmcid is None for r in rows[1:])


def test_requests(spark):
    row = spark.createDataFrame([("pubmed", "search/papers", 'a "b"', 5, None, "m@x.example", "key")], "p string, e string, q string, m int, f string, c string, k string")
    text = row.select(requests.request_envelope(*(F.col(c) for c in "peqmfck"))).first()[0]
    assert json.loads(text) == {"provider": "pubmed", "endpoint": "search/papers", "query": 'a "b"', "maxResults": 5, "filters": {}, "contactEmailProvided": True, "apiKeyProvided": True}
    one = spark.range(1)
    lit = lambda x, kind: F.lit(x).cast(kind)
    effective = lambda *a: one.select(requests.effective_query(lit(a[0], "string"), lit(a[1], "boolean"), lit(a[2], "array<string>") if a[2] is None else F.array(*map(F.lit, a[2])), lit(a[3], "int"), lit(a[4], "int"))).first()[0]
    assert effective("x", None, None, None, None) == "(x)"
    assert effective("x", True, ["RCT", "?"], None, 2000) == "(x) NOT (hasretractionin OR retracted publication[pt]) AND (randomized controlled trial[pt]) AND 1600:2000[dp]"
    urls = ["https://h.example/api/x", "http://h.example/api/x", "https://h.example:8/api/x", "https://u@h.example/api/x", "https://h.example.evil/api/x", "https://h.example/other", None, ""]
    got = [r[0] for r in spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").orderBy("i").select(requests.official_address(F.col("u"), "h.example", "/api/")).collect()]
    assert got == [urls[0]] + [None] * 7
    said = spark.createDataFrame([("key abc failed", "abc"), ("plain", None), ("plain", "")], "m string, s string").select(requests.redacted(F.col("m"), F.col("s"), 12)).collect()
    assert [r[0] for r in said] == ["key [redacte", "plain", "plain"]
    assert [r[0] for r in spark.createDataFrame([(0,), (1,), (1200,), (1201,), (None,)], "t int").select(requests.allowed_timeout(F.col("t"))).collect()] == [None, 1, 1200, None, None]


def test_bound_payloads(spark):
    digest = lambda d: hashlib.sha256(json.dumps(d, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    body = {"group_id": "g", "title": "t", "screening_priority": 5, "priority_reason_codes": ["x"]}
    fewer = lambda *names: {k: v for k, v in body.items() if k not in names}
    full = json.dumps(body | {"group_payload_sha256": "z"})
    rows = [(full, digest(body)), (full, digest(fewer("screening_priority"))), (full, digest(fewer("screening_priority", "priority_reason_codes"))), (full, digest(fewer("title"))), (None, "x"), ("[]", "x"), (full, None)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, p string, h string").orderBy("i")
    holds = ledger.payload_holds(F.col("p"), F.col("h"), "group_payload_sha256", ("screening_priority", "priority_reason_codes"))
    assert [r[0] for r in frame.select(holds).collect()] == [True, True, True, False, False, False, False]


def test_spans_and_sets(spark):
    sources = spark.createDataFrame([("g", "A title", None), ("g", "A title", None)], "group_id string, title string, abstract string")
    kind = "group_id string, spans array<struct<field:string,exact_text:string>>, title string"
    said = [("g", [("title", "title")], "n"), ("g", [("title", "Title")], "n"), ("g", [("abstract", "x")], "n"), ("g", [("venue", "x")], "n"), ("g", [], "n"), ("g", None, "n"), ("h", [("title", "x")], "n"), ("g", [("title", "")], "n")]
    got = ledger.verbatim_spans(spark.createDataFrame(said, kind), sources, "group_id", ("title", "abstract"))
    assert sorted(r.verbatim for r in got.collect()) == [False] * 7 + [True]
    pair = spark.createDataFrame([([1, 2], [2, 1, 1]), ([1], [1, 2]), ([], [1]), (None, [1])], "a array<int>, b array<int>")
    assert [tuple(r) for r in pair.select(funnel.set_equal(F.col("a"), F.col("b")), funnel.is_subset(F.col("a"), F.col("b"))).collect()] == [(True, True), (False, True), (False, True), (None, False)]


def test_mentions(spark):
    text = "Fitzpatrick skin types II-IV, n = 40; 12 weeks of follow-up and 2.5 years. ECCA and the Vancouver Scar Scale. Sponsored by industry."
    rows = spark.createDataFrame([(1, text, None, False), (2, None, None, True)], "i int, title string, abstract string, negative_control boolean")
    found = screening.extract_features(rows, {k: {"c": ["scar"]} for k in screening.KINDS}, "title", "abstract", excluded={"outcomes": {"c"}}).orderBy("i").collect()
    assert found[0].phototypes == ["II-IV"] and found[0].scales == ["ECCA", "Vancouver Scar Scale"] and found[0].sample_sizes == [40]
    assert [(f.value, f.unit) for f in found[0].follow_ups] == [(12.0, "weeks"), (2.5, "years")] and found[0].funding == ["Sponsored", "industry"]
    assert found[0].conditions == ["c"] and found[0].outcomes == [] and found[1].follow_ups == [] and found[1].scales == []


def test_numbered_rows(spark):
    rows = spark.createDataFrame([(f"{i:04d}", "x") for i in range(500)], "id string, sequence_ string").repartition(7)
    got = sorted((r.sequence, r.id) for r in ledger.numbered(rows, "id").collect())
    assert got == [(i + 1, f"{i:04d}") for i in range(500)]
    assert ledger.numbered(rows.limit(0), "id").count() == 0


def test_ingestion_resumes_under_a_budget(spark, tmp_path):
    inbox, store = tmp_path / "in", f"{tmp_path}/store"
    inbox.mkdir()

    def deliver(name, k):
        paper = {"papers": [{"title": f"t{k}", "year": 2000}, {"title": f"u{k}", "year": 2001}]}
        one = {"provider": "pubmed", "endpoint": "search/papers", "request_json": json.dumps({"query": k}), "response_json": json.dumps(paper), "observed_at": "2024-01-01T00:00:00Z"}
        (inbox / name).write_text(json.dumps(one))

    for k in range(4):
        deliver(f"{k}.json", k)
    deliver("again.json", 3)
    assert ingest(spark, str(inbox), store, most_records=3, files=1) == 4
    assert ingest(spark, str(inbox), store, most_records=3, files=1) == 4
    assert ingest(spark, str(inbox), store, files=1) == 8
    deliver("late.json", 9)
    assert ingest(spark, str(inbox), store) == 10 == ingest(spark, str(inbox), store)
    assert spark.read.parquet(f"{store}/acquisitions").select("id").distinct().count() == 5
