"""Rules, samples, reports, funnel and gates on small tables."""

import hashlib

from pyspark.sql import functions as F

from siftlake.operators import funnel, screening

RULES = "group_id string, title string, abstract string, types array<string>, design string, nct_id string, retracted boolean, negative_control boolean, compiled boolean, satisfied boolean"


def propose(spark, **row):
    base = {"group_id": "g", "title": "Skin care", "abstract": "skin", "types": None, "design": "cohort_or_longitudinal", "nct_id": None, "retracted": None, "negative_control": None, "compiled": None, "satisfied": None}
    cells = tuple((base | row)[c.split()[0]] for c in RULES.split(", "))
    return screening.propose_eligibility(spark.createDataFrame([cells], RULES), r"\bskin\b").first()


def test_rules_in_order(spark):
    cases = [
        (dict(retracted=True, satisfied=True), "auto_exclude", ["EX_RETRACTED"], 90),
        (dict(title="Rats and skin"), "auto_exclude", ["EX_NONHUMAN_ONLY"], 90),
        (dict(title="Rats and skin", abstract="one patient"), "manual_review", ["MR_INCOMPLETE_OR_AMBIGUOUS_CONCEPT_MATCH"], 5),
        (dict(title="skin in vitro"), "auto_exclude", ["EX_LAB_ONLY"], 90),
        (dict(title="skin in vitro and in vivo"), "manual_review", ["MR_INCOMPLETE_OR_AMBIGUOUS_CONCEPT_MATCH"], 5),
        (dict(types=["Letter"], satisfied=True), "manual_review", ["MR_NONRESEARCH_PUBLICATION_TYPE"], 5),
        (dict(title="x", abstract=None, negative_control=True, compiled=True), "auto_exclude", ["EX_NO_DOMAIN_ANCHOR"], 90),
        (dict(title="x", abstract=None, compiled=True), "manual_review", ["MR_COMPILED_QUERY_MATCH_WITHOUT_METADATA_ANCHOR", "MR_ABSTRACT_UNAVAILABLE"], 5),
        (dict(title=None, abstract=None), "auto_exclude", ["EX_NO_DOMAIN_ANCHOR"], 90),
        (dict(satisfied=True), "auto_include", ["IN_QUERY_CONCEPTS_SATISFIED"], 40),
        (dict(satisfied=True, design="guideline"), "auto_include", ["IN_QUERY_CONCEPTS_SATISFIED"], 10),
        (dict(design="protocol", abstract=None), "manual_review", ["MR_INCOMPLETE_OR_AMBIGUOUS_CONCEPT_MATCH", "MR_ABSTRACT_UNAVAILABLE", "MR_PROTOCOL_OR_REGISTRY_ROLE"], 5),
        (dict(design="protocol", abstract=" "), "manual_review", ["MR_INCOMPLETE_OR_AMBIGUOUS_CONCEPT_MATCH", "MR_PROTOCOL_OR_REGISTRY_ROLE"], 5),
    ]
    for row, status, reasons, priority in cases:
        got = propose(spark, **row)
        assert (got.proposed_status, got.reason_codes, got.screening_priority) == (status, reasons, priority), row


def test_sample(spark):
    rows = [(f"g{i}", r) for i in range(40) for r in ("A", "B") if i % 3 or r == "A"] + [("g1", "A"), (None, "A"), ("g2", None)]
    expected: dict = {}
    for r in "AB":
        keys = sorted({k for k, x in rows if x == r and k}, key=lambda k: hashlib.sha256(f"{r}\0{k}".encode()).hexdigest())[:5]
        for k in keys:
            expected.setdefault(k, []).append(r)
    got = screening.exclusion_sample(spark.createDataFrame(rows, "k string, r string").repartition(4), "k", "r")
    assert {r.k: r.sampled_reasons for r in got.collect()} == expected


def test_audit(spark):
    sample = spark.createDataFrame([("a",), ("b",)], "k string")
    full = lambda *d: screening.audit_exclusions(sample, spark.createDataFrame(list(zip("ab", d)), "k string, d string"), "k", "d", 0.5).first()
    assert full("exclude", "include").passed and not full("exclude", "uncertain").passed and not full("include", "include").passed
    part = screening.audit_exclusions(sample, spark.createDataFrame([("a", "exclude"), ("z", "exclude")], "k string, d string"), "k", "d").first()
    assert part.uncovered == 2 and not part.complete
    empty = screening.audit_exclusions(sample.limit(0), spark.createDataFrame([], "k string, d string"), "k", "d").first()
    assert empty.false_exclusion_rate is None and empty.sampled == 0


def test_spans(spark):
    ontology = {"conditions": {"scarring": ["scar"]}, "interventions": {}, "outcomes": {"symptom": ["itch"]}}
    rows = spark.createDataFrame([(1, "Scars, scar and scarring; itch", None), (2, None, "")], "k int, title string, abstract string")
    got = [(r.k, r.concept_id, r.field, r.start, r.end, r.text) for r in screening.term_spans(rows, "k", ("title", "abstract"), ontology).collect()]
    assert got == [(1, "scarring", "title", 0, 5, "Scars"), (1, "scarring", "title", 7, 11, "scar"), (1, "symptom", "title", 26, 30, "itch")]


def test_controls(spark):
    rows = spark.createDataFrame([("a", True, "auto_exclude"), ("b", True, "manual_review"), ("c", None, "auto_include")], "group_id string, negative_control boolean, proposed_status string")
    got = screening.negative_control_report(rows).first()
    assert (got.controls, got.excluded_controls, got.failures, got.status, got.gate) == (2, 1, ["b"], "fail", False)
    assert screening.negative_control_report(rows.limit(0)).first().status == "not_run"
    assert screening.control_only([{"condition_concepts": ["a"], "intervention_concepts": [], "outcome_concepts": []}], [{"condition_concepts": ["a", "b"], "intervention_concepts": [], "outcome_concepts": []}])["conditions"] == {"b"}


def test_enrichment(spark):
    groups = spark.createDataFrame([("a", "1", None), ("b", "2", "have"), ("c", "3", None), ("d", "3", None), ("e", "4", "same"), ("f", "5", None), ("g", None, None)], "group_id string, pmid string, abstract string")
    got = funnel.enrich(groups, spark.createDataFrame([("1", "new"), ("2", "other"), ("3", "x"), ("4", "same"), ("5", " "), ("9", "y")], "pmid string, abstract string"))
    assert {r.pmid: r.outcome for r in got.collect()} == {"1": "applied", "2": "existing_abstract_differs", "3": "identifier_not_unique", "4": "unchanged", "5": "abstract_empty", "9": "group_not_found"}


def test_batches(spark):
    ids = spark.createDataFrame([(str(i),) for i in range(201, 0, -1)] + [("5",), (None,), ("x",)], "pmid string").select(F.expr("try_cast(pmid as bigint)").alias("pmid"))
    got = {r.pmid: r.batch for r in funnel.id_batches(ids, "pmid").collect()}
    assert len(got) == 201 and got[200] == 0 and got[201] == 1


def test_routes_and_matrix(spark):
    groups = spark.createDataFrame([("a", "10.1234/x", None, None, ["https://h/a.PDF", "https://h/b", "https://h/b"]), ("b", None, None, None, None)], "group_id string, doi string, pmcid string, nct_id string, urls array<string>")
    got = sorted((r.group_id, r.priority, r.route_type) for r in funnel.full_text_routes(groups).collect())
    assert got == [("a", 20, "open_pdf"), ("a", 40, "publisher_doi"), ("a", 50, "landing_page"), ("b", 90, "manual_library_request")]
    included = spark.createDataFrame([("a", ["x", "y"], [], "cohort"), ("b", [], ["i"], "cohort")], "group_id string, conditions array<string>, interventions array<string>, design string")
    matrix = funnel.comparison_matrix(included, spark.createDataFrame([("a", 5)], "group_id string, sample_size int"))
    assert sorted((r.condition, r.intervention, r.group_id, r.extraction_complete) for r in matrix.collect()) == [("unclassified", "i", "b", False), ("x", "unclassified", "a", True), ("y", "unclassified", "a", True)]
    assert funnel.evidence_groups(matrix).filter("extracted = 1").count() == 2


def test_saturation(spark):
    retained = spark.createDataFrame([(s, i) for s, n in enumerate((100, 200, 200, 201)) for i in range(n)], "snapshot bigint, identity int")
    families = spark.createDataFrame([(s, f) for s, n in enumerate((1, 2, 2, 2)) for f in range(n)], "snapshot bigint, family int")
    report = funnel.saturation(retained, families)
    assert [(r.snapshot, r.new_identities, r.new_families, r.passes) for r in report.orderBy("snapshot").collect()] == [(1, 100, 1, False), (2, 0, 0, True), (3, 1, 0, True)]
    assert funnel.is_saturated(report).first().saturated and not funnel.is_saturated(report.filter("snapshot < 3")).first().saturated
    assert not funnel.is_saturated(report.limit(0)).first().saturated


def test_gates_fail_closed(spark):
    schema = "study_id string, human_verified boolean, full_text_verified boolean, retraction_status string, harms_assessed boolean, conflicts_assessed boolean, applicability string, effect_estimate string, confidence_interval string, tier string, direction string"
    good = [(s, True, True, "clear", True, True, "direct", "1", "0-2", "T1", d) for s, d in (("a", "beneficial"), ("b", "beneficial"))]
    assert funnel.appraisal_gates(spark.createDataFrame(good, schema), False, True).first().ready
    none = funnel.appraisal_gates(spark.createDataFrame([], schema), True, True).first()
    assert not none.ready and none.failed_gates[0] == "all_sources_appraised" and len(none.failed_gates) == 11
    mixed = good[:1] + [(*good[1][:-1], "harmful")]
    assert funnel.appraisal_gates(spark.createDataFrame(mixed, schema), False, True).first().failed_gates == ["contradictions_resolved"]
    assert funnel.appraisal_gates(spark.createDataFrame(mixed, schema), True, True).first().ready


def test_any_phrase_is_each_phrase(spark):
    from siftlake.functions.normalise import phrase_pattern

    terms = ["scar", "acne", "itching", "a.b", "biopsy"]
    texts = ["scar", "two SCARS.", "scarring", "éacne", "acne", "xacne", "a\nacne", "itchings", "a.b", "axb", "a.bs!", "", "biopsys", "Biopsy", "scar_", "(scar)"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    each = [rows.t.rlike(phrase_pattern(t)) for t in terms]
    whole = rows.t.rlike(screening.any_phrase(terms))
    got = rows.select(whole, *each).collect()
    assert [r[0] for r in got] == [any(r[1:]) for r in got] and 5 < sum(r[0] for r in got) < len(texts)
