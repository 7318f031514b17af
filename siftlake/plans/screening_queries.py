"""Features, eligibility, funnel and gates over the ledger tables, each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.functions import normalise as N
from siftlake.operators import funnel, ledger, screening
from siftlake.session import stage, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: A search ontology and specification as configuration documents give them.
ONTOLOGY = {
    "conditions": {"pigment": ["melasma", "pigmentation", "discolouration"], "eczematous": ["eczema", "dermatitis", "pruritus"], "keratotic": ["hyperkeratosis", "keratosis", "callus"], "scarring": ["keloid", "scar", "scarring"], "ulcer": ["ulceration", "erosion"]},
    "interventions": {"emollient": ["cream", "balm", "salve", "ointment"], "rinse": ["soak", "wash", "rinse"], "aerosol": ["foam", "mousse", "spray"], "dressing": ["patch", "bandage", "hydrogel", "sheet"]},
    "outcomes": {"symptom": ["pain", "itch", "flare"], "appearance": ["redness", "colour", "texture"], "function": ["mobility", "sleep", "quality"]},
}
SPECIFICATION = [
    {"id": "q-emollient", "condition_concepts": ["eczematous", "keratotic", "pigment"], "intervention_concepts": ["emollient"], "outcome_concepts": ["symptom"], "require_outcomes": False, "extra_required_groups": []},
    {"id": "q-rinse", "condition_concepts": ["ulcer", "eczematous"], "intervention_concepts": ["rinse", "aerosol"], "outcome_concepts": ["symptom", "appearance"], "require_outcomes": True, "extra_required_groups": []},
    {"id": "q-scar", "condition_concepts": ["scarring"], "intervention_concepts": ["dressing", "emollient"], "outcome_concepts": [], "require_outcomes": False, "extra_required_groups": [["study", "trial", "review"]]},
    {"id": "c-control", "condition_concepts": ["pigment"], "intervention_concepts": ["rinse"], "outcome_concepts": ["function"], "require_outcomes": False, "extra_required_groups": [], "negative_control": True},
]
ANCHOR = r"\b(melasma|eczema|dermatitis|keratosis|hyperkeratosis|keloid|ulceration|erosion|rosacea|urticaria|nodule|plaque)\b"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def sql_term(column: str, term: str) -> str:
    plural = "s?" if not term.endswith(("s", "y", "ing", "ed")) else ""
    return rf"regexp_matches({column}, '(^|[^\p{{L}}\p{{N}}_]){term}{plural}([^\p{{L}}\p{{N}}_]|$)')"


def sql_concepts(kind: str, hidden: tuple[str, ...] = ()) -> str:
    cells = ", ".join(f"CASE WHEN {' OR '.join(sql_term('body', t) for t in terms)} THEN '{c}' END" for c, terms in sorted(ONTOLOGY[kind].items()))
    usual = f" AND (negative_control OR x NOT IN {hidden!r})".replace(",)", ")") if hidden else ""
    return f"[x FOR x IN [{cells}] IF x IS NOT NULL{usual}]"


#: The contract's designs, spelt out once more so that a slip in the code shows.
SQL_DESIGN = """CASE WHEN contains({0}, 'guideline') THEN 'guideline' WHEN contains({0}, 'meta-analysis') OR contains({0}, 'meta analysis') THEN 'meta_analysis'
    WHEN contains({0}, 'systematic review') THEN 'systematic_review'
    WHEN regexp_matches({0}, 'randomi[sz]ed (controlled )?trial') THEN 'randomized_controlled_trial'
    WHEN regexp_matches({0}, 'controlled (clinical )?trial') THEN 'controlled_trial' WHEN contains({0}, 'clinical trial') THEN 'clinical_trial'
    WHEN regexp_matches({0}, 'cohort|longitudinal') THEN 'cohort_or_longitudinal' WHEN regexp_matches({0}, 'case[- ]control') THEN 'case_control' WHEN contains({0}, 'case series') THEN 'case_series'
    WHEN contains({0}, 'review') THEN 'nonsystematic_review' WHEN contains({0}, 'protocol') THEN 'protocol' ELSE 'primary_or_other' END"""


def sql_design(column: str) -> str:
    return SQL_DESIGN.format(column)


SQL_DOCUMENT_DESIGN = sql_design("lower(coalesce(text, ''))")


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]::VARCHAR[]"


def sql_satisfied(q: dict) -> str:
    hit = lambda k, f: f"len(list_intersect({k}, {sql_list(q[f])})) > 0"
    parts = [hit("conditions", "condition_concepts"), hit("interventions", "intervention_concepts")]
    if q["require_outcomes"]:
        parts.append(hit("outcomes", "outcome_concepts"))
    parts += ["(" + " OR ".join(sql_term("normalised_title", t) for t in g) + ")" for g in q["extra_required_groups"]]
    return " AND ".join(parts)


_MATCHES = ", ".join(
    f"list_sort(list_intersect({k}, {{{k}}})) AS {k[:-1]}_matches" for k in screening.KINDS
)
SQL_RETRACTED = """(coalesce(regexp_matches(upper(concat_ws(',', raw_json ->> '$.isRetracted', raw_json ->> '$.retracted', raw_json ->> '$.providerRecord.isRetracted')), '(^|,)(Y|TRUE)(,|$)'), false)
    OR coalesce(regexp_matches(title, '(?i)\\b(retracted publication|retraction of|this article has been retracted)\\b'), false))"""
SQL_FEATURES = f"""
    WITH abs AS (SELECT identity_key, min(raw_json ->> '$.abstract') AS abstract, bool_or({SQL_RETRACTED}) AS retracted FROM source_records GROUP BY 1),
    base AS (SELECT g.*, abs.abstract, coalesce(abs.retracted, false) AS retracted, list_contains(providers, 'elicit') AS negative_control, lower(concat_ws(' ', g.title, abs.abstract)) AS body
        FROM dedup_groups g LEFT JOIN abs ON abs.identity_key = g.canonical_identity),
    feat AS (SELECT *, {sql_concepts('conditions')} AS conditions, {sql_concepts('interventions')} AS interventions, {sql_concepts('outcomes', ('function',))} AS outcomes,
        {sql_design('body')} AS design FROM base)"""
SQL_QUERY_ROWS = " UNION ALL ".join(
    "SELECT group_id, '{id}' AS query_id, {m}, {s} AS satisfied, {n} AS negative_control FROM feat".format(
        id=q["id"], m=_MATCHES.format(conditions=sql_list(q["condition_concepts"]), interventions=sql_list(q["intervention_concepts"]), outcomes=sql_list(q["outcome_concepts"])),
        s=sql_satisfied(q), n=str(bool(q.get("negative_control"))).lower(),
    )
    for q in SPECIFICATION
)
SQL_ELIGIBILITY = f"""{SQL_FEATURES},
    qs AS ({SQL_QUERY_ROWS}),
    inp AS (SELECT feat.*, lower(coalesce(title, '')) AS t, list_contains(providers, 'pubmed') AS compiled,
        (SELECT bool_or(satisfied) FROM qs WHERE qs.group_id = feat.group_id AND NOT qs.negative_control) AS satisfied FROM feat),
    rule AS (SELECT *, regexp_matches(body, '\\b(human|patient|participant|volunteer|adult|women|men|clinical)\\b') AS human, regexp_matches(body, '{ANCHOR}') AS anchored, CASE WHEN retracted THEN 1
        WHEN regexp_matches(t, '\\b(mouse|mice|murine|rats?|rabbits?|animal (model|study|studies)|porcine (skin|model|wound|subjects?))\\b') AND NOT human THEN 2
        WHEN regexp_matches(t, '\\b(in vitro|ex vivo|cell line|fibroblast culture)\\b') AND NOT human AND NOT regexp_matches(t, '\\bin vivo\\b') THEN 3
        WHEN NOT anchored AND negative_control THEN 5 WHEN NOT anchored AND compiled THEN 6 WHEN NOT anchored THEN 7 WHEN satisfied THEN 8 ELSE 9 END AS r FROM inp),
    prop AS (SELECT *, CASE WHEN r IN (1, 2, 3, 5, 7) THEN 'auto_exclude' WHEN r = 8 THEN 'auto_include' ELSE 'manual_review' END AS proposed_status,
        [x FOR x IN [CASE r WHEN 1 THEN 'EX_RETRACTED' WHEN 2 THEN 'EX_NONHUMAN_ONLY' WHEN 3 THEN 'EX_LAB_ONLY' WHEN 5 THEN 'EX_NO_DOMAIN_ANCHOR' WHEN 6 THEN 'MR_COMPILED_QUERY_MATCH_WITHOUT_METADATA_ANCHOR'
            WHEN 7 THEN 'EX_NO_DOMAIN_ANCHOR' WHEN 8 THEN 'IN_QUERY_CONCEPTS_SATISFIED' ELSE 'MR_INCOMPLETE_OR_AMBIGUOUS_CONCEPT_MATCH' END,
            CASE WHEN r IN (6, 9) AND abstract IS NULL THEN 'MR_ABSTRACT_UNAVAILABLE' END, CASE WHEN r = 9 AND design = 'protocol' THEN 'MR_PROTOCOL_OR_REGISTRY_ROLE' END] IF x IS NOT NULL] AS reason_codes FROM rule),
    final AS (SELECT *, CASE WHEN proposed_status = 'auto_exclude' THEN 90 WHEN proposed_status = 'manual_review' THEN 5 WHEN design IN ('guideline', 'meta_analysis', 'systematic_review') THEN 10
        WHEN design IN ('randomized_controlled_trial', 'controlled_trial', 'clinical_trial') THEN 20 WHEN nct_id IS NOT NULL OR design = 'protocol' THEN 30 WHEN design IN ('cohort_or_longitudinal', 'case_control') THEN 40 ELSE 50 END AS screening_priority FROM prop)"""


CONTROL_ONLY = screening.control_only([q for q in SPECIFICATION if not q.get("negative_control")], [q for q in SPECIFICATION if q.get("negative_control")])


def described_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups with an abstract, whether a record of theirs is retracted, and the flags of their retrieval."""
    source = table(spark, folder, "source_records")
    said = N.retracted(N.retraction_flags(F.col("raw_json")), F.col("title"), F.array().cast("array<string>"))
    held = source.groupBy(F.col("identity_key").alias("canonical_identity")).agg(F.min(F.get_json_object("raw_json", "$.abstract")).alias("abstract"), F.bool_or(said).alias("retracted"))
    groups = table(spark, folder, "dedup_groups").join(held, "canonical_identity", "left").withColumn("retracted", F.coalesce("retracted", F.lit(False)))
    return groups.withColumns({"negative_control": F.array_contains("providers", "elicit"), "compiled": F.array_contains("providers", "pubmed"), "body": F.concat_ws(" ", "title", "abstract")})


def features(spark: SparkSession, folder: str) -> DataFrame:
    """Groups with concepts and design by title and abstract, staged: what follows refers to them many times, and texts are to be searched once."""
    found = screening.extract_features(described_groups(spark, folder), ONTOLOGY, "title", "abstract", excluded=CONTROL_ONLY)
    return stage(found.withColumn("design", N.design_bucket(F.col("body"))).drop(*screening.MENTIONS), "features")


def proposals(spark: SparkSession, folder: str) -> DataFrame:
    met = F.exists(screening.evaluations(SPECIFICATION, "body"), lambda q: q["satisfied"] & ~q["negative_control"])
    asked = features(spark, folder).withColumn("satisfied", met).withColumn("types", F.array().cast("array<string>"))
    return stage(screening.propose_eligibility(asked, ANCHOR), "proposals")


@query(f"{SQL_FEATURES} SELECT group_id, conditions, interventions, outcomes, design FROM feat")
def term_match_concepts(spark: SparkSession, folder: str) -> DataFrame:
    return features(spark, folder).select("group_id", "conditions", "interventions", "outcomes", "design")


@query()
def term_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Every match in title and abstract; tests hold it against a plain loop."""
    return screening.term_spans(described_groups(spark, folder), "group_id", ("title", "abstract"), ONTOLOGY)


@query(r"""
    SELECT doc_id, list_sort(list_distinct([CAST(x AS INTEGER) FOR x IN list_concat(regexp_extract_all(text, '(?i)\b(\d{1,5})\s+(?:patients|participants|subjects|volunteers)\b', 1), regexp_extract_all(text, '\b[nN]\s*=\s*(\d{1,5})\b', 1))
        IF CAST(x AS INTEGER) BETWEEN 1 AND 100000])) AS sample_sizes FROM documents""")
def sample_size_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Sample sizes of every document; one without a text has none."""
    return table(spark, folder, "documents").select("doc_id", screening.sample_sizes(F.col("text")).alias("sample_sizes"))


@query(r"""
    SELECT group_id, [CAST(x AS DOUBLE) FOR x IN regexp_extract_all(body, '\b(\d+(?:\.\d+)?)\s*(days?|weeks?|months?|years?)(?:\s+(?:of\s+)?follow[ -]?up)?\b', 1)] AS follow_up_values,
        regexp_extract_all(body, '\b(\d+(?:\.\d+)?)\s*(days?|weeks?|months?|years?)(?:\s+(?:of\s+)?follow[ -]?up)?\b', 2) AS follow_up_units,
        list_distinct(regexp_extract_all(body, '\bfitzpatrick(?: skin)?(?: type| phototype)?s?\s*([ivxlc]+(?:\s*[-–]\s*[ivxlc]+)?)', 1)) AS phototypes,
        [x FOR x IN [CASE WHEN regexp_matches(body, '\becca\b') THEN 'ECCA' END, CASE WHEN regexp_matches(body, '\bfitzpatrick wrinkle(?: and elastosis)? scale\b') THEN 'Fitzpatrick wrinkle scale' END,
            CASE WHEN regexp_matches(body, '\bgoodman(?: and| &)? baron\b') THEN 'Goodman-Baron' END, CASE WHEN regexp_matches(body, '\b(?:posas|patient and observer scar assessment scale)\b') THEN 'POSAS' END,
            CASE WHEN regexp_matches(body, '\b(?:vancouver scar scale|vss)\b') THEN 'Vancouver Scar Scale' END] IF x IS NOT NULL] AS scales,
        len(regexp_extract_all(body, '\b(fund(?:ed|ing)|sponsor(?:ed|ship)?|industry|manufacturer|conflict(?:s)? of interest|competing interest)\b')) AS funding_mentions FROM
        (SELECT group_id, lower(concat_ws(' ', title, abstract)) AS body FROM dedup_groups LEFT JOIN (SELECT identity_key, min(raw_json ->> '$.abstract') AS abstract FROM source_records GROUP BY 1) ON identity_key = canonical_identity)""")
def study_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Follow-ups, phototypes, outcome scales and funding mentions in title and abstract."""
    rows = screening.extract_features(described_groups(spark, folder), ONTOLOGY, "title", "abstract")
    return rows.select(
        "group_id", F.col("follow_ups.value").alias("follow_up_values"), F.col("follow_ups.unit").alias("follow_up_units"), F.array_distinct(F.transform("phototypes", F.lower)).alias("phototypes"),
        "scales", F.size("funding").cast("bigint").alias("funding_mentions"),
    )


@query(f"{SQL_FEATURES} {SQL_QUERY_ROWS}")
def query_concept_satisfaction(spark: SparkSession, folder: str) -> DataFrame:
    return screening.evaluate_queries(features(spark, folder), SPECIFICATION, "body")


@query("SELECT kind, concept FROM (VALUES ('outcomes', 'function')) v(kind, concept)")
def control_only_concepts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.createDataFrame([(k, c) for k, cs in CONTROL_ONLY.items() for c in sorted(cs)], "kind string, concept string")


@query(f"{SQL_ELIGIBILITY} SELECT group_id, proposed_status, reason_codes, design, screening_priority FROM final")
def eligibility_rules(spark: SparkSession, folder: str) -> DataFrame:
    return proposals(spark, folder).select("group_id", "proposed_status", "reason_codes", "design", "screening_priority")


@query(f"""{SQL_ELIGIBILITY}
    SELECT group_id, screening_priority, row_number() OVER (ORDER BY screening_priority, coalesce(year, 0) DESC, normalised_title, group_id) AS place FROM final
    ORDER BY place LIMIT 50""")
def screening_queue(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 groups to screen next (a top-k report)."""
    order = [F.col("screening_priority"), F.coalesce("year", F.lit(0)).desc(), F.col("normalised_title"), F.col("group_id")]
    top = proposals(spark, folder).orderBy(*order).limit(50)
    from pyspark.sql import Window as W

    return top.select("group_id", "screening_priority", F.row_number().over(W.orderBy(*order)).cast("bigint").alias("place"))


@query("""
    WITH r AS (SELECT DISTINCT o_orderpriority AS reason, o_orderkey, sha256(o_orderpriority || chr(0) || CAST(o_orderkey AS VARCHAR)) AS h FROM orders),
    k AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY h) AS n FROM r)
    SELECT o_orderkey, list_sort(list(reason)) AS sampled_reasons FROM k WHERE n <= 5 GROUP BY o_orderkey""")
def exclusion_sample_topk(spark: SparkSession, folder: str) -> DataFrame:
    return screening.exclusion_sample(table(spark, folder, "orders"), "o_orderkey", "o_orderpriority")


SQL_SAMPLE = f"""{SQL_ELIGIBILITY},
    ex AS (SELECT DISTINCT group_id, unnest(reason_codes) AS reason FROM final WHERE proposed_status = 'auto_exclude'),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY sha256(reason || chr(0) || group_id)) AS n FROM ex),
    sample AS (SELECT group_id, list_sort(list(reason)) AS sampled_reasons FROM ranked WHERE n <= 5 GROUP BY group_id)"""


def _sample(proposed: DataFrame) -> DataFrame:
    return screening.exclusion_sample(proposed.filter("proposed_status = 'auto_exclude'").select("group_id", F.explode("reason_codes").alias("reason")), "group_id", "reason")


@query(f"{SQL_SAMPLE} SELECT * FROM sample")
def exclusion_sample(spark: SparkSession, folder: str) -> DataFrame:
    return _sample(proposals(spark, folder))


@query(f"""{SQL_SAMPLE},
    j AS (SELECT sample.group_id, CASE WHEN length(title) % 7 = 0 THEN 'include' WHEN length(title) % 5 = 0 THEN 'uncertain' ELSE 'exclude' END AS decision FROM sample JOIN dedup_groups USING (group_id))
    SELECT 0::BIGINT AS uncovered, count(*) AS completed, count(*) FILTER (WHERE decision = 'exclude') AS confirmed, count(*) FILTER (WHERE decision = 'include') AS false_exclusions,
        count(*) FILTER (WHERE decision = 'uncertain') AS uncertain, count(*) AS sampled, count(*) FILTER (WHERE decision = 'include') / nullif(count(*), 0) AS false_exclusion_rate, true AS complete,
        coalesce(count(*) FILTER (WHERE decision = 'include') / nullif(count(*), 0), 0) <= 0.25 AND count(*) FILTER (WHERE decision = 'uncertain') = 0 AS passed FROM j""")
def audit_exclusions(spark: SparkSession, folder: str) -> DataFrame:
    sample = _sample(proposals(spark, folder))
    size = F.length("title")
    done = sample.join(table(spark, folder, "dedup_groups"), "group_id").select("group_id", F.when(size % 7 == 0, "include").when(size % 5 == 0, "uncertain").otherwise("exclude").alias("decision"))
    return screening.audit_exclusions(sample, done, "group_id", "decision", 0.25)


@query(f"""{SQL_SAMPLE}
    SELECT (SELECT count(*) FROM (SELECT DISTINCT id FROM source_records)) AS records_identified, (SELECT count(*) FROM dedup_groups) AS unique_groups,
        count(*) FILTER (WHERE proposed_status = 'auto_include') AS proposed_include, count(*) FILTER (WHERE proposed_status = 'auto_exclude') AS proposed_exclude,
        count(*) FILTER (WHERE proposed_status = 'manual_review') AS awaiting_review, (SELECT count(DISTINCT pair_sha256) FROM duplicate_pairs) AS possible_duplicates,
        (SELECT count(*) FROM sample) AS exclusion_sample, (SELECT count(*) FROM (SELECT DISTINCT id FROM source_records)) - (SELECT count(*) FROM dedup_groups) AS duplicates_removed,
        0 AS full_texts_sought, 0 AS full_texts_not_retrieved FROM final""")
def prisma_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = proposals(spark, folder)
    return screening.flow_counts(
        table(spark, folder, "source_records").select("id").distinct(), table(spark, folder, "dedup_groups"), rows, table(spark, folder, "duplicate_pairs").select("pair_sha256").distinct(), _sample(rows)
    )


@query(f"""{SQL_ELIGIBILITY}, f AS (SELECT group_id FROM final WHERE negative_control AND proposed_status <> 'auto_exclude')
    SELECT count(*) FILTER (WHERE negative_control) AS controls, count(*) FILTER (WHERE negative_control AND proposed_status = 'auto_exclude') AS excluded_controls,
        (SELECT coalesce(list_sort(list(group_id)), []) FROM f) AS failures,
        CASE WHEN count(*) FILTER (WHERE negative_control) = 0 THEN 'not_run' WHEN (SELECT count(*) FROM f) = 0 THEN 'pass' ELSE 'fail' END AS status,
        count(*) FILTER (WHERE negative_control) > 0 AND (SELECT count(*) FROM f) = 0 AS gate FROM final""")
def negative_controls(spark: SparkSession, folder: str) -> DataFrame:
    return screening.negative_control_report(proposals(spark, folder))


@query(f"SELECT doc_id, {SQL_DOCUMENT_DESIGN} AS design FROM documents")
def design_bucket_case(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", N.design_bucket(F.col("text")).alias("design"))


_DESIGN_LIST = [
    "animal", "case_control", "case_series", "clinical_guideline", "cohort", "cross_sectional", "expert_opinion", "in_vitro", "longitudinal", "mechanistic_human", "meta_analysis",
    "nonrandomized_controlled", "other", "randomized_controlled_trial", "systematic_review",
]
_RISKS = ["low", "unclear", "high", "critical", "some_concerns"]


@query(f"""
    WITH d AS (SELECT p_partkey, ({sql_list(_DESIGN_LIST)})[p_size % {len(_DESIGN_LIST)} + 1] AS design, ({sql_list(_RISKS)})[p_partkey % {len(_RISKS)} + 1] AS risk FROM part),
    t AS (SELECT *, CASE WHEN design IN ('clinical_guideline', 'systematic_review', 'meta_analysis') THEN 1 WHEN design = 'randomized_controlled_trial' THEN 2
        WHEN design IN ('nonrandomized_controlled', 'longitudinal', 'cohort', 'case_control') THEN 3 WHEN design IN ('cross_sectional', 'case_series', 'mechanistic_human') THEN 4 ELSE 5 END AS base FROM d)
    SELECT p_partkey, design, risk, CASE WHEN risk = 'critical' THEN 'U' WHEN risk IN ('high', 'unclear') THEN 'T' || least(base + 1, 5) ELSE 'T' || base END AS tier FROM t""")
def evidence_tier(spark: SparkSession, folder: str) -> DataFrame:
    pick = lambda values, at: F.element_at(F.array(*(F.lit(v) for v in values)), (at + 1).cast("int"))
    rows = table(spark, folder, "part").select("p_partkey", pick(_DESIGN_LIST, F.col("p_size") % len(_DESIGN_LIST)).alias("design"), pick(_RISKS, F.col("p_partkey") % len(_RISKS)).alias("risk"))
    return rows.withColumn("tier", N.evidence_tier(F.col("design"), F.col("risk")))


@query(f"""{SQL_ELIGIBILITY},
    o AS (SELECT * FROM final WHERE proposed_status <> 'auto_exclude' AND trim(coalesce(abstract, '')) = ''),
    pm AS (SELECT identity_key, min(CASE WHEN regexp_full_match(upper(trim(raw_json ->> '$.pmcid')), 'PMC\\d+') THEN upper(trim(raw_json ->> '$.pmcid')) END) AS pmcid FROM source_records GROUP BY 1)
    SELECT group_id, len([x FOR x IN [pmid, pmcid, doi] IF x IS NOT NULL]) AS routes, CASE WHEN pmid IS NOT NULL THEN 'pubmed' WHEN pmcid IS NOT NULL THEN 'europe_pmc' WHEN doi IS NOT NULL THEN 'crossref_or_openalex' END AS first_route,
        CASE WHEN coalesce(pmid, pmcid, doi) IS NULL THEN 'no_machine_identifier' ELSE 'pending' END AS status FROM o LEFT JOIN pm ON identity_key = canonical_identity""")
def abstract_queue(spark: SparkSession, folder: str) -> DataFrame:
    queue = funnel.abstract_queue(with_pmcid(spark, folder, proposals(spark, folder)))
    return queue.select("group_id", F.size("routes").cast("bigint").alias("routes"), F.try_element_at("routes", F.lit(1))["route"].alias("first_route"), "status")


def with_pmcid(spark: SparkSession, folder: str, groups: DataFrame) -> DataFrame:
    own = N.normalise_identifier(F.get_json_object("raw_json", "$.pmcid"), N.PMCID, True)
    held = table(spark, folder, "source_records").groupBy(F.col("identity_key").alias("canonical_identity")).agg(F.min(own).alias("pmcid"))
    return groups.join(held, "canonical_identity", "left")


@query("""
    WITH n AS (SELECT DISTINCT TRY_CAST(pmid AS BIGINT) AS pmid FROM source_records WHERE TRY_CAST(pmid AS BIGINT) IS NOT NULL)
    SELECT pmid, CAST(floor((row_number() OVER (ORDER BY pmid) - 1) / 200) AS INTEGER) AS batch FROM n""")
def pmid_batches(spark: SparkSession, folder: str) -> DataFrame:
    return funnel.id_batches(table(spark, folder, "source_records").select(F.expr("try_cast(pmid as bigint)").alias("pmid")), "pmid")


@query(f"""{SQL_FEATURES},
    ret AS (SELECT pmid, min(raw_json ->> '$.abstract') AS abstract FROM source_records WHERE pmid IS NOT NULL GROUP BY pmid),
    hold AS (SELECT pmid, count(*) AS n, min(group_id) AS g, min(abstract) AS held FROM feat WHERE pmid IS NOT NULL GROUP BY pmid)
    SELECT ret.pmid, CASE WHEN n = 1 THEN g END AS group_id, CASE WHEN n IS NULL THEN 'group_not_found' WHEN n > 1 THEN 'identifier_not_unique' WHEN trim(coalesce(ret.abstract, '')) = '' THEN 'abstract_empty'
        WHEN trim(coalesce(held, '')) = '' THEN 'applied' WHEN held = ret.abstract THEN 'unchanged' ELSE 'existing_abstract_differs' END AS outcome FROM ret LEFT JOIN hold USING (pmid)""")
def enrichment_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    fetched = table(spark, folder, "source_records").filter("pmid is not null").groupBy("pmid").agg(F.min(F.get_json_object("raw_json", "$.abstract")).alias("abstract"))
    return funnel.enrich(features(spark, folder), fetched)


@query("""
    WITH s AS (SELECT identity_key, list_sort(list_distinct(flatten(list(coalesce(CAST(raw_json -> '$.urls' AS VARCHAR[]), []))))) AS urls FROM source_records GROUP BY 1),
    pm AS (SELECT identity_key, min(CASE WHEN regexp_full_match(upper(trim(raw_json ->> '$.pmcid')), 'PMC\\d+') THEN upper(trim(raw_json ->> '$.pmcid')) END) AS pmcid FROM source_records GROUP BY 1),
    g AS (SELECT group_id, doi, nct_id, pmcid, coalesce(urls, []) AS urls FROM dedup_groups LEFT JOIN s ON s.identity_key = canonical_identity LEFT JOIN pm ON pm.identity_key = canonical_identity),
    r AS (SELECT group_id, 'europe_pmc_xml' AS route_type, 10 AS priority, 'https://europepmc.org/articles/' || pmcid AS url, true AS automated FROM g WHERE pmcid IS NOT NULL UNION ALL SELECT group_id, 'trial_registry' AS route_type, 30 AS priority, 'https://clinicaltrials.gov/study/' || nct_id AS url, false AS automated FROM g WHERE nct_id IS NOT NULL UNION ALL
        SELECT group_id, 'publisher_doi', 40, 'https://doi.org/' || doi, false FROM g WHERE doi IS NOT NULL UNION ALL
        SELECT group_id, CASE WHEN ends_with(lower(u), '.pdf') THEN 'open_pdf' ELSE 'landing_page' END, CASE WHEN ends_with(lower(u), '.pdf') THEN 20 ELSE 50 END, u, ends_with(lower(u), '.pdf')
            FROM (SELECT group_id, unnest(urls) AS u FROM g) WHERE u IS NOT NULL)
    SELECT * FROM r UNION ALL SELECT group_id, 'manual_library_request', 90, NULL, false FROM g WHERE group_id NOT IN (SELECT group_id FROM r)""")
def fulltext_routes(spark: SparkSession, folder: str) -> DataFrame:
    urls = table(spark, folder, "source_records").select("identity_key", F.from_json(F.get_json_object("raw_json", "$.urls"), "array<string>").alias("u"))
    held = urls.groupBy("identity_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("u")))).alias("urls"))
    groups = table(spark, folder, "dedup_groups").join(held.withColumnRenamed("identity_key", "canonical_identity"), "canonical_identity", "left")
    return funnel.full_text_routes(with_pmcid(spark, folder, groups))


SQL_MATRIX = f"""{SQL_ELIGIBILITY},
    inc AS (SELECT * FROM final WHERE proposed_status = 'auto_include' OR screening_priority = 5),
    m AS (SELECT unnest(CASE WHEN len(conditions) > 0 THEN conditions ELSE ['unclassified'] END) AS condition, interventions, group_id, design FROM inc),
    mm AS (SELECT condition, unnest(CASE WHEN len(interventions) > 0 THEN interventions ELSE ['unclassified'] END) AS intervention, group_id, design FROM m),
    matrix AS (SELECT mm.*, e.group_id IS NOT NULL AS extraction_complete, e.retrieval_record_count AS sample_size FROM mm LEFT JOIN (SELECT * FROM dedup_groups WHERE retrieval_record_count > 1) e USING (group_id))"""


def _matrix(spark: SparkSession, folder: str) -> DataFrame:
    included = proposals(spark, folder).filter("proposed_status = 'auto_include' or screening_priority = 5").select("group_id", "conditions", "interventions", "design")
    done = table(spark, folder, "dedup_groups").filter("retrieval_record_count > 1").select("group_id", F.col("retrieval_record_count").alias("sample_size"))
    return funnel.comparison_matrix(included, done)


@query(f"{SQL_MATRIX} SELECT condition, intervention, group_id, design, extraction_complete, sample_size FROM matrix")
def comparison_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return _matrix(spark, folder).select("condition", "intervention", "group_id", "design", "extraction_complete", "sample_size")


@query(f"""{SQL_MATRIX} SELECT condition, intervention, count(DISTINCT group_id) AS groups, count(DISTINCT group_id) FILTER (WHERE extraction_complete) AS extracted, count(DISTINCT design) AS designs FROM matrix GROUP BY ALL""")
def evidence_groups(spark: SparkSession, folder: str) -> DataFrame:
    return funnel.evidence_groups(_matrix(spark, folder)).select("condition", "intervention", "groups", "extracted", F.size("designs").cast("bigint").alias("designs"))


@query(f"""{SQL_ELIGIBILITY} SELECT group_id, design, CASE WHEN design = 'guideline' THEN 10
    WHEN design IN ('systematic_review', 'meta_analysis') THEN 20 WHEN design = 'randomized_controlled_trial' THEN 30 WHEN design IN ('controlled_trial', 'clinical_trial') THEN 40
    WHEN design IN ('cohort_or_longitudinal', 'case_control') THEN 50 WHEN design = 'case_series' THEN 60 WHEN design = 'nonsystematic_review' THEN 70 ELSE 80 END AS priority FROM final WHERE proposed_status = 'auto_include'""")
def priority_rows(spark: SparkSession, folder: str) -> DataFrame:
    return proposals(spark, folder).filter("proposed_status = 'auto_include'").select("group_id", "design", funnel.funnel_priority(F.col("design")).alias("priority"))


SQL_SNAPSHOT = """
    WITH o AS (SELECT year(o_orderdate) - (SELECT min(year(o_orderdate)) FROM orders) AS snapshot, o_custkey, o_orderpriority FROM orders),
    ret AS (SELECT DISTINCT snapshot, o_custkey AS identity FROM o), fam AS (SELECT DISTINCT snapshot, o_orderpriority AS family FROM o),
    n AS (SELECT snapshot, count(*) AS n FROM ret GROUP BY 1),
    ni AS (SELECT snapshot, count(*) AS k FROM ret a WHERE NOT EXISTS (SELECT 1 FROM ret b WHERE b.snapshot = a.snapshot - 1 AND b.identity = a.identity) GROUP BY 1),
    nf AS (SELECT snapshot, count(*) AS k FROM fam a WHERE NOT EXISTS (SELECT 1 FROM fam b WHERE b.snapshot = a.snapshot - 1 AND b.family = a.family) GROUP BY 1),
    rep AS (SELECT c.snapshot, p.n AS previous, coalesce(ni.k, 0) AS new_identities, coalesce(nf.k, 0) AS new_families, coalesce(ni.k, 0) / greatest(p.n, 1) AS new_rate,
        coalesce(nf.k, 0) = 0 AND coalesce(ni.k, 0) / greatest(p.n, 1) < 0.6 AS passes FROM n c JOIN n p ON p.snapshot = c.snapshot - 1 LEFT JOIN ni ON ni.snapshot = c.snapshot LEFT JOIN nf ON nf.snapshot = c.snapshot)"""


def _saturation(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("y", F.year("o_orderdate"))
    first = orders.agg(F.min("y").alias("first"))
    rows = orders.crossJoin(F.broadcast(first)).withColumn("snapshot", (F.col("y") - F.col("first")).cast("bigint"))
    return funnel.saturation(rows.select("snapshot", F.col("o_custkey").alias("identity")), rows.select("snapshot", F.col("o_orderpriority").alias("family")), 0.6)


@query(f"{SQL_SNAPSHOT} SELECT * FROM rep")
def saturation(spark: SparkSession, folder: str) -> DataFrame:
    return _saturation(spark, folder)


@query(f"{SQL_SNAPSHOT} SELECT CAST(count(*) AS INTEGER) AS comparisons, count(*) >= 2 AND bool_and(passes) FILTER (WHERE snapshot >= (SELECT max(snapshot) - 1 FROM rep)) AS saturated FROM rep")
def saturation_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return funnel.is_saturated(_saturation(spark, folder))


_GATES = ["acquisition_records_mapped", "duplicates_resolved", "exclusion_audit_passed", "ledger_audit_ok", "negative_controls_pass", "no_unresolved_states", "search_saturation_pass"]


def sub(sql: str, column: str) -> str:
    """One value of a registered query as a scalar subquery."""
    return f"(SELECT {column} FROM ({sql}))"


@query(f"""
    WITH g AS (SELECT NOT EXISTS (SELECT 1 FROM source_records WHERE acquisition_id NOT IN (SELECT id FROM acquisitions)) AS acquisition_records_mapped,
        NOT EXISTS (SELECT 1 FROM duplicate_pairs WHERE pair_sha256 NOT IN (SELECT pair_sha256 FROM duplicate_decisions)) AS duplicates_resolved,
        {sub(ORACLES['audit_exclusions'], 'passed')} AS exclusion_audit_passed,
        (SELECT bool_and(sha256(request_json) = request_sha256 AND sha256(response_json) = response_sha256) FROM acquisitions) AS ledger_audit_ok,
        {sub(ORACLES['negative_controls'], 'gate')} AS negative_controls_pass, {sub(ORACLES['prisma_counts'], 'awaiting_review')} = 0 AS no_unresolved_states,
        {sub(ORACLES['saturation_verdict'], 'saturated')} AS search_saturation_pass)
    SELECT *, list_sort([x FOR x IN [{', '.join(f"CASE WHEN NOT {n} THEN '{n}' END" for n in _GATES)}] IF x IS NOT NULL]) AS failed_gates,
        {' AND '.join(_GATES)} AS ready, false AS recommendation_authority, false AS ready_for_execution FROM g""")
def screening_readiness(spark: SparkSession, folder: str) -> DataFrame:
    """The seven gates before screening may be used, each from the report that decides it; all inputs are one-row reports."""
    mapped = ledger.missing_references(table(spark, folder, "source_records"), table(spark, folder, "acquisitions"), "acquisition_id", "id")
    open_pairs = ledger.missing_references(table(spark, folder, "duplicate_pairs"), table(spark, folder, "duplicate_decisions"), "pair_sha256", "pair_sha256")
    sound = ledger.acquisition_audit(table(spark, folder, "acquisitions"), table(spark, folder, "source_records"))
    reports = (
        mapped.agg(F.count("*").alias("unmapped")), open_pairs.agg(F.count("*").alias("open")), audit_exclusions(spark, folder).select("passed"),
        sound.agg(F.bool_and(F.col("request_ok") & F.col("response_ok")).alias("sound")), negative_controls(spark, folder).select("gate"),
        proposals(spark, folder).agg(F.count_if(F.col("proposed_status") == "manual_review").alias("awaiting")), saturation_verdict(spark, folder).select("saturated"),
    )
    one = reports[0]
    for report in reports[1:]:
        one = one.crossJoin(report)
    return funnel.gates(
        one,
        {
            "acquisition_records_mapped": F.col("unmapped") == 0, "duplicates_resolved": F.col("open") == 0, "exclusion_audit_passed": F.col("passed"), "ledger_audit_ok": F.col("sound"),
            "negative_controls_pass": F.col("gate"), "no_unresolved_states": F.col("awaiting") == 0, "search_saturation_pass": F.col("saturated"),
        },
        False,
    )


@query("""
    WITH a AS (SELECT l_suppkey, count(*) AS n, count(DISTINCT l_partkey) AS studies, bool_and(l_quantity > 1) AS ok, bool_or(l_discount < 0.01) AS controlled, bool_or(l_returnflag = 'A') AS ben, bool_or(l_returnflag = 'R') AS harm FROM lineitem GROUP BY 1)
    SELECT l_suppkey, n > 0 AS all_sources_appraised, studies >= 2 AS at_least_two_independent_studies, ok AS all_human_verified, ok AS all_full_text_verified, ok AS all_retraction_checked_clear, ok AS all_harms_assessed, ok AS all_conflicts_assessed,
        true AS applicability_established, true AS effect_and_uncertainty_extracted, controlled AS controlled_or_synthesis_evidence, NOT (ben AND harm) AS contradictions_resolved, true AS clinical_review_complete,
        [x FOR x IN [CASE WHEN NOT studies >= 2 THEN 'at_least_two_independent_studies' END, CASE WHEN NOT ok THEN 'all_human_verified' END, CASE WHEN NOT ok THEN 'all_full_text_verified' END, CASE WHEN NOT ok THEN 'all_retraction_checked_clear' END,
            CASE WHEN NOT ok THEN 'all_harms_assessed' END, CASE WHEN NOT ok THEN 'all_conflicts_assessed' END, CASE WHEN NOT controlled THEN 'controlled_or_synthesis_evidence' END, CASE WHEN ben AND harm THEN 'contradictions_resolved' END] IF x IS NOT NULL] AS failed_gates,
        studies >= 2 AND ok AND controlled AND NOT (ben AND harm) AS ready, false AS recommendation_authority, false AS ready_for_execution FROM a""")
def candidate_gates(spark: SparkSession, folder: str) -> DataFrame:
    """The gates of one candidate per supplier, its appraisals all the supplier's order lines."""
    ok = F.col("l_quantity") > 1
    rows = table(spark, folder, "lineitem").select(
        "l_suppkey", F.col("l_partkey").alias("study_id"), ok.alias("human_verified"), ok.alias("full_text_verified"), F.when(ok, "clear").otherwise("unknown").alias("retraction_status"), ok.alias("harms_assessed"),
        ok.alias("conflicts_assessed"), F.lit("direct").alias("applicability"), F.lit("x").alias("effect_estimate"), F.lit("y").alias("confidence_interval"), F.when(F.col("l_discount") < 0.01, "T1").otherwise("T4").alias("tier"),
        F.when(F.col("l_returnflag") == "A", "beneficial").when(F.col("l_returnflag") == "R", "harmful").otherwise("unknown").alias("direction"),
    )
    return funnel.appraisal_gates(rows, contradictions_addressed=False, clinician_reviewed=True, by=("l_suppkey",))


SQL_REVIEW = f"""{SQL_ELIGIBILITY},
    clean AS (SELECT group_id, coalesce(nullif(trim(regexp_replace(regexp_replace(replace(replace(abstract, '&amp;', '&'), '&#37;', '%'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), ''), '') AS text FROM final),
    dec AS (SELECT group_id, CASE WHEN length(title) % 3 = 0 THEN 'exclude' ELSE 'include' END AS decision, ['CHECKED', 'BY_HAND'] AS reasons, 'reviewer-' || year % 3 AS reviewed_by FROM final WHERE year % 2 = 0)"""


def review_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Proposals, and decisions on the groups of even years."""
    rows = proposals(spark, folder)
    decided = rows.filter("year % 2 = 0").select(
        "group_id", F.when(F.length("title") % 3 == 0, "exclude").otherwise("include").alias("decision"), F.array(F.lit("CHECKED"), F.lit("BY_HAND")).alias("reason_codes"),
        F.concat(F.lit("reviewer-"), (F.col("year") % 3).cast("string")).alias("reviewed_by"),
    )
    return rows, decided


@query(f"""{SQL_REVIEW}
    SELECT group_id, title, year, text <> '' AS abstract_available, sha256(text) AS abstract_sha256, proposed_status, array_to_string(reason_codes, '|') AS proposal_reasons, design AS design_bucket,
        array_to_string(conditions, '|') AS condition_concepts, array_to_string(interventions, '|') AS intervention_concepts, array_to_string(outcomes, '|') AS outcome_concepts,
        coalesce(decision, '') AS human_decision, CASE WHEN decision IS NULL THEN '' ELSE 'CHECKED|BY_HAND' END AS human_reason_codes, coalesce(reviewed_by, '') AS reviewed_by, false AS effectiveness_authority
    FROM final JOIN clean USING (group_id) LEFT JOIN dec USING (group_id)""")
def screening_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows, decided = review_inputs(spark, folder)
    return funnel.screening_rows(rows, rows, rows, decided)


@query(f"""{SQL_REVIEW},
    sel AS (SELECT group_id FROM dec WHERE decision = 'include'), ext AS (SELECT group_id, CASE WHEN length(title) % 11 = 0 THEN 'unclear' ELSE 'low' END AS risk FROM final JOIN sel USING (group_id)),
    g AS (SELECT NOT EXISTS (SELECT 1 FROM duplicate_pairs WHERE pair_sha256 NOT IN (SELECT pair_sha256 FROM duplicate_decisions)) AS duplicate_decisions_complete,
        (SELECT count(*) FROM final WHERE group_id NOT IN (SELECT group_id FROM dec)) = 0 AS eligibility_decisions_complete, (SELECT count(*) FROM sel) > 0 AS included_full_text_extractions_complete,
        (SELECT count(*) FROM sel) > 0 AND (SELECT bool_and(risk <> 'unclear') FROM ext) AS risk_of_bias_complete, (SELECT count(*) FROM sel) > 0 AS effect_estimates_source_located,
        (SELECT count(*) FROM sel) > 0 AND (SELECT bool_and(trim(title) <> '') FROM final JOIN sel USING (group_id)) AS harms_and_conflicts_extracted, false AS human_synthesis_signoff)
    SELECT *, list_sort([x FOR x IN [CASE WHEN NOT duplicate_decisions_complete THEN 'duplicate_decisions_complete' END, CASE WHEN NOT eligibility_decisions_complete THEN 'eligibility_decisions_complete' END,
        CASE WHEN NOT included_full_text_extractions_complete THEN 'included_full_text_extractions_complete' END, CASE WHEN NOT risk_of_bias_complete THEN 'risk_of_bias_complete' END,
        CASE WHEN NOT effect_estimates_source_located THEN 'effect_estimates_source_located' END, CASE WHEN NOT harms_and_conflicts_extracted THEN 'harms_and_conflicts_extracted' END, 'human_synthesis_signoff'] IF x IS NOT NULL]) AS failed_gates,
        false AS ready, false AS recommendation_authority, false AS ready_for_execution FROM g""")
def funnel_gates(spark: SparkSession, folder: str) -> DataFrame:
    """The gates of a funnel in which every included group has an extraction made of its own columns and nobody signed off yet."""
    rows, decided = review_inputs(spark, folder)
    selected = decided.filter("decision = 'include'").select("group_id")
    done = rows.join(selected, "group_id", "left_semi").select(
        "group_id", F.when(F.length("title") % 11 == 0, "unclear").otherwise("low").alias("risk_of_bias"), F.array(F.lit("1.0")).alias("effect_estimates"), F.array("group_id").alias("source_locators"),
        F.col("title").alias("adverse_events"), F.col("title").alias("conflicts"),
    )
    open_pairs = ledger.missing_references(table(spark, folder, "duplicate_pairs"), table(spark, folder, "duplicate_decisions"), "pair_sha256", "pair_sha256")
    resolved = bool(open_pairs.limit(1).count() == 0)
    return funnel.funnel_gates(selected, done, F.lit(resolved), rows.select("group_id").join(decided.select("group_id"), "group_id", "left_anti"), F.lit(False))


@query(f"""{SQL_FEATURES},
    ret AS (SELECT pmid, min(raw_json ->> '$.abstract') AS fetched FROM source_records WHERE pmid IS NOT NULL AND lower(identity_key) NOT LIKE 'pmid:%' GROUP BY pmid),
    hold AS (SELECT pmid, count(*) AS n FROM feat WHERE pmid IS NOT NULL GROUP BY pmid),
    en AS (SELECT group_id, title, negative_control, trim(coalesce(abstract, '')) = '' AND n = 1 AND trim(coalesce(fetched, '')) <> '' AS abstract_enriched, abstract, fetched FROM feat LEFT JOIN hold USING (pmid) LEFT JOIN ret USING (pmid)),
    told AS (SELECT *, lower(concat_ws(' ', title, CASE WHEN abstract_enriched THEN fetched ELSE abstract END)) AS body FROM en)
    SELECT group_id, coalesce(abstract_enriched, false) AS abstract_enriched, {sql_concepts('conditions')} AS conditions, {sql_concepts('interventions')} AS interventions, {sql_concepts('outcomes', ('function',))} AS outcomes,
        {sql_design('body')} AS design FROM told""")
def enriched_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features made anew after abstracts that other records of a pmid have were applied to groups without one."""
    others = table(spark, folder, "source_records").filter("pmid is not null and lower(identity_key) not like 'pmid:%'")
    fetched = others.groupBy("pmid").agg(F.min(F.get_json_object("raw_json", "$.abstract")).alias("abstract"))
    groups = funnel.apply_enrichments(described_groups(spark, folder), fetched).drop("body")
    found = screening.extract_features(groups, ONTOLOGY, "title", "abstract", excluded=CONTROL_ONLY).withColumn("design", N.design_bucket(F.concat_ws(" ", "title", "abstract")))
    return found.select("group_id", "abstract_enriched", "conditions", "interventions", "outcomes", "design")


@query(r"""
    SELECT CASE WHEN regexp_matches(d, 'guideline') THEN 'guideline' WHEN regexp_matches(d, 'systematic review|meta-analysis') THEN 'systematic_review_or_meta_analysis'
        WHEN contains(d, 'randomized controlled trial') THEN 'randomized_controlled_trial' WHEN contains(d, 'clinical trial') THEN 'clinical_trial' WHEN contains(d, 'review') THEN 'nonsystematic_review'
        WHEN trial THEN 'trial_registry_record' ELSE 'primary_or_other' END AS design, kind, count(*) AS records FROM
        (SELECT DISTINCT id, kind, lower(coalesce(regexp_extract(title, ':\s*([^:]*)$', 1), '')) AS d, kind = 'trial' AS trial FROM source_records) GROUP BY ALL""")
def plain_designs(spark: SparkSession, folder: str) -> DataFrame:
    """Records by the older buckets; what stands behind a title's last colon is taken for its publication type."""
    rows = table(spark, folder, "source_records").select("id", "kind", "title").distinct()
    kind = F.array_compact(F.array(F.nullif(F.regexp_extract("title", r":\s*([^:]*)$", 1), F.lit(""))))
    return rows.groupBy(N.plain_design(kind, F.col("kind") == "trial").alias("design"), "kind").agg(F.count("*").alias("records"))
