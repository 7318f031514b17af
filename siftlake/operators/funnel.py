"""Review funnel: retrieval queues, enrichment, comparison matrix, saturation and fail-closed gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftlake.functions.normalise import clean_abstract
from siftlake.session import stage

#: Place of each design in the reading queue.
PRIORITY = {
    "guideline": 10, "systematic_review": 20, "meta_analysis": 20, "randomized_controlled_trial": 30, "controlled_trial": 40, "clinical_trial": 40,
    "cohort_or_longitudinal": 50, "case_control": 50, "case_series": 60, "nonsystematic_review": 70, "protocol": 80, "primary_or_other": 80,
}


def funnel_priority(design: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in PRIORITY.items() for x in p)), design), F.lit(80))


def abstract_queue(groups: DataFrame) -> DataFrame:
    """Groups not excluded and without an abstract: their retrieval routes by priority, or ``no_machine_identifier``."""
    routes = F.array_compact(
        F.array(
            F.when(F.col("pmid").isNotNull(), F.struct(F.lit(10).alias("priority"), F.lit("pubmed").alias("route"), F.col("pmid").alias("value"))),
            F.when(F.col("pmcid").isNotNull(), F.struct(F.lit(20).alias("priority"), F.lit("europe_pmc").alias("route"), F.col("pmcid").alias("value"))),
            F.when(F.col("doi").isNotNull(), F.struct(F.lit(30).alias("priority"), F.lit("crossref_or_openalex").alias("route"), F.col("doi").alias("value"))),
        )
    )
    open_ = groups.filter((F.col("proposed_status") != "auto_exclude") & (F.trim(F.coalesce("abstract", F.lit(""))) == ""))
    return open_.select("group_id", routes.alias("routes")).withColumn("status", F.when(F.size("routes") > 0, "pending").otherwise("no_machine_identifier"))


def id_batches(ids: DataFrame, column: str, size: int = 200) -> DataFrame:
    """Distinct numeric ids in ascending order, cut into numbered batches.

    Ranks within a range partition plus the counts of the partitions before give the global order without a single task.
    """
    ranged = ids.select(F.col(column).cast("bigint").alias("n")).filter("n is not null").distinct().repartitionByRange("n").sortWithinPartitions("n")
    # Staged, so that the partition numbers are those of one run, whatever the plans below make of it.
    part = stage(ranged.withColumn("p", F.spark_partition_id()), "ranged")
    counts = part.groupBy("p").count().withColumn("before", F.coalesce(F.sum("count").over(W.orderBy("p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    ranked = part.withColumn("r", F.row_number().over(W.partitionBy("p").orderBy("n")))
    return ranked.join(F.broadcast(counts.select("p", "before")), "p").select(F.col("n").alias(column), F.floor((F.col("before") + F.col("r") - 1) / size).cast("int").alias("batch"))


def enrich(groups: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Each retrieved abstract with what becomes of it: ``applied``, or the conflict that forbids it.

    A pmid that stands in several groups, or in none, an empty abstract, or a group that already has another abstract is a conflict;
    an equal abstract is ``unchanged``.  Existing abstracts are never overwritten.
    """
    holders = groups.filter(F.col("pmid").isNotNull()).groupBy("pmid").agg(F.count("*").alias("holders"), F.min("group_id").alias("group_id"), F.min("abstract").alias("held"))
    text = F.trim(F.coalesce("abstract", F.lit("")))
    found = retrieved.join(holders, "pmid", "left")
    outcome = (
        F.when(F.col("holders").isNull(), "group_not_found").when(F.col("holders") > 1, "identifier_not_unique").when(text == "", "abstract_empty")
        .when(F.trim(F.coalesce("held", F.lit(""))) == "", "applied").when(F.col("held") == F.col("abstract"), "unchanged").otherwise("existing_abstract_differs")
    )
    return found.select("pmid", F.when(F.col("holders") == 1, F.col("group_id")).alias("group_id"), outcome.alias("outcome"))


def apply_enrichments(groups: DataFrame, retrieved: DataFrame) -> DataFrame:
    """``groups`` with the abstracts that ``enrich`` applies, and ``abstract_enriched``; features and proposals must be made anew from them.

    Of a pmid that was retrieved twice the smallest abstract counts.
    """
    once = retrieved.groupBy("pmid").agg(F.min("abstract").alias("abstract"))
    applied = enrich(groups, once).filter("outcome = 'applied'").select("pmid", "group_id").join(once, "pmid").select("group_id", F.col("abstract").alias("_new"))
    joined = groups.join(applied, "group_id", "left")
    return joined.withColumn("abstract_enriched", F.col("_new").isNotNull()).withColumn("abstract", F.coalesce("_new", "abstract")).drop("_new")


def full_text_routes(groups: DataFrame) -> DataFrame:
    """Routes to a group's full text, one per type and address (the last given wins), by priority."""
    doi_url = F.concat(F.lit("https://doi.org/"), F.col("doi"))
    fixed = F.array(
        F.when(F.col("pmcid").isNotNull(), _route("europe_pmc_xml", 10, F.concat(F.lit("https://europepmc.org/articles/"), "pmcid"), True)),
        F.when(F.col("nct_id").isNotNull(), _route("trial_registry", 30, F.concat(F.lit("https://clinicaltrials.gov/study/"), "nct_id"), False)),
        F.when(F.col("doi").isNotNull(), _route("publisher_doi", 40, doi_url, False)),
    )
    pdfs = F.transform(F.filter("urls", lambda u: F.endswith(F.lower(u), F.lit(".pdf"))), lambda u: _route("open_pdf", 20, u, True))
    pages = F.transform(F.filter("urls", lambda u: ~F.endswith(F.lower(u), F.lit(".pdf"))), lambda u: _route("landing_page", 50, u, False))
    every = F.array_distinct(F.concat(F.array_compact(fixed), F.coalesce(pdfs, F.array().cast(_ROUTES)), F.coalesce(pages, F.array().cast(_ROUTES))))
    manual = F.array(_route("manual_library_request", 90, F.lit(None).cast("string"), False))
    return groups.select("group_id", F.explode(F.when(F.size(every) > 0, every).otherwise(manual)).alias("r")).select("group_id", "r.*")


_ROUTES = "array<struct<route_type:string,priority:int,url:string,automated:boolean>>"


def _route(kind: str, priority: int, url: Column, automated: bool) -> Column:
    return F.struct(F.lit(kind).alias("route_type"), F.lit(priority).alias("priority"), url.alias("url"), F.lit(automated).alias("automated"))


def comparison_matrix(included: DataFrame, extractions: DataFrame) -> DataFrame:
    """Included groups by condition and intervention (``unclassified`` where none), with their extraction if there is one."""
    other = F.array(F.lit("unclassified"))
    rows = included.withColumn("condition", F.explode(F.when(F.size("conditions") > 0, F.col("conditions")).otherwise(other)))
    rows = rows.withColumn("intervention", F.explode(F.when(F.size("interventions") > 0, F.col("interventions")).otherwise(other)))
    done = extractions.withColumn("_done", F.lit(True))
    joined = rows.join(done, "group_id", "left")
    return joined.withColumn("extraction_complete", F.coalesce("_done", F.lit(False))).withColumn("recommendation_authority", F.lit(False)).drop("_done")


def evidence_groups(matrix: DataFrame) -> DataFrame:
    """Per condition and intervention: distinct groups, groups by design, extracted ones."""
    by_design = matrix.groupBy("condition", "intervention", "design").agg(F.count_distinct("group_id").alias("n"))
    designs = by_design.groupBy("condition", "intervention").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("design", "n")))).alias("designs"))
    whole = matrix.groupBy("condition", "intervention").agg(
        F.count_distinct("group_id").alias("groups"), F.count_distinct(F.when(F.col("extraction_complete"), F.col("group_id"))).alias("extracted")
    )
    return whole.join(designs, ["condition", "intervention"])


def saturation(retained: DataFrame, families: DataFrame, maximum_rate: float = 0.01) -> DataFrame:
    """Per snapshot (numbered): new identities and families against the snapshot before, the rate and whether it passes.

    ``retained(snapshot, identity)`` and ``families(snapshot, family)``; the first snapshot has nothing to be compared with and no row.
    """

    def new(rows: DataFrame, column: str) -> DataFrame:
        own = rows.select("snapshot", column).distinct()
        before = own.select((F.col("snapshot") + 1).alias("snapshot"), column)
        return own.join(before, ["snapshot", column], "left_anti").groupBy("snapshot").agg(F.count("*").alias(f"new_{column}"))

    sizes = retained.select("snapshot", "identity").distinct().groupBy("snapshot").agg(F.count("*").alias("n"))
    pairs = sizes.select((F.col("snapshot") + 1).alias("snapshot"), F.col("n").alias("previous")).join(sizes.select("snapshot"), "snapshot")
    joined = pairs.join(new(retained, "identity"), "snapshot", "left").join(new(families, "family"), "snapshot", "left")
    zero = F.lit(0).cast("bigint")
    counted = joined.select("snapshot", "previous", F.coalesce("new_identity", zero).alias("new_identities"), F.coalesce("new_family", zero).alias("new_families"))
    rate = F.col("new_identities") / F.greatest("previous", F.lit(1).cast("bigint"))
    return counted.withColumn("new_rate", rate).withColumn("passes", (F.col("new_families") == 0) & (rate < maximum_rate))


def is_saturated(report: DataFrame) -> DataFrame:
    """Whether at least three snapshots exist and the last two comparisons pass."""
    last = report.agg(F.array_sort(F.collect_list(F.struct("snapshot", "passes"))).alias("s"))
    return last.select(F.size("s").alias("comparisons"), F.coalesce((F.size("s") >= 2) & F.try_element_at("s", F.lit(-1))["passes"] & F.try_element_at("s", F.lit(-2))["passes"], F.lit(False)).alias("saturated"))


def gates(row: DataFrame, conditions: dict[str, Column], in_order: bool, by: tuple[str, ...] = ()) -> DataFrame:
    """Named gates of each row, beside its keys ``by``: each boolean (null counts as failed), the failed ones and whether all hold.

    Failed gates keep the order of declaration, or are sorted.  Authority is never granted.
    """
    flags = {name: F.coalesce(c, F.lit(False)) for name, c in conditions.items()}
    failed = F.array_compact(F.array(*(F.when(~c, name) for name, c in flags.items())))
    told = row.select(*by, *(c.alias(n) for n, c in flags.items()), (failed if in_order else F.array_sort(failed)).alias("failed_gates"))
    return told.withColumn("ready", F.size("failed_gates") == 0).withColumn("recommendation_authority", F.lit(False)).withColumn("ready_for_execution", F.lit(False))


def appraisal_gates(appraisals: DataFrame, contradictions_addressed: bool, clinician_reviewed: bool, by: tuple[str, ...] = ()) -> DataFrame:
    """The twelve gates of each candidate over its appraisals (one candidate unless ``by`` names its keys); all of them fail on no appraisals.

    Every aggregate combines before the shuffle; the set of directions holds a few words.
    """
    every = lambda c: F.bool_and(c)
    one = appraisals.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_distinct("study_id").alias("studies"), every(F.col("human_verified")).alias("verified"), every(F.col("full_text_verified")).alias("full"),
        every(F.col("retraction_status") == "clear").alias("clear"), every(F.col("harms_assessed")).alias("harms"), every(F.col("conflicts_assessed")).alias("conflicts"),
        every(F.col("applicability").isin("direct", "partial")).alias("applicable"), every(F.col("effect_estimate").isNotNull() & F.col("confidence_interval").isNotNull()).alias("effects"),
        F.bool_or(F.col("tier").isin("T1", "T2")).alias("controlled"), F.collect_set("direction").alias("directions"),
    )
    has = lambda d: F.array_contains("directions", d)
    contradiction = has("mixed") | (has("beneficial") & (has("neutral") | has("harmful")))
    present = F.col("n") > 0
    return gates(
        one,
        {
            "all_sources_appraised": present, "at_least_two_independent_studies": F.col("studies") >= 2, "all_human_verified": present & F.col("verified"),
            "all_full_text_verified": present & F.col("full"), "all_retraction_checked_clear": present & F.col("clear"), "all_harms_assessed": present & F.col("harms"),
            "all_conflicts_assessed": present & F.col("conflicts"), "applicability_established": present & F.col("applicable"), "effect_and_uncertainty_extracted": present & F.col("effects"),
            "controlled_or_synthesis_evidence": F.col("controlled"), "contradictions_resolved": present & (~contradiction | F.lit(contradictions_addressed)),
            "clinical_review_complete": F.lit(clinician_reviewed),
        },
        True,
        by,
    )


def set_equal(left: Column, right: Column) -> Column:
    """Whether two arrays hold the same values."""
    return (F.size(F.array_except(left, right)) == 0) & (F.size(F.array_except(right, left)) == 0)


def is_subset(part: Column, whole: Column) -> Column:
    """Whether all values of an array stand in another; an empty one is in any, a null one in none."""
    return F.coalesce(F.size(F.array_except(part, whole)) == 0, F.lit(False))


def screening_rows(groups: DataFrame, proposals: DataFrame, features: DataFrame, decisions: DataFrame) -> DataFrame:
    """The wide review row of each group: proposal, concepts and reasons as piped lists, the hash of its cleaned abstract, and the decision if there is one.

    A group without proposal or features has none of theirs (nulls); undecided groups have empty decisions.
    """
    text = F.coalesce(clean_abstract(F.col("abstract")), F.lit(""))
    piped = lambda c: F.coalesce(F.array_join(c, "|"), F.lit(""))
    own = groups.select("group_id", "title", "year", (text != "").alias("abstract_available"), F.sha2(text, 256).alias("abstract_sha256"))
    proposed = proposals.select("group_id", "proposed_status", piped("reason_codes").alias("proposal_reasons"))
    told = features.select("group_id", F.col("design").alias("design_bucket"), *(piped(k).alias(f"{k[:-1]}_concepts") for k in ("conditions", "interventions", "outcomes")))
    said = decisions.select("group_id", F.col("decision").alias("human_decision"), piped("reason_codes").alias("human_reason_codes"), "reviewed_by")
    joined = own.join(proposed, "group_id", "left").join(told, "group_id", "left").join(said, "group_id", "left")
    blank = {c: F.coalesce(c, F.lit("")) for c in ("human_decision", "human_reason_codes", "reviewed_by")}
    return joined.withColumns(blank).withColumn("effectiveness_authority", F.lit(False))


def funnel_gates(selected: DataFrame, extractions: DataFrame, duplicates_complete: Column, unresolved: DataFrame, signed_off: Column) -> DataFrame:
    """The seven gates before a synthesis: one row, all counts and conditions combined before the shuffle.

    ``selected(group_id)`` are the included groups; ``extractions`` have ``group_id, risk_of_bias, effect_estimates, source_locators, adverse_events, conflicts``; both count a
    group once.  Extractions are complete where exactly the selected groups have one.
    """
    both = selected.select("group_id").distinct().withColumn("_s", F.lit(True)).join(extractions.dropDuplicates(["group_id"]).withColumn("_e", F.lit(True)), "group_id", "full")
    filled = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    said = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    one = both.agg(
        F.count_if(F.col("_s").isNotNull()).alias("selected"), F.count_if(F.col("_s").isNull() | F.col("_e").isNull()).alias("apart"),
        F.bool_and(F.coalesce(F.col("risk_of_bias") != "unclear", F.lit(False))).alias("risk"), F.bool_and(filled("effect_estimates") & filled("source_locators")).alias("located"),
        F.bool_and(said("adverse_events") & said("conflicts")).alias("harms"),
    ).crossJoin(unresolved.agg(F.count("*").alias("unresolved")))
    whole = (F.col("selected") > 0) & (F.col("apart") == 0)
    return gates(
        one,
        {
            "duplicate_decisions_complete": duplicates_complete, "eligibility_decisions_complete": F.col("unresolved") == 0, "included_full_text_extractions_complete": whole,
            "risk_of_bias_complete": whole & F.col("risk"), "effect_estimates_source_located": whole & F.col("located"), "harms_and_conflicts_extracted": whole & F.col("harms"),
            "human_synthesis_signoff": signed_off,
        },
        False,
    )
