"""Command line: every command reads tables or files, runs one operator and writes its result.

Exit 0: done; 1: a gate or audit failed; 2: wrong input.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.operators import contracts, funnel, ledger, screening
from siftlake.plans import campaign, dedup_queries, ledger_queries, registry, screening_queries
from siftlake.session import local_session
from siftlake.sources import captured, files, sinks
from siftlake.streaming import ingest


def _put(df: DataFrame, out: str | None) -> None:
    """Write a relation as canonical JSONL, or show its first rows."""
    if out:
        sinks.write_jsonl(df, out)
    else:
        for row in df.limit(100).toJSON().toLocalIterator():
            print(row)


def compile_search(args, spark: SparkSession) -> int:
    ontology = campaign.validate_ontology(campaign.load(args.ontology))
    spec = campaign.validate_specification(campaign.load(args.specification), ontology)
    manifest = campaign.compile_manifest(campaign.validate_campaign(campaign.load(args.campaign)), ontology, spec, tuple(args.providers))
    sinks.write_json(manifest, args.out) if args.out else print(json.dumps(manifest, indent=2, sort_keys=True))
    return 0


def plan(args, spark: SparkSession) -> int:
    document = campaign.validate_campaign(campaign.load(args.campaign))
    chosen = campaign.select_queries(document, set(args.phase) or None, args.query or None, args.max_requests)
    print(json.dumps(campaign.plan(campaign.provider_jobs(chosen, tuple(args.providers)), args.cap), indent=2, sort_keys=True))
    return 0


def import_responses(args, spark: SparkSession) -> int:
    """Captured responses into the ledger: new acquisitions and their records are appended, known ones are left alone."""
    batch = ledger.acquisition_rows(captured.read_captured(spark, args.path))
    for name, rows in (("acquisitions", batch), ("source_records", ledger.record_rows(batch))):
        target = f"{args.ledger}/{name}.parquet"
        try:
            rows = ledger.append_new(spark.read.parquet(target), rows)
        except Exception as missing:  # noqa: BLE001 - the first import creates the table
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            rows = rows.dropDuplicates(["id"])
        rows.write.mode("append").parquet(target)
    return 0


#: What a screening run leaves behind, by the query that makes it.
ARTEFACTS = (
    "scan_join_canonical", "golden_record", "term_match_concepts", "study_mentions", "eligibility_rules", "screening_rows", "fuzzy_pairs", "exclusion_sample", "abstract_queue", "fulltext_routes",
    "negative_controls", "prisma_counts",
)


def screen(args, spark: SparkSession) -> int:
    """All artefacts of a ledger's folder, and a receipt (file, bytes, hash) of each."""
    receipts = None
    for name in ARTEFACTS:
        _put(registry.QUERIES[name](spark, args.tables), args.out and f"{args.out}/{name}")
        if args.out:
            own = sinks.receipt(spark, f"{args.out}/{name}").withColumn("artefact", F.lit(name))
            receipts = own if receipts is None else receipts.unionByName(own)
    if receipts is not None:
        sinks.write_jsonl(receipts, f"{args.out}/receipts")
    return 0


def source(args, spark: SparkSession) -> int:
    """One source record by its id."""
    found = ledger.lookup(spark.read.parquet(f"{args.tables}/source_records.parquet"), "id", args.id)
    _put(found, args.out)
    return 0 if found.count() else 1


def sources(args, spark: SparkSession) -> int:
    """The latest sources."""
    _put(registry.QUERIES["source_list_topn"](spark, args.tables), args.out)
    return 0


def status(args, spark: SparkSession) -> int:
    """Rows of each ledger table."""
    _put(registry.QUERIES["ledger_counts"](spark, args.tables), args.out)
    return 0


def ledger_audit(args, spark: SparkSession) -> int:
    """All checks of all ledger tables; fails if one does."""
    report = registry.QUERIES["ledger_audit"](spark, args.tables)
    _put(report, args.out)
    return 1 if report.filter("failures > 0").limit(1).count() else 0


def take_in(args, spark: SparkSession) -> int:
    """New response files of a folder into a ledger, under a budget of records."""
    print(ingest.ingest(spark, args.path, args.ledger, args.most_records))
    return 0


def check_documents(args, spark: SparkSession) -> int:
    """Documents, one JSON object a line, that break the contract of appraisals or extractions."""
    contract = {"appraisal": contracts.appraisal_contract, "extraction": contracts.extraction_contract}[args.contract](args.version)
    bad = spark.read.text(args.path).select("value", contract.breaches(F.col("value")).alias("breaches")).filter(F.size("breaches") > 0)
    _put(bad, args.out)
    return 1 if bad.limit(1).count() else 0


def refused(args, spark: SparkSession) -> int:
    """XML files that no reader takes, with the reason."""
    bad = files.refused_documents(spark, args.path, args.root)
    _put(bad, args.out)
    return 1 if bad.limit(1).count() else 0


def import_documents(args, spark: SparkSession) -> int:
    """Local files with their size and SHA-256."""
    _put(files.read_documents(spark, args.path), args.out)
    return 0


def run_query(args, spark: SparkSession) -> int:
    if args.name not in registry.QUERIES:
        raise campaign.ConfigError(f"no query {args.name}; there are {', '.join(sorted(registry.QUERIES))}")
    _put(registry.QUERIES[args.name](spark, args.tables), args.out)
    return 0


def audit(args, spark: SparkSession) -> int:
    rows = ledger_queries.acquisition_audit(spark, args.tables)
    bad = rows.filter(~(F.col("request_ok") & F.col("response_ok") & F.col("count_ok")) | (F.col("deliveries") > 1))
    _put(bad, args.out)
    return 1 if bad.limit(1).count() else 0


def readiness(args, spark: SparkSession) -> int:
    report = screening_queries.screening_readiness(spark, args.tables)
    _put(report, args.out)
    return 0 if report.filter("ready").count() else 1


def audit_exclusions(args, spark: SparkSession) -> int:
    done = files.read_csv(spark, args.completed, ["group_id", "human_audit_decision"]).withColumn("human_audit_decision", F.lower(F.trim("human_audit_decision")))
    sample = screening_queries.exclusion_sample(spark, args.tables)
    report = screening.audit_exclusions(sample, done, "group_id", "human_audit_decision", args.maximum_rate)
    _put(report, args.out)
    return 0 if report.filter("passed").count() else 1


def saturation(args, spark: SparkSession) -> int:
    rows = files.read_jsonl(spark, args.snapshots, "snapshot bigint, identity string, family string")
    report = funnel.saturation(rows.select("snapshot", "identity"), rows.select("snapshot", "family"), args.maximum_rate)
    _put(report, args.out)
    return 0 if funnel.is_saturated(report).filter("saturated").count() else 1


def extract_pmc(args, spark: SparkSession) -> int:
    _put(files.pmc_sections(spark, args.path), args.out)
    return 0


def merge_abstracts(args, spark: SparkSession) -> int:
    _put(funnel.enrich(screening_queries.features(spark, args.tables), files.pubmed_abstracts(spark, args.path)), args.out)
    return 0


def state(args, spark: SparkSession) -> int:
    _put(ledger_queries.state_counts(spark, args.tables), args.out)
    return 0


def decisions(args, spark: SparkSession) -> int:
    report = dedup_queries.decision_report(spark, args.tables)
    _put(report, args.out)
    return 0 if report.filter("complete").count() else 1


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siftlake", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, f, *arguments: tuple[tuple, dict]) -> None:
        own = commands.add_parser(name, help=(f.__doc__ or name).splitlines()[0])
        for flags, options in arguments:
            own.add_argument(*flags, **options)
        own.add_argument("--out")
        own.set_defaults(run=f)

    tables, need = (("--tables",), {"required": True}), lambda n: ((n,), {"required": True})
    providers = (("--providers",), {"nargs": "+", "default": ["europe_pmc", "pubmed", "openalex"]})
    add("compile-search", compile_search, need("--campaign"), need("--ontology"), need("--specification"), providers)
    add("plan", plan, need("--campaign"), (("--phase",), {"type": int, "nargs": "*", "default": []}), (("--query",), {"nargs": "*", "default": []}), (("--max-requests",), {"type": int}), (("--cap",), {"type": int, "default": ledger.RECORD_CAP}), providers)
    add("import-response", import_responses, need("--path"), need("--ledger"))
    add("screen", screen, tables)
    add("query", run_query, (("name",), {}), tables)
    add("audit", audit, tables)
    add("readiness", readiness, tables)
    add("validate-exclusion-audit", audit_exclusions, tables, need("--completed"), (("--maximum-rate",), {"type": float, "default": 0.0}))
    add("saturation", saturation, need("--snapshots"), (("--maximum-rate",), {"type": float, "default": 0.01}))
    add("extract-pmc", extract_pmc, need("--path"))
    add("merge-abstracts", merge_abstracts, tables, need("--path"))
    add("state", state, tables)
    add("duplicate-decisions", decisions, tables)
    add("source", source, tables, need("--id"))
    add("sources", sources, tables)
    add("status", status, tables)
    add("ledger-audit", ledger_audit, tables)
    add("ingest", take_in, need("--path"), need("--ledger"), (("--most-records",), {"type": int}))
    add("check-documents", check_documents, need("--path"), need("--version"), (("--contract",), {"choices": ("appraisal", "extraction"), "required": True}))
    add("refused-documents", refused, need("--path"), (("--root",), {}))
    add("import-document", import_documents, need("--path"))
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return args.run(args, spark or local_session())
    except (campaign.ConfigError, FileNotFoundError, FileExistsError) as wrong:
        print(f"error: {wrong}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
