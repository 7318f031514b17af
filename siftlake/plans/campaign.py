"""Search campaigns: validated configuration, compiled provider queries, job plans and budgets.

Configuration documents are small and live on the driver; what they expand to becomes a DataFrame.
"""

from __future__ import annotations

import hashlib
import json
import math
from typing import Any

from pyspark.sql import DataFrame, SparkSession

PAPER_PROVIDERS = ("europe_pmc", "pubmed", "semantic_scholar", "openalex", "crossref", "unpaywall", "elicit")
TRIAL_PROVIDERS = ("clinical_trials",)
KINDS = ("conditions", "interventions", "outcomes")
CONCEPT_FIELDS = ("condition_concepts", "intervention_concepts", "outcome_concepts")


class ConfigError(ValueError):
    """A configuration document that breaks its closed schema."""


def canonical(value: Any) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False)


def digest(value: Any) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def closed(value: Any, required: set[str], optional: set[str] = frozenset(), what: str = "document") -> dict:
    """``value`` itself if it is an object with exactly the allowed fields."""
    if not isinstance(value, dict):
        raise ConfigError(f"{what} must be an object")
    if missing := required - value.keys():
        raise ConfigError(f"{what} lacks {sorted(missing)}")
    if unknown := value.keys() - required - set(optional):
        raise ConfigError(f"{what} has unknown fields {sorted(unknown)}")
    return value


def load(path: str) -> dict:
    """A JSON object from a file."""
    with open(path, encoding="utf-8") as file:
        value = json.load(file)
    if not isinstance(value, dict):
        raise ConfigError(f"{path} must hold an object")
    return value


def validate_ontology(value: Any) -> dict:
    """Concepts by kind; ids unique across kinds, terms non-empty and distinct."""
    document = closed(value, {"schema_version", "ontology_id", "version", *KINDS}, what="ontology")
    seen: set[str] = set()
    for kind in KINDS:
        for concept, body in document[kind].items():
            closed(body, {"terms"}, {"subject_headings"}, f"concept {concept}")
            terms = [t.strip() for t in body["terms"]]
            if not terms or "" in terms or len({t.casefold() for t in terms}) < len(terms):
                raise ConfigError(f"terms of {concept} must be non-empty and distinct")
            if concept in seen:
                raise ConfigError(f"concept {concept} is defined twice")
            seen.add(concept)
    return document


def validate_specification(value: Any, ontology: dict) -> dict:
    """Queries and negative controls whose concepts exist in the right kind."""
    document = closed(value, {"campaign_id", "ontology_id", "ontology_version", "queries", "negative_controls"}, {"schema_version"}, "specification")
    if not document["queries"] or not document["negative_controls"]:
        raise ConfigError("a specification needs queries and negative controls")
    ids = [q["id"] for part in ("queries", "negative_controls") for q in document[part]]
    if len(set(ids)) < len(ids):
        raise ConfigError("query ids must be unique")
    for q in (*document["queries"], *document["negative_controls"]):
        for kind, field in zip(KINDS, CONCEPT_FIELDS):
            if wrong := [c for c in q.get(field, []) if c not in ontology[kind]]:
                raise ConfigError(f"{q['id']}: unknown {kind} {wrong}")
        if q.get("require_outcomes") and not q.get("outcome_concepts"):
            raise ConfigError(f"{q['id']} requires outcomes but names none")
    return document


def validate_campaign(value: Any) -> dict:
    """Campaign with the defaults merged into each query; ids unique, sizes within the providers' limits."""
    document = closed(value, {"campaign_id", "protocol", "created_at", "execution_state", "completion_rule", "defaults", "queries"}, {"schema_version"}, "campaign")
    merged, seen = [], set()
    for q in document["queries"]:
        closed(q, {"id", "phase", "question"}, {"endpoint", "max_results", "filters", "provider_queries", "corpus", "search_mode"}, "query")
        if q["id"] in seen:
            raise ConfigError(f"query {q['id']} is defined twice")
        seen.add(q["id"])
        whole = {"endpoint": "search/papers", "max_results": 100, "filters": {}} | document["defaults"] | q
        limit = 10_000 if whole.get("provider") == "elicit" else 1000
        if isinstance(whole["max_results"], bool) or not 1 <= whole["max_results"] <= limit:
            raise ConfigError(f"{q['id']}: max_results must be 1..{limit}")
        allowed = TRIAL_PROVIDERS if whole["endpoint"].endswith("trials") else PAPER_PROVIDERS
        if wrong := set(whole.get("provider_queries", {})) - set(allowed):
            raise ConfigError(f"{q['id']}: providers {sorted(wrong)} don't serve {whole['endpoint']}")
        merged.append(whole)
    return document | {"queries": merged}


def select_queries(campaign: dict, phases: set[int] | None = None, query_ids: list[str] | None = None, max_requests: int | None = None) -> list[dict]:
    """Queries by phase and id, the first ``max_requests`` of them; unknown ids and an empty choice are errors."""
    queries = campaign["queries"]
    if query_ids and (missing := set(query_ids) - {q["id"] for q in queries}):
        raise ConfigError(f"unknown queries {sorted(missing)}")
    chosen = [q for q in queries if (not phases or q["phase"] in phases) and (not query_ids or q["id"] in query_ids)][:max_requests]
    if not chosen:
        raise ConfigError("no query is selected")
    return chosen


def quoted(term: str) -> str:
    return '"' + term.replace("\\", "\\\\").replace('"', '\\"') + '"'


def compile_query(provider: str, query: dict, ontology: dict) -> str:
    """A provider's expression: groups of alternatives that all must hold, without the excluded terms."""

    def alternatives(kind: str, field: str) -> list[str]:
        bodies = [ontology[kind][c] for c in query.get(field, [])]
        terms = list(dict.fromkeys(t for b in bodies for t in b["terms"]))
        heads = list(dict.fromkeys(h for b in bodies for h in b.get("subject_headings", [])))
        return [wrap(t) for t in terms] + ([f"{quoted(h)}[MeSH Terms]" for h in heads] if provider == "pubmed" else [])

    def wrap(term: str) -> str:
        if provider == "pubmed":
            return f"{quoted(term)}[Title/Abstract]"
        return f"TITLE_ABS:{quoted(term)}" if provider == "europe_pmc" else quoted(term)

    groups = [alternatives(k, f) for k, f in zip(KINDS, CONCEPT_FIELDS) if f != "outcome_concepts" or query.get("require_outcomes")]
    groups += [[wrap(t) for t in g] for g in query.get("extra_required_groups", [])]
    text = " AND ".join(f"({' OR '.join(g)})" for g in groups if g)
    if excluded := query.get("excluded_terms"):
        text += f" NOT ({' OR '.join(wrap(t) for t in excluded)})"
    return text


def compile_manifest(campaign: dict, ontology: dict, specification: dict, providers: tuple[str, ...]) -> dict:
    """All queries and controls for all providers, with the hashes of what they were compiled from."""
    endpoints = {q["id"]: q["endpoint"] for q in campaign["queries"]}
    rows = []
    for control, part in ((False, "queries"), (True, "negative_controls")):
        for q in specification[part]:
            trials = endpoints.get(q["id"], "search/papers").endswith("trials")
            names = [p for p in providers if (p in TRIAL_PROVIDERS) == trials]
            rows.append({"query_id": q["id"], "negative_control": control, "provider_queries": {p: compile_query(p, q, ontology) for p in names}})
    return {"campaign_sha256": digest(campaign), "ontology_sha256": digest(ontology), "specification_sha256": digest(specification), "queries": rows}


def embed_compiled(campaign: dict, manifest: dict) -> dict:
    """The campaign with the compiled expressions of its queries; a query without one is an error."""
    compiled = {r["query_id"]: r["provider_queries"] for r in manifest["queries"]}
    if missing := [q["id"] for q in campaign["queries"] if q["id"] not in compiled]:
        raise ConfigError(f"no compiled expression for {missing}")
    return campaign | {"execution_state": "compiled", "queries": [q | {"provider_queries": compiled[q["id"]]} for q in campaign["queries"]]}


def control_campaign(campaign: dict, manifest: dict) -> dict:
    """A campaign of the negative controls: phase 99, ten results each, no trials."""
    controls = [r for r in manifest["queries"] if r["negative_control"]]
    queries = [
        {"id": r["query_id"], "phase": 99, "question": r["query_id"], "endpoint": "search/papers", "max_results": 10, "filters": {},
         "provider_queries": {p: e for p, e in r["provider_queries"].items() if p not in TRIAL_PROVIDERS}}
        for r in controls
    ]
    return campaign | {"campaign_id": campaign["campaign_id"] + "-controls", "queries": queries}


def provider_jobs(selected: list[dict], providers: tuple[str, ...]) -> list[dict]:
    """One job per query and provider that serves its endpoint."""
    jobs = []
    for q in selected:
        for provider in TRIAL_PROVIDERS if q["endpoint"].endswith("trials") else [p for p in providers if p in PAPER_PROVIDERS]:
            expression = q.get("provider_queries", {}).get(provider, q["question"])
            jobs.append({"query_id": q["id"], "provider": provider, "endpoint": q["endpoint"], "expression": expression, "max_results": q["max_results"]})
    return jobs


def plan(jobs: list[dict], remaining: int, acquired: set[tuple[str, str]] = frozenset()) -> list[dict]:
    """Jobs with their fair share of what is left: the rest divided by the jobs still pending, rounded up; acquired jobs are skipped."""
    pending, told = [j for j in jobs if (j["query_id"], j["provider"]) not in acquired], []
    for i, job in enumerate(pending):
        allowed = min(job["max_results"], math.ceil(remaining / (len(pending) - i))) if remaining > 0 else 0
        told.append(job | {"allowed": allowed, "state": "pending" if allowed else "skipped_record_budget_exhausted"})
        remaining -= allowed
    return told


def execute(jobs: list[dict], client, remaining: int, acquired: set[tuple[str, str]] = frozenset()) -> tuple[list[dict], list[dict]]:
    """Run a plan against ``client(job, limit) -> response``; what a job leaves unused goes to those after it.

    A response that would cross the budget is refused whole.  Returns the responses to append and a log.
    """
    pending, responses, log = [j for j in jobs if (j["query_id"], j["provider"]) not in acquired], [], []
    for i, job in enumerate(pending):
        limit = min(job["max_results"], math.ceil(remaining / (len(pending) - i))) if remaining > 0 else 0
        if not limit:
            log.append(job | {"state": "skipped_record_budget_exhausted", "records": 0})
            continue
        response = client(job, limit)
        found = len(response.get("papers", response.get("trials", [])))
        if found > remaining:
            log.append(job | {"state": "refused_over_budget", "records": found})
            continue
        remaining -= found
        responses.append({"provider": job["provider"], "endpoint": job["endpoint"], "request": {"query": job["expression"], "maxResults": limit}, "response": response})
        log.append(job | {"state": "acquired", "records": found})
    return responses, log


def manifest_frame(spark: SparkSession, manifest: dict) -> DataFrame:
    """The manifest as rows ``(query_id, negative_control, provider, expression)``."""
    rows = [(r["query_id"], r["negative_control"], p, e) for r in manifest["queries"] for p, e in sorted(r["provider_queries"].items())]
    return spark.createDataFrame(rows, "query_id string, negative_control boolean, provider string, expression string")
