"""Ledgers, chains, states, budgets, campaigns, streams, files and the command line."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from siftlake import cli
from siftlake.operators import ledger, lookup
from siftlake.plans import campaign, ledger_queries, registry
from siftlake.session import table
from siftlake.sources import captured, files, sinks
from siftlake.streaming import state

ONTOLOGY = {"schema_version": "1", "ontology_id": "o", "version": "1", "conditions": {"c": {"terms": ["scar", 'a "b"'], "subject_headings": ["Cicatrix"]}}, "interventions": {"i": {"terms": ["laser"]}}, "outcomes": {"p": {"terms": ["pain"]}}}
SPEC = {
    "campaign_id": "k", "ontology_id": "o", "ontology_version": "1",
    "queries": [{"id": "q", "condition_concepts": ["c"], "intervention_concepts": ["i"], "outcome_concepts": ["p"], "require_outcomes": True, "excluded_terms": ["rat"]}],
    "negative_controls": [{"id": "n", "condition_concepts": ["c"], "intervention_concepts": ["i"]}],
}
CAMPAIGN = {"campaign_id": "k", "protocol": "p", "created_at": "t", "execution_state": "draft", "completion_rule": "r", "defaults": {"max_results": 20}, "queries": [{"id": "q", "phase": 1, "question": "?"}, {"id": "n", "phase": 2, "question": "!", "max_results": 5}]}


def capture(spark, papers, provider="europe_pmc"):
    rows = [(provider, "search/papers", '{"query": "x", "maxResults": 5}', json.dumps({"papers": papers}), "2024-01-01T00:00:00Z")]
    return ledger.acquisition_rows(spark.createDataFrame(rows, captured.CAPTURED))


def test_append_is_idempotent(spark):
    batch = capture(spark, [{"title": "A", "doi": "10.1/x"}, {"title": "B"}])
    records = ledger.record_rows(batch)
    assert [r["rank"] for r in records.orderBy("rank").collect()] == [1, 2]
    assert ledger.append_new(records, records.unionByName(records)).count() == 0
    assert ledger.append_new(records.limit(0), records.unionByName(records)).count() == 2
    with pytest.raises(Exception, match="credential"):
        ledger.acquisition_rows(spark.createDataFrame([("p", "e", '{"api_key": 1}', "{}", "t")], captured.CAPTURED)).collect()


def test_chain(spark):
    entries = ledger.chain([("a", "t", "1"), ("a", "t", "2"), ("a", "t", "3"), ("a", "t", "4")])
    rows = [(i, e["entry_sha256"], e["previous_entry_sha256"]) for i, e in enumerate(entries, 1)]
    frame = lambda r: spark.createDataFrame(r, "seq bigint, entry string, prev string")
    assert ledger.chain_breaks(frame(rows), "seq", "entry", "prev").count() == 0
    broken = [(s, e, "?" if s == 3 else p) for s, e, p in rows]
    assert [r.seq for r in ledger.chain_breaks(frame(broken), "seq", "entry", "prev").collect()] == [3]
    assert ledger.chain([("a", "t", "5")], entries[-1]["entry_sha256"])[0]["previous_entry_sha256"] == entries[-1]["entry_sha256"]


def test_conflicts_and_references(spark):
    held = spark.createDataFrame([("k", "p", "same")], "c string, p string, d string")
    batch = spark.createDataFrame([("k", "p", "same"), ("k", "p", "different"), ("k", "q", "same")], "c string, p string, d string")
    assert ledger.conflicting(held, batch, ["c", "p"], "d").count() == 1
    assert [r.p for r in ledger.missing_references(batch, held, "p", "p").collect()] == ["q"]


def test_budget_and_quota(spark):
    rows = spark.createDataFrame([(f"k{i % 34}",) for i in range(37)], "identity_key string")
    got = ledger.budget([rows.limit(19), rows.exceptAll(rows.limit(19))], 40).first()
    assert (got.records, got.identities, got.remaining, got.over_cap) == (37, 34, 3, False)
    one = spark.createDataFrame([([20, 20], 20), ([5, 20, 20], 20), ([], 20)], "w array<int>, cap int")
    assert [r[0] for r in one.select(ledger.fair_share(F.col("w"), F.col("cap"))).collect()] == [[10, 10], [5, 8, 7], []]


def test_salted_join(spark, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_ROWS", 10)
    rows = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(300)] + [(None, -1)], "k string, v int")
    names = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"K{i}") for i in range(0, 200, 3)], "k string, name string")
    for how in ("left", "inner"):
        assert sorted(map(str, lookup.salted_join(rows, names, "k", how, 301).collect())) == sorted(map(str, rows.join(names, "k", how).collect()))


def test_states(spark, folder):
    events = pd.DataFrame([(1, "discovered", "deterministic"), (2, "included", "human"), (3, "triaged", "deterministic"), (3, "triaged", "deterministic"), (4, "awaiting_review", "deterministic"), (5, "included", "human")], columns=["event_id", "to_state", "actor_kind"])

    class Held:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    held = Held()
    got = next(state.advance((7,), iter([events]), held))
    assert got["outcome"].tolist() == ["accepted", "rejected", "accepted", "replayed", "accepted", "accepted"] and held.get == ("included", 5)
    again = next(state.advance((7,), iter([events]), held))
    assert set(again["outcome"]) == {"replayed"}
    streamed = state.run_state_machine(spark, f"{folder}/events.parquet")
    assert streamed.count() == table(spark, folder, "events").count()


def test_campaign():
    ontology = campaign.validate_ontology(ONTOLOGY)
    spec, plan = campaign.validate_specification(SPEC, ontology), campaign.validate_campaign(CAMPAIGN)
    manifest = campaign.compile_manifest(plan, ontology, spec, ("pubmed", "europe_pmc", "clinical_trials"))
    assert manifest["queries"][0]["provider_queries"]["europe_pmc"] == '(TITLE_ABS:"scar" OR TITLE_ABS:"a \\"b\\"") AND (TITLE_ABS:"laser") AND (TITLE_ABS:"pain") NOT (TITLE_ABS:"rat")'
    assert '"Cicatrix"[MeSH Terms]' in manifest["queries"][0]["provider_queries"]["pubmed"]
    compiled = campaign.embed_compiled(plan, manifest)
    jobs = campaign.provider_jobs(campaign.select_queries(compiled, {1}), ("pubmed", "europe_pmc"))
    assert [j["allowed"] for j in campaign.plan(jobs, 20)] == [10, 10]
    assert [j["state"] for j in campaign.plan(jobs, 0)] == ["skipped_record_budget_exhausted"] * 2
    responses, log = campaign.execute(jobs, lambda job, limit: {"papers": [{}] * min(limit, 3)}, 20)
    assert [x["records"] for x in log] == [3, 3] and [r["request"]["maxResults"] for r in responses] == [10, 17]
    assert campaign.control_campaign(plan, manifest)["queries"][0]["phase"] == 99
    for wrong in (lambda: campaign.validate_ontology(ONTOLOGY | {"x": 1}), lambda: campaign.select_queries(plan, query_ids=["z"]), lambda: campaign.select_queries(plan, {9}), lambda: campaign.validate_campaign(CAMPAIGN | {"queries": CAMPAIGN["queries"] * 2}),
                  lambda: campaign.validate_specification(SPEC | {"queries": [SPEC["queries"][0] | {"condition_concepts": ["p"]}]}, ontology)):
        with pytest.raises(campaign.ConfigError):
            wrong()


def test_providers(spark):
    raw = lambda body: spark.createDataFrame([(json.dumps(body),)], "response_json string")
    epmc = captured.project(raw({"resultList": {"result": [{"title": "T", "authorString": "A B, C D, ", "pubYear": "2020", "doi": "https://doi.org/10.1234/X"}, {"title": "R", "isRetracted": "Y"}, {"title": " "}]}}), "europe_pmc").collect()
    assert [(r.title, r.authors, r.year, r.doi) for r in epmc] == [("T", ["A B", "C D"], 2020, "10.1234/X")]
    pm = captured.project(raw({"result": {"uids": ["2", "1"], "1": {"title": "one"}, "2": {"title": "two", "articleids": [{"idtype": "doi", "value": "10.1234/y"}], "pubdate": "2019 Mar", "authors": [{"name": "N"}]}}}), "pubmed").collect()
    assert [(r.rank, r.title, r.doi, r.year) for r in pm] == [(1, "two", "10.1234/y", 2019), (2, "one", None, None)]
    oa = captured.project(raw({"results": [{"display_name": "O", "abstract_inverted_index": {"b": [1], "a": [0, 2]}, "ids": {"pmid": "https://x/77"}}]}), "openalex").first()
    assert (oa.abstract, oa.pmid) == ("a b a", "77")
    ct = captured.project(raw({"studies": [{"protocolSection": {"identificationModule": {"briefTitle": " ", "officialTitle": "Off", "nctId": "NCT00000001"}}}]}), "clinical_trials").first()
    assert ct.title == "Off" and ct.urls == ["https://clinicaltrials.gov/study/NCT00000001"]
    cr = captured.project(raw({"message": {"title": ["C"], "DOI": "10.1234/z", "published": {"date-parts": [[2001, 2]]}, "author": [{"given": "G", "family": "F"}]}}), "crossref").first()
    assert (cr.title, cr.year, cr.authors) == ("C", 2001, ["G F"])
    up = captured.project(raw({"title": "U", "oa_locations": [{"url": "a", "url_for_pdf": "b"}, {"url": "a"}]}), "unpaywall").first()
    assert up.urls == ["a", "b"]
    with pytest.raises(ValueError):
        captured.project(raw({}), "nobody")


def test_files_and_sinks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": "x"}\n\n{"k": "y"}\n')
    assert files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "k string").count() == 2
    (tmp_path / "bad.jsonl").write_text("[1\n")
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "k string").collect()
    rows = spark.createDataFrame([("a", ["x", "y"], 1.5, 'q"\n,'), ("b", [], None, None)], "k string, l array<string>, n double, t string")
    sinks.write_csv(rows, str(tmp_path / "csv"))
    assert {tuple(r) for r in files.read_csv(spark, str(tmp_path / "csv"), ["k", "l", "n", "t"]).collect()} == {("a", '["x","y"]', "1.5", 'q"\n,'), ("b", "[]", None, None)}
    sinks.write_csv(rows, str(tmp_path / "pipe"), ["k", "l"], "pipe")
    assert "a,x|y" in "".join(p.read_text() for p in (tmp_path / "pipe").glob("part-*"))
    sinks.write_jsonl(rows, str(tmp_path / "jsonl"))
    assert '{"k":"b","l":[],"n":null,"t":null}' in "".join(p.read_text() for p in (tmp_path / "jsonl").glob("part-*"))
    told = sinks.receipt(spark, str(tmp_path / "jsonl"))
    assert sinks.verify(spark, str(tmp_path / "jsonl"), told).count() == 0
    assert sinks.verify(spark, str(tmp_path / "jsonl"), told.withColumn("sha256", F.lit("?"))).count() > 0
    sinks.write_markdown("R", rows.select("k"), str(tmp_path / "r.md"))
    assert "| a |" in (tmp_path / "r.md").read_text()


def test_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<article><article-title>T</article-title><abstract><p>One  two</p></abstract><sec><p>One two</p> <p>Three</p></sec></article>")
    (tmp_path / "evil.xml").write_text('<!DOCTYPE x [<!ENTITY e "v">]><article><p>&e;</p></article>')
    got = files.pmc_sections(spark, str(tmp_path)).collect()
    assert [(r.locator, r.text) for r in got] == [("xml:article-title[1]", "T"), ("xml:abstract[1]", "One two"), ("xml:sec[1]", "One two Three"), ("xml:p[3]", "Three")]
    (tmp_path / "pm").mkdir()
    (tmp_path / "pm" / "b.xml").write_text('<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>10</PMID><Article><Abstract><AbstractText Label="AIM">x</AbstractText><AbstractText>y</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle><PubmedArticle><MedlineCitation><PMID>9</PMID></MedlineCitation></PubmedArticle></PubmedArticleSet>')
    assert [(r.pmid, r.abstract) for r in files.pubmed_abstracts(spark, str(tmp_path / "pm")).collect()] == [("9", None), ("10", "AIM: x y")]


def test_data_source(spark, tmp_path):
    for i, provider in enumerate(("pubmed", "elicit")):
        (tmp_path / f"{i}.json").write_text(json.dumps({"provider": provider, "endpoint": "e", "request": {"b": 1, "a": 2}, "response": {"papers": [{"title": "T"}]}, "observed_at": "2024-01-01T00:00:00Z"}))
    spark.dataSource.register(captured.CapturedResponses)
    rows = spark.read.format("captured").option("provider", "pubmed").load(str(tmp_path)).collect()
    assert [(r.provider, r.request_json) for r in rows] == [("pubmed", '{"a":2,"b":1}')]
    assert captured.read_captured(spark, str(tmp_path)).count() == 2


def test_command_line(spark, folder, tmp_path, capsys):
    for name, body in (("c", CAMPAIGN), ("o", ONTOLOGY), ("s", SPEC)):
        (tmp_path / f"{name}.json").write_text(json.dumps(body))
    base = ["--campaign", f"{tmp_path}/c.json"]
    assert cli.main(["compile-search", *base, "--ontology", f"{tmp_path}/o.json", "--specification", f"{tmp_path}/s.json"], spark) == 0
    assert cli.main(["plan", *base, "--phase", "1"], spark) == 0 and '"allowed"' in capsys.readouterr().out
    assert cli.main(["plan", *base, "--query", "zzz"], spark) == 2
    assert cli.main(["query", "provider_counts", "--tables", folder], spark) == 0
    assert cli.main(["query", "nothing", "--tables", folder], spark) == 2
    assert cli.main(["state", "--tables", folder, "--out", f"{tmp_path}/state"], spark) == 0
    assert cli.main(["readiness", "--tables", folder], spark) == 1
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(json.dumps({"provider": "pubmed", "endpoint": "e", "request": {"query": "q"}, "response": {"papers": [{"title": "T"}]}, "observed_at": "2024-01-01T00:00:00Z"}))
    for _ in range(2):
        assert cli.main(["import-response", "--path", f"{tmp_path}/in", "--ledger", f"{tmp_path}/ledger"], spark) == 0
    assert spark.read.parquet(f"{tmp_path}/ledger/source_records.parquet").count() == 1


def test_registry(spark, folder):
    assert set(registry.ORACLES) <= set(registry.QUERIES)
    assert registry.flagship(spark, folder).first().records_identified > 0
    assert ledger_queries.stream_dedup_append(spark, folder).first().events == table(spark, folder, "events").count()
