"""Refused and hash-bound documents, bounded tables, spread joins, enrichment, and the commands over a ledger."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from siftlake import cli
from siftlake.functions import normalise as N
from siftlake.operators import funnel, ledger, lookup
from siftlake.session import bounded
from siftlake.sources import files, sinks


def test_refused_documents_have_a_reason(spark, tmp_path):
    bodies = {"ok.xml": b"<article><p>x</p></article>", "other.xml": b"<book/>", "bad.xml": b"<article>", "entity.xml": b'<!DOCTYPE x [<!ENTITY a "b">]><article/>', "empty.xml": b""}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    got = {r.path.rsplit("/", 1)[1]: r.reason for r in files.refused_documents(spark, str(tmp_path), "article").collect()}
    assert got == {"other.xml": "wrong_root", "bad.xml": "unreadable", "entity.xml": "entities"}  # the scan itself skips files without bytes
    assert files.parse_document(b"") == (None, "empty") and files.parse_document(b"x" * 11, 10) == (None, "too_large")
    digest = hashlib.sha256(bodies["ok.xml"]).hexdigest()
    row = files.fetched_document(spark, f"{tmp_path}/ok.xml", digest).first()
    assert (row.sha256, row.root, row.length) == (digest, "article", len(bodies["ok.xml"]))
    for name, expected in (("ok.xml", "0" * 64), ("bad.xml", hashlib.sha256(bodies["bad.xml"]).hexdigest())):
        with pytest.raises(Exception, match="not the document"):
            files.fetched_document(spark, f"{tmp_path}/{name}", expected).collect()


def test_small_tables_are_whole_or_an_error(spark, tmp_path):
    rows = spark.range(5)
    assert len(bounded(rows, 5)) == 5 and bounded(rows.limit(0), 0) == []
    with pytest.raises(ValueError):
        bounded(rows, 4)
    sinks.write_markdown("Report", rows, f"{tmp_path}/a.md", 5)
    with pytest.raises(ValueError):
        sinks.write_markdown("Report", rows, f"{tmp_path}/b.md", 4)


def test_spread_join(spark):
    rng = random.Random(1)
    left = [(i, rng.choice(["hot", "hot", "a", "b", None])) for i in range(60)]
    right = [(100 + i, rng.choice(["hot", "hot", "hot", "a", "c", None])) for i in range(300)]
    a, b = spark.createDataFrame(left, "l int, k string"), spark.createDataFrame(right, "r int, k string")
    got = sorted((r.l, r.r, r.k) for r in lookup.spread_join(a, b, "k", "r").collect())
    assert got == sorted((i, j, k) for i, k in left for j, m in right if k == m and k is not None)
    assert lookup.spread_join(a.limit(0), b, "k", "r").count() == 0 == lookup.spread_join(a, b.limit(0), "k", "r").count()


def test_enrichments_are_applied(spark):
    groups = spark.createDataFrame([("a", "1", None), ("b", "2", "held"), ("c", "3", " "), ("d", "3", None), ("e", None, None)], "group_id string, pmid string, abstract string")
    fetched = spark.createDataFrame([("1", "new"), ("1", "zzz"), ("2", "other"), ("3", "x"), ("9", "y")], "pmid string, abstract string")
    got = {r.group_id: (r.abstract, r.abstract_enriched) for r in funnel.apply_enrichments(groups, fetched).collect()}
    assert got == {"a": ("new", True), "b": ("held", False), "c": (" ", False), "d": (None, False), "e": (None, False)}


def test_older_buckets(spark):
    rows = [(["Practice Guideline"], False, [1]), (["Meta-Analysis", "Review"], False, None), (["Randomized Controlled Trial"], True, []), (["Clinical Trial"], False, [2]), (["Review"], False, [1, 2]), ([], True, [1]), (None, None, None)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t array<string>, trial boolean, p array<int>")
    design = N.plain_design(F.col("t"), F.col("trial"))
    got = [(r.d, r.n) for r in frame.orderBy("i").select(design.alias("d"), N.plain_priority(design, F.col("p")).alias("n")).collect()]
    assert got == [
        ("guideline", 1), ("systematic_review_or_meta_analysis", 1), ("randomized_controlled_trial", 2), ("clinical_trial", 2), ("nonsystematic_review", 3), ("trial_registry_record", 2), ("primary_or_other", 4),
    ]


def test_funnel_gates(spark):
    fields = "group_id string, risk_of_bias string, effect_estimates array<string>, source_locators array<string>, adverse_events string, conflicts string"
    selected = spark.createDataFrame([("a",), ("a",), ("b",)], "group_id string")
    whole = [("a", "low", ["1"], ["p"], "none", "none"), ("b", "high", ["1"], ["p"], "none", "none")]

    def gates(rows, chosen=selected, open_=0, signed=True):
        return funnel.funnel_gates(chosen, spark.createDataFrame(rows, fields), F.lit(True), spark.range(open_), F.lit(signed)).first()

    assert gates(whole).ready and not gates(whole, open_=1).ready and gates(whole, signed=False).failed_gates == ["human_synthesis_signoff"]
    assert "included_full_text_extractions_complete" in gates(whole[:1]).failed_gates
    assert gates([whole[0], ("b", "unclear", [], ["p"], " ", "none")]).failed_gates == ["effect_estimates_source_located", "harms_and_conflicts_extracted", "risk_of_bias_complete"]
    assert len(gates([], chosen=selected.limit(0)).failed_gates) == 4


def test_commands(spark, folder, tmp_path, capsys):
    run = lambda *args: cli.main([*args], spark)
    assert run("status", "--tables", folder) == 0 and "source_records" in capsys.readouterr().out
    some = spark.read.parquet(f"{folder}/source_records.parquet").first().id
    assert run("source", "--tables", folder, "--id", some) == 0 and some in capsys.readouterr().out
    assert run("source", "--tables", folder, "--id", "nobody") == 1
    report = {r.check: r.failures for r in ledger_report(spark, folder)}
    assert run("ledger-audit", "--tables", folder) == (1 if any(report.values()) else 0)
    (tmp_path / "docs").write_text(json.dumps({"schema_version": "v"}) + "\n")
    assert run("check-documents", "--path", f"{tmp_path}/docs", "--version", "v", "--contract", "appraisal") == 1
    (tmp_path / "x.xml").write_text("<article/>")
    assert run("refused-documents", "--path", f"{tmp_path}/x.xml", "--root", "article") == 0 == run("import-document", "--path", f"{tmp_path}/x.xml")


def ledger_report(spark, folder):
    from siftlake.plans import ledger_queries

    return ledger_queries.ledger_audit(spark, folder).collect()


def test_lookups_and_references(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "id string, x int")
    assert ledger.lookup(rows, "id", "a").count() == 1 and ledger.lookup(rows, "id", "c").count() == 0 == ledger.lookup(rows, "id", None).count()
    held = spark.createDataFrame([("1", "p")], "id string, ref string")
    batch = spark.createDataFrame([("1", "p"), ("2", "p"), ("2", "p"), ("3", "q"), ("4", None)], "id string, ref string")
    added, refused = ledger.append_referenced(held, batch, spark.createDataFrame([("p",), ("p",)], "key string"), "ref", "key")
    assert [r.id for r in added.collect()] == ["2"] and sorted(r.id for r in refused.collect()) == ["3", "4"]
    none = ledger.audit_rows({"empty": (rows.limit(0), F.col("id"), F.lit(True)), "bad": (rows, F.col("id"), F.col("x") == 1)}).collect()
    assert {(r.check, r.rows, r.failures, r.first_failure) for r in none} == {("empty", 0, 0, None), ("bad", 3, 1, "b")}
