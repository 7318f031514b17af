"""Problem 4: survivors against the definition, and what fusion learns."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siftlake.llm import fusion, p1, p4
from siftlake.operators.nested import provider_key
from siftlake.session import table

CLAIMS = "group_key string, field string, value string, chosen_value string, source string, preference int, at timestamp, id string"


def test_found_against_definition(spark, folder):
    from siftlake.functions.identifiers import identity_form

    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r in p1.p1_found(spark, folder).collect():
        a, b = find(r.id_a), find(r.id_b)
        parent[max(a, b)] = min(a, b)
    trust = {r.provider: r.preference for r in table(spark, folder, "provider_preference").collect()}
    shared = {r[0] for r in table(spark, folder, "shared_identifiers").select(identity_form(F.col("identity_key"))).collect()}
    batches = {r.id: r for r in table(spark, folder, "acquisitions").select("id", provider_key(F.col("provider")).alias("p"), F.try_to_timestamp("observed_at").alias("at")).collect()}
    records = table(spark, folder, "source_records").select("*", identity_form(F.concat(F.lit("doi:"), "doi")).alias("form"), p4.usable_title(F.col("title")).alias("usable")).collect()
    best: dict = {}
    for r in records:
        if r.id not in parent:
            continue
        key = (trust[batches[r.acquisition_id].p], -batches[r.acquisition_id].at.timestamp(), r.id)
        for field, usable in (("title", r.usable), ("doi", r.doi is not None and r.form not in shared)):
            if usable:
                at = (find(r.id), field)
                best[at] = min(best.get(at, key), key)
    assert {tuple(r) for r in p4.p4_found(spark, folder).collect()} == {(g, f, k[2]) for (g, f), k in best.items()}


def test_titles(spark):
    titles = ["A study of skin", "Untitled", "[no title]", "N/A", "Effect of x on...", "Effect of x on… ", None, "", "..."]
    rows = spark.createDataFrame([(t,) for t in titles], "title string")
    assert [r[0] for r in rows.select(p4.usable_title(rows.title)).collect()] == [True] + [False] * 8


def test_copies_are_discounted(spark):
    rng = random.Random(11)
    rows = []
    for g in range(200):
        truth, wrong = f"t{g}", f"w{g}"
        said = {s: truth if rng.random() < p else f"{s}{g}" for s, p in (("a", 0.9), ("b", 0.9), ("c", 0.85))}
        lie = truth if rng.random() < 0.3 else wrong
        said |= {"x": lie, "y": lie}  # y copies x; where copiers outnumber independent sources no vote can tell
        rows += [(f"g{g}", "title", v, v, s, None, None, f"{g}-{s}") for s, v in said.items()]
    claims = spark.createDataFrame(rows, CLAIMS)
    _, accuracy, copying = fusion.posteriors(claims)
    assert accuracy["a"] > accuracy["x"] and copying[("x", "y")] > 0.9 > 0.5 > copying[("a", "b")]
    chosen = fusion.survivors(claims).collect()
    assert sum(r.value == f"t{r.group_key[1:]}" for r in chosen) > 180


def test_cases(spark):
    assert fusion.survivors(spark.createDataFrame([], CLAIMS)).count() == 0
    rows = [("g", "f", None, None, "a", 0, None, "1"), (None, "f", "v", "v", "a", 0, None, "2"), ("g", "f", "v", "V", None, None, None, "4"), ("g", "f", "v", "v", "a", 1, None, "3"), ("g", "f", "v", "v", "a", 1, None, "3")]
    extra = spark.createDataFrame([(*r, 1.0, "x") for r in rows], CLAIMS + ", posterior double, sources string")
    assert [(r.source_record_id, r.value) for r in fusion.survivors(extra).collect()] == [("3", "v")]
    one = fusion.survivors(extra, None, fusion.FIRM_TRUST, fusion.FIRM_RECENCY).collect()
    assert [r.source_record_id for r in one] == ["3"] and abs(one[0].posterior - 1) < 1e-9


def _disputed(spark):
    day = lambda d: datetime.datetime(2024, 1, d)
    rows = [
        ("g", "title", "lie", "Lie", "best", 0, day(1), "9"), ("g", "title", "truth", "Truth", "a", 1, day(2), "2"),
        ("g", "title", "truth", "Truth", "b", 2, day(3), "1"), ("g", "title", "truth", "Truth", "c", 3, day(4), "3"),
        ("h", "doi", "x", "X", "a", 1, day(5), "7"), ("h", "doi", "y", "Y", "a", 1, day(5), "6"), ("h", "doi", "z", "Z", "a", 1, day(4), "5"),
    ]
    return spark.createDataFrame(rows, CLAIMS)


def test_posterior_decides(spark, monkeypatch):
    claims = _disputed(spark)
    found = lambda *prior: {(r.group_key, r.source_record_id) for r in fusion.survivors(claims, fusion.one_voice(claims), *prior).collect()}
    firm = fusion.FIRM_TRUST, fusion.FIRM_RECENCY
    assert found(*firm) == {("g", "9"), ("h", "6")}
    assert found() == {("g", "2"), ("h", "6")}
    monkeypatch.setattr(fusion, "log_posterior", lambda votes, prior: prior * 0)
    monkeypatch.setattr(fusion, "prior_log_odds", lambda trust, recency: F.lit(Decimal(0)).cast(fusion.LOG_ODDS))
    assert found(Decimal(0)) != {("g", "2"), ("h", "6")}


def test_votes_and_copies_enter_the_posterior(spark):
    claims = _disputed(spark)
    scores, accuracy, copying = fusion.posteriors(claims)
    votes = {(r.group_key, r.value): r.votes for r in scores.collect()}
    assert votes["g", "truth"] > votes["g", "lie"] > 0
    firm = {r.group_key: r.log_posterior for r in fusion.survivors(claims, None, fusion.FIRM_TRUST, fusion.FIRM_RECENCY).collect()}
    micros = lambda d: int(datetime.datetime(2024, 1, d, tzinfo=datetime.UTC).timestamp()) * 10**6
    # Beside a prior of any strength the votes are still there, to the last digit.
    assert float(firm["g"] - micros(1) * fusion.FIRM_RECENCY) == pytest.approx(votes["g", "lie"], abs=1e-5)
    alone = fusion._votes({"a": 0.8, "b": 0.8}, {})
    copied = fusion._votes({"a": 0.8, "b": 0.8}, {("a", "b"): 0.9})
    both = spark.createDataFrame([(["a", "b"],)], "sources array<string>").select(alone.alias("x"), copied.alias("y")).first()
    assert both.y < both.x


def test_fused_values_have_planted_truth(spark):
    """Of values planted right, wrong by chance and wrong by copying, fusion brings back the right ones."""
    rng = random.Random(5)
    rows, known = [], {}
    for g in range(300):
        for field in ("title", "doi"):
            known[f"g{g}", field] = truth = f"{field}{g}"
            for k, (source, right) in enumerate((("a", 0.95), ("b", 0.9), ("c", 0.8), ("d", 0.8))):
                rows.append((f"g{g}", field, truth if rng.random() < right else f"{source}{g}", "", source, k, None, f"{g}{source}"))
            rows.append((f"g{g}", field, f"old{g}" if rng.random() < 0.5 else truth, "", "e", 0, None, f"{g}e"))
            rows.append((*rows[-1][:4], "f", 0, None, f"{g}f"))
    chosen = fusion.survivors(spark.createDataFrame([(*r[:3], r[2], *r[4:]) for r in rows], CLAIMS)).collect()
    assert sum(known[r.group_key, r.field] == r.value for r in chosen) >= 0.95 * len(known) and len(chosen) == len(known)


def test_the_fixed_order_runs_no_fusion(spark, folder, monkeypatch):
    """No stage runs for ``p4_found`` that can't change its rows; ``p4_fused`` can't do without the votes."""
    monkeypatch.setattr(p4, "grouped_records", lambda spark, folder: table(spark, folder, "source_records").select(F.lit("g").alias("group_key"), "id").distinct())
    monkeypatch.setattr(fusion, "posteriors", lambda *_: pytest.fail("votes are counted"))
    assert {r.field for r in p4.p4_found(spark, folder).collect()} == {"title", "doi"}
    with pytest.raises(pytest.fail.Exception):
        p4.p4_fused(spark, folder)


def test_foremost_is_the_firm_prior(spark):
    claims = _disputed(spark)
    rows = [("i", "f", "v", "v", "a", None, None, "2"), ("i", "f", "w", "w", "a", None, datetime.datetime(2024, 1, 1), "3"), ("i", "f", None, "u", "a", 0, None, "1"), (None, "f", "v", "v", "a", 0, None, "0")]
    claims = claims.unionByName(spark.createDataFrame(rows, CLAIMS))
    firm = fusion.survivors(claims, fusion.one_voice(claims), fusion.FIRM_TRUST, fusion.FIRM_RECENCY).select("group_key", "field", "source_record_id")
    assert {tuple(r) for r in fusion.foremost(claims).collect()} == {tuple(r) for r in firm.collect()} == {("g", "title", "9"), ("h", "doi", "6"), ("i", "f", "3")}
