"""Problem 1: the metric join against all pairs, and its cases."""

import itertools
import json
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftlake.functions.words import words
from siftlake.llm import jaccard, p1
from siftlake.session import stage, table

RECORD = "id string, title string, raw_json string"


def brute(rows, threshold=0.7):
    sets = {}
    for key, title, raw in rows:
        body = p1.content(title, raw)
        if key is not None and body is not None:
            sets[key] = set(words(body, entities=True))
    out = set()
    for a, b in itertools.combinations(sorted(sets), 2):
        union = sets[a] | sets[b]
        if not union or len(sets[a] & sets[b]) >= threshold * len(union) - 1e-9:
            out.add((a, b))
    return out


def found(spark, rows):
    reps, members = jaccard.classes(stage(p1.record_sets(spark.createDataFrame(rows, RECORD)), "sets"))
    pairs = stage(jaccard.join_within(reps, 0.7), "links")
    return pairs, members


def pairs_of(spark, rows):
    return {tuple(r) for r in jaccard.expand(*found(spark, rows)).collect()}


def raw(text):
    return json.dumps({"abstract": text})


def test_ledger_against_all_pairs(spark, folder):
    rows = [(r.id, r.title, r.raw_json) for r in table(spark, folder, "source_records").collect()]
    assert {tuple(r) for r in p1.p1_found(spark, folder).collect()} == brute(rows)


def test_cases(spark):
    long_text = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        ("a", "Title", raw("one two three four five six seven eight nine ten")),
        ("b", "Title", raw("ten nine eight seven six five four three two one")),  # other order
        ("b", "Title", raw("ten nine eight seven six five four three two one")),  # delivered twice
        ("c", None, raw("one two three four five six seven eight nine ten")),  # no title
        ("d", "Title", None),  # no JSON
        ("e", "Title", "not json"),
        ("f", "Title", raw("")),  # empty abstract counts as none
        ("g", "Title", raw("one two &amp; three")),
        ("h", "!!!", raw("???")),  # no words at all
        ("i", "!", raw("...")),
        ("j", "x", raw(long_text)),
        ("k", "y", raw(long_text + " more")),
        (None, "Title", raw("one two three")),
    ]
    assert pairs_of(spark, rows) == brute(rows)
    assert pairs_of(spark, []) == set()


def test_hot_group_is_not_expanded(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = [(f"s{i:03}", "t", raw(" ".join(base))) for i in range(120)]  # a third are copies
    rows += [(f"e{i:03}", "t", raw(" ".join(base[:55] + [f"x{i}a", f"x{i}b"]))) for i in range(60)]
    rows += [(f"o{i:03}", "t", raw(" ".join(f"z{rng.randrange(5000)}" for _ in range(60)))) for i in range(180)]
    pairs, members = found(spark, rows)
    assert pairs.count() <= 61 * 60 / 2  # classes, not copies
    groups = {r.id: r for r in jaccard.groups(pairs, members).collect()}
    expected = brute(rows)
    assert {tuple(r) for r in jaccard.expand(pairs, members).collect()} == expected
    assert groups["s000"].links == sum("s000" in p for p in expected)
    assert len({groups[k].group_key for k in groups if k[0] in "se"}) == 1
    assert groups["o000"].links == 0 and groups["o000"].group_key == "o000"


def test_blocks_of_a_large_region(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    base = [f"w{i}" for i in range(60)]
    rows = [(f"e{i:03}", "t", raw(" ".join(base[:56] + [f"x{i}a", f"x{i}b"]))) for i in range(70)]
    assert pairs_of(spark, rows) == brute(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 40), max_size=25), max_size=120), st.sampled_from([0.2, 0.3, 0.5]))
def test_region_join_is_exact(sets, radius):
    expected = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if jaccard.distance(sets[i], sets[j]) <= radius + 1e-12}
    assert set(jaccard.join_region(sets, radius)) == expected


def test_voronoi_cells_are_used():
    rng = random.Random(1)
    centres = [frozenset(rng.sample(range(3000), 60)) for _ in range(12)]
    sets = [frozenset(list(c)[:55] + rng.sample(range(3000, 6000), 4)) for c in centres for _ in range(15)]
    expected = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if jaccard.distance(sets[i], sets[j]) <= 0.3}
    assert set(jaccard.join_region(sets, 0.3)) == expected and len(sets) > jaccard.CELL


@pytest.mark.parametrize("trees", [1, 5])
def test_more_trees_find_no_less(spark, folder, trees):
    sets = stage(p1.record_sets(table(spark, folder, "source_records")), "sets")
    reps, _ = jaccard.classes(sets)
    some = {tuple(r)[:2] for r in jaccard.join_within(reps, 0.7, trees).collect()}
    every = {tuple(r)[:2] for r in jaccard.join_within(reps, 0.7, 8).collect()}
    assert some <= every and len(some) >= 0.97 * len(every)


def test_random_edits_share_a_region():
    """Sets of Zipf-like words with words replaced at random meet in a part of some tree, in a table of a million sets as well."""
    rng = np.random.default_rng(2)
    vocabulary = np.sort(rng.integers(-(2**62), 2**62, 20_000))
    weight = 1 / (np.arange(20_000) + 20.0)
    weight /= weight.sum()
    total = 1_000_000
    count = np.minimum(total, 130 * total * weight)
    often = total // jaccard.RARE
    known = np.sort(vocabulary[count >= often])
    bits = dict(zip(vocabulary.tolist(), np.maximum(np.log2(total / count), jaccard.LEAST_BITS).tolist()))
    rarity = np.array([bits[k] for k in known.tolist()])
    rest, least = math.log2(total / often), math.log2(total) + jaccard.SPARE
    for similarity, share in ((0.9, 1.0), (0.8, 0.99), (0.7, 0.9)):
        xs = [np.unique(rng.choice(vocabulary, 130, p=weight)) for _ in range(200)]
        ys = []
        for x in xs:
            gone = round(len(x) * (1 - similarity) / (1 + similarity))
            new = np.setdiff1d(rng.choice(vocabulary, 4 * gone, p=weight), x)[:gone]
            ys.append(np.unique(np.concatenate([rng.choice(x, len(x) - gone, replace=False), new])))
        met = set()
        for seed in range(jaccard.TREES):
            keys = [set(zip(*(a.tolist() for a in jaccard.part_keys(np.concatenate(s), np.repeat(np.arange(200), [len(x) for x in s]), known, rarity, rest, least, seed)[::-1]))) for s in (xs, ys)]
            met |= {owner for owner, _ in keys[0] & keys[1]}
        assert len(met) >= share * 200, (similarity, len(met))


def test_pairs_at_the_limit_are_not_left_out(spark, monkeypatch):
    """Sets of a small vocabulary, whose words tell nothing, edited up to the limit itself; in one block and in many, of two widths of sketches."""
    monkeypatch.setattr(jaccard, "BLOCK", 64)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(100):
        base = rng.sample(vocabulary, 17)
        rows += [(f"a{i:03}", "t", raw(" ".join(base))), (f"b{i:03}", "t", raw(" ".join(base[:13] + rng.sample(sorted(set(vocabulary) - set(base)), 2))))]
    for i in range(6):
        base = [f"v{rng.randrange(400)}" for _ in range(170)]
        rows += [(f"c{i}", "t", raw(" ".join(base))), (f"d{i}", "t", raw(" ".join(base[:140])))]
    expected = brute(rows)
    assert len(expected) >= 100
    reps, members = jaccard.classes(stage(p1.record_sets(spark.createDataFrame(rows, RECORD)), "sets"))
    for blocks in (1, 5):
        assert {tuple(r) for r in jaccard.expand(jaccard.join_within(reps, 0.7, blocks), members).collect()} == expected
