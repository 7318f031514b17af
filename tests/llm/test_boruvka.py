"""Problem 3: components against union-find, and their cases."""

import random

import pytest

from siftlake.llm import p3
from siftlake.llm.boruvka import boruvka_components
from siftlake.operators import lookup
from siftlake.session import table


def union_find(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in parent}


def run(spark, pairs, kind="bigint"):
    rows = boruvka_components(spark.createDataFrame([(*p, "clash", "clash") for p in pairs], f"x {kind}, y {kind}, node string, parent string"), "x", "y").collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.component for r in rows}


@pytest.mark.parametrize("shape", ["random", "path", "star", "cliques"])
def test_shapes(spark, shape):
    rng = random.Random(5)
    pairs = {
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(300)],
        "path": [(i, i + 1) for i in rng.sample(range(150), 150)],
        "star": [(999, i) for i in range(300)],
        "cliques": [(c * 10 + i, c * 10 + j) for c in range(8) for i in range(6) for j in range(6)],
    }[shape]
    assert run(spark, pairs) == union_find(pairs)


def test_cases(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, 1), (None, 2), (3, None)]) == {}
    assert run(spark, [("b", "a"), ("a", "b"), ("b", "a"), ("c", "b")], "string") == {"a": "a", "b": "a", "c": "a"}


def test_hot_hub_is_salted(spark, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_ROWS", 50)
    pairs = [(0, i) for i in range(1, 200)] + [(i, i + 1000) for i in range(1, 200)]
    assert run(spark, pairs) == union_find(pairs)


def test_found_against_definition(spark, folder):
    links = [tuple(r) for r in p3.same_study_links(spark, folder).collect()]
    names = {r.group_id: r.canonical_identity for r in table(spark, folder, "dedup_groups").collect()}
    groups: dict = {}
    for node, root in union_find(links).items():
        groups.setdefault(root, set()).add(names[node])
    expected = {(name, min(g)) for g in groups.values() for name in g if len(g) > 1}
    assert {tuple(r) for r in p3.p3_found(spark, folder).collect()} == expected
