"""Problem 7: tiling against plain search, and its cases."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from siftlake.functions.words import words
from siftlake.llm import p7, tiling
from siftlake.session import table


def longest_run(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0] * (len(b) + 1)
        for j, y in enumerate(b, 1):
            if x == y:
                new[j] = row[j - 1] + 1
                best = max(best, new[j])
        row = new
    return best


def test_found_against_definition(spark, folder):
    docs = [(r.doc_id, words(r.text)) for r in table(spark, folder, "documents").collect()]
    items = [(r.item_id, words(r.passage)) for r in table(spark, folder, "eval_items").collect()]
    grams = {i: {tuple(w[k : k + 12]) for k in range(len(w) - 11)} for i, w in items}
    expected = {(d, i) for d, w in docs for i, g in grams.items() if any(tuple(w[k : k + 12]) in g for k in range(len(w) - 11))}
    assert {tuple(r) for r in p7.p7_found(spark, folder).collect()} == expected


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.integers(0, 3), max_size=40), st.integers(2, 5))
def test_tiles(text, passage, width):
    a, b = np.array(text, dtype=np.int64), np.array(passage, dtype=np.int64)
    block = tiling.Passages([(7, b)], width)
    tiles = [t for _, _, t in block.leaks([np.array([9, 9], dtype=np.int64), a])]
    longest = longest_run(text, passage)
    size = min(width, len(b))
    assert bool(tiles) == (longest >= size > 0)
    if tiles:
        assert max(t[0] for t in tiles[0]) == longest
        for length, i, j in tiles[0]:
            assert (a[i : i + length] == b[j : j + length]).all() and length >= size
        assert sum(t[0] for t in tiles[0]) == len({k for n, i, _ in tiles[0] for k in range(i, i + n)}) == len({k for n, _, j in tiles[0] for k in range(j, j + n)})


def test_rolling_hashes():
    v = np.random.default_rng(0).integers(-(2**62), 2**62, 5000)
    v[2000:2100] = v[100:200]
    h = tiling.rolling(v, 50)
    assert len(h) == 4951 and (h[2000:2051] == h[100:151]).all() and len(np.unique(h)) == 4951 - 51
    assert len(tiling.rolling(v[:10], 50)) == 0


def test_cases(spark):
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(40)]
    parts = [passage[i : i + 8] for i in range(0, 40, 8)]
    rng.shuffle(parts)
    reordered = " filler ".join(" ".join(p) for p in parts)
    long_text = " ".join(f"n{i}" for i in range(200_000)) + " " + " ".join(passage)
    docs = spark.createDataFrame([(1, reordered, 0), (2, long_text, 0), (3, None, 0), (4, "", 0), (5, "tiny note", 0), (6, "TÍNY, note!", 0), (7, "tiny", 0), (7, reordered, 0)], "doc_id bigint, text string, tiles int")
    items = spark.createDataFrame([(10, " ".join(passage)), (10, " ".join(passage)), (11, "tiny note"), (12, None), (13, ""), (14, "!!!")], "item_id bigint, passage string")
    got = {(r.doc_id, r.item_id): r for r in tiling.leaked_passages(docs, "doc_id", "text", items, "item_id", "passage", 6).collect()}
    assert set(got) == {(1, 10), (2, 10), (5, 11), (6, 11), (7, 10)}
    assert got[1, 10].coverage == 1.0 and got[1, 10].longest == 8 and got[2, 10].longest == 40
    blocks = tiling.leaked_passages(docs, "doc_id", "text", items, "item_id", "passage", 6, block_words=1)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == set(got)
    assert tiling.leaked_passages(docs.limit(0), "doc_id", "text", items, "item_id", "passage").count() == 0
    assert tiling.leaked_passages(docs, "doc_id", "text", items.limit(0), "item_id", "passage").count() == 0


def test_one_word_over_and_over(monkeypatch):
    """Texts and passages of one word have windows that are all equal; pieces of any size join to the same tiles."""
    text, passage = np.full(3000, 5, dtype=np.int64), np.full(400, 5, dtype=np.int64)
    mixed = np.concatenate([text[:50], np.arange(10), text[:80]])
    tiles = lambda: [(t, i, sorted(x)) for t, i, x in tiling.Passages([(1, passage), (2, mixed)], 6).leaks([text, mixed[5:], np.empty(0, dtype=np.int64)])]
    whole = tiles()
    assert sum(n for n, _, _ in next(x for t, i, x in whole if (t, i) == (0, 0))) == 400
    monkeypatch.setattr(tiling, "PIECE", 1000)
    assert tiles() == whole
