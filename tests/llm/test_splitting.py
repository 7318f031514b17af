"""Problem 9: pieces, boundaries, overlap and their cases."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftlake.llm import p9, splitting, tokens
from siftlake.session import table

PATH = tokens.vocabulary_path()


def check(text, limit, overlap):
    parts = splitting.pieces(text, PATH, limit, overlap)
    data = text.encode()
    assert parts[0][0] == 0 and parts[-1][3] == len(data)
    assert "".join([data[a:b].decode() for _, _, a, b in parts[:1]]) is not None
    for (s, e, a, b), after in zip(parts, [*parts[1:], None]):
        assert tokens.count(data[a:b].decode(), PATH) <= limit and e > s
        if after:
            assert s < after[0] <= e and (e - after[0] >= overlap or after[0] == s + 1) and after[2] <= b
    return parts


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\n,é字😀", max_size=400), st.integers(8, 40), st.integers(0, 6))
def test_any_text(text, limit, overlap):
    if text:
        check(text, limit, overlap)


def test_strongest_boundary_wins():
    sentence = "The skin of the wrist was measured twice. "
    text = sentence * 9 + "\n\n" + sentence * 30
    first = check(text, 120, 10)[0]
    assert text.encode()[: first[3]].decode().endswith("\n\n")
    plain = "word " * 2000
    assert all(p[3] == len(plain) or plain[p[3]] == " " or plain[p[3] - 1] == " " for p in check(plain, 100, 0))


def test_range_maximum():
    rng = np.random.default_rng(3)
    values = rng.integers(-1, 6, 300)
    table_ = splitting.RangeMaximum(values)
    for _ in range(500):
        low, high = sorted(rng.integers(0, 300, 2))
        best = max(range(low, high + 1), key=lambda i: (values[i], i))
        assert table_.best(int(low), int(high)) == best


@pytest.mark.parametrize("text", ["CGAT" * 20_000, " " * 60_000 + "x", "字" * 5_000, "😀" * 2_000, "a\r\n" * 5_000, "x" * 50_000])
def test_texts_without_breaks(text):
    check(text, 200, 20)


def test_cases(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "short", 1), (4, " ".join(str(rng.random()) for _ in range(3000)), 1), (4, "twice " * 700, 1)], "doc_id bigint, text string, piece_no int")
    got = splitting.split_documents(docs, "doc_id", "text", [(1, 300, 30), (2, 100_000, 0)]).toPandas()
    assert set(got.doc_id) == {4} and set(got.setting_id) == {1}
    assert splitting.split_documents(docs.limit(0), "doc_id", "text", [(1, 300, 30)]).count() == 0
    assert splitting.split_documents(docs, "doc_id", "text", []).count() == 0
    with pytest.raises(ValueError):
        splitting.pieces("x y z", PATH, 5, 5)


def test_found_against_counts(spark, folder):
    docs = table(spark, folder, "documents").collect()
    expected = {r.doc_id for r in docs if r.text and tokens.count(r.text, PATH) > 1000}
    assert {r.doc_id for r in p9.p9_found(spark, folder).collect()} == expected
    assert {r.doc_id for r in p9.p9_pieces(spark, folder).filter("setting_id = 1").collect()} == expected
