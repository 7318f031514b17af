"""Problem 8: rates, rounding, caps and the classifier."""

import numpy as np
import pandas as pd
import pytest

from siftlake.llm import mixing, p8

DOCS = "doc_id bigint, text string, source string, key string, member string"


def corpus(spark, sizes, words=60):
    rows, k = [], 0
    for source, count in sizes.items():
        for _ in range(count):
            rows.append((k, " ".join(f"{(source or 'big')}{(k * 7 + i) % 90}" for i in range(words + k % 5)), source.upper() if source and k % 2 else source, "x", "y"))
            k += 1
    return spark.createDataFrame(rows, DOCS)


def mix_of(spark, docs, targets):
    members, names = mixing.memberships(docs, "doc_id", "text", "source")
    mixes = mixing.read_mixes(pd.DataFrame(targets, columns=["mix_id", "source", "target_share", "max_repeats"]), names)
    moves = mixing.fit_rates(members, names, mixes)
    return mixing.copies(members, names, mixes, moves).toPandas(), names, mixes, members


def test_shares_and_repeats(spark):
    docs = corpus(spark, {"big": 300, "mid": 120, "small": 20})
    got, names, mixes, _ = mix_of(spark, docs, [(1, "BIG", 0.5, 1), (1, " mid", 0.3, 2), (1, "small", 0.2, 4), (2, "small", 3.0, 3), (2, "big", 1.0, 1), (2, "nowhere", 1.0, 2)])
    for m in mixes:
        own = got[got.mix_id == m.mix_id]
        tokens = np.bincount(own.label, weights=own.n_tokens * own.copies, minlength=len(names))
        assert np.abs(tokens / tokens.sum() - m.share).max() < 0.02
        assert (own.copies <= m.repeats[own.label]).all()
        # the size is the largest that lets every source reach its share
        assert tokens.sum() == pytest.approx(m.target.sum(), rel=0.03)


def test_unlabelled_documents_join_their_likeliest_domain(spark):
    docs = corpus(spark, {"big": 150, "mid": 150, None: 60})  # the unlabelled ones are worded like 'big'
    members, names = mixing.memberships(docs, "doc_id", "text", "source")
    soft = members.filter("label is null").toPandas()
    assert len(soft) == 60 and (soft.level >= 0).all() and (soft.level <= mixing.GRAIN // 2).all()
    assert np.mean([names[f] == "big" for f in soft["first"]]) > 0.95
    got, names, mixes, _ = mix_of(spark, docs, [(1, "big", 0.5, 1), (1, "mid", 0.5, 1)])
    assert abs(got[got.label == names.index("big")].n_tokens.sum() / got.n_tokens.sum() - 0.5) < 0.03


def test_held_out_accuracy(spark):
    docs = corpus(spark, {"big": 200, "mid": 200, "small": 200})
    model = mixing.fit_classifier(docs.select("doc_id", "text", mixing.domain(docs.source).alias("label")), "doc_id", "text", "label", ["big", "mid", "small"], 100)
    from siftlake.functions.words import codes

    rows = docs.collect()
    assert np.mean([["big", "mid", "small"][int(mixing.posterior(model, codes(r.text)).argmax())] == r.source.lower() for r in rows]) > 0.95


def test_every_document_is_classified(spark):
    """A label is strong evidence, not the only one: a text that speaks clearly for another domain moves part of its membership there."""
    docs = corpus(spark, {"big": 150, "mid": 150, "small": 150})
    wrong = docs.filter("source = 'big' and doc_id < 8").selectExpr("doc_id + 100000 AS doc_id", "text", "'mid' AS source", "key", "member")
    members, names = mixing.memberships(docs.unionByName(wrong), "doc_id", "text", "source")
    rows = members.toPandas()
    odd = rows[rows.key >= 100_000]
    plain = rows[rows.key < 100_000]
    share = lambda r, name: (1 - r.level / mixing.GRAIN) * (r["first"] == names.index(name)) + r.level / mixing.GRAIN * (r["second"] == names.index(name))
    assert share(odd, "big").mean() > 0.2 and (odd.label == names.index("mid")).all()
    assert (plain["first"] == plain.label).mean() > 0.99 and plain.level.mean() < 0.02 * mixing.GRAIN
    assert mixing.by_membership(members).count() < len(rows) / 4


def test_fitted_rates_are_the_least_squares_ones(spark):
    """Against projected gradients over single documents with a tiny step."""
    docs = corpus(spark, {"big": 200, "mid": 100, None: 60})
    members, names = mixing.memberships(docs, "doc_id", "text", "source")
    mixes = mixing.read_mixes(pd.DataFrame([(1, "big", 0.4, 2), (1, "mid", 0.6, 2)], columns=["mix_id", "source", "target_share", "max_repeats"]), names)
    mixing.fit_rates(members, names, mixes)
    rows = members.toPandas()
    dense = np.zeros((len(rows), len(names)))
    dense[np.arange(len(rows)), rows["first"]] += 1 - rows.level / mixing.GRAIN
    dense[np.arange(len(rows)), rows["second"]] += rows.level / mixing.GRAIN
    home = np.where(rows.label.isna(), rows["first"], rows.label).astype(int)
    rate, base = np.zeros(len(rows)), rows.n_tokens.to_numpy() @ dense
    for _ in range(3000):
        gap = ((rate * rows.n_tokens.to_numpy()) @ dense - mixes[0].target) / base
        rate = np.clip(rate - 0.1 * dense @ gap, 0, mixes[0].repeats[home])
    assert np.allclose((rate * rows.n_tokens.to_numpy()) @ dense, mixes[0].expected, rtol=0.02)


def test_small_sources_keep_their_labels(spark):
    """A source of few documents, worded like all others, isn't taken for a part of the largest one."""
    rows = [(k, " ".join(f"w{(k * 31 + i * 7) % 400}" for i in range(80)), "tiny" if k < 12 else "vast", "x", "y") for k in range(1200)]
    members, names = mixing.memberships(spark.createDataFrame(rows, DOCS), "doc_id", "text", "source")
    tiny = members.filter(f"label = {names.index('tiny')}").toPandas()
    assert (tiny["first"] == names.index("tiny")).all() and tiny.level.mean() < 0.1 * mixing.GRAIN
    got, names, mixes, _ = mix_of(spark, spark.createDataFrame(rows, DOCS), [(1, "tiny", 0.02, 3), (1, "vast", 0.98, 2)])
    tokens = np.bincount(got.label, weights=got.n_tokens * got.copies, minlength=2)
    assert np.abs(tokens / tokens.sum() - mixes[0].share).max() < 0.005


def test_cases(spark):
    docs = spark.createDataFrame([(1, None, "a", "", ""), (2, "", "a", "", ""), (3, "some words here", "b", "", ""), (4, "more words", None, "", ""), (5, "x " * 50_000, "b", "", "")], DOCS)
    got, _, _, _ = mix_of(spark, docs, [(1, "a", 0.5, 1), (1, "b", 0.5, 2)])
    assert set(got.key) <= {3, 4, 5}
    got, _, _, _ = mix_of(spark, docs.limit(0), [(1, "a", 1.0, 1)])
    assert got.empty
    got, _, _, _ = mix_of(spark, docs, [(1, "a", 0.0, 1)])
    assert got.empty


def test_query(spark, folder):
    got = p8.p8_shares(spark, folder).toPandas()
    assert len(got) == 45 and (got.most_repeats <= got.max_repeats).all()
    assert got.groupby("mix_id").reached_share.sum().round(6).eq(1).all()
