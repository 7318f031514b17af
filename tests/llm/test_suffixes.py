"""Problem 2: merged suffix arrays against the definition, and their cases."""

import datetime
import json
import random

import numpy as np

from siftlake.functions.words import codes
from siftlake.llm import p1, p2, suffixes
from siftlake.session import table


def test_reasons_against_definition(spark, folder):
    batches = {r.id: r for r in table(spark, folder, "acquisitions").collect()}
    records = {r.id: r for r in table(spark, folder, "source_records").collect()}
    at = {i: datetime.datetime.fromisoformat(batches[r.acquisition_id].observed_at) for i, r in records.items()}
    near: dict[str, list] = {}
    for r in p1.p1_found(spark, folder).collect():
        near.setdefault(r.id_a, []).append(r.id_b)
        near.setdefault(r.id_b, []).append(r.id_a)
    first_response: dict = {}
    for b in batches.values():
        t = datetime.datetime.fromisoformat(b.observed_at)
        first_response[b.response_sha256] = min(t, first_response.get(b.response_sha256, t))
    got = {r.source_record_id: r for r in p2.p2_reasons(spark, folder).collect()}
    assert set(got) == set(records)
    for i, r in records.items():
        assert got[i].by_response == (first_response[batches[r.acquisition_id].response_sha256] < at[i])
        assert got[i].by_content == any(at[j] < at[i] for j in near.get(i, [])), i


def test_result_does_not_depend_on_batches(spark, folder):
    results = [sorted(map(tuple, p2.repeated_records(spark, folder, epochs).collect())) for epochs in (1, 5)]
    assert results[0] == results[1]


def test_edited_copies_find_their_earlier_relatives(spark, tmp_path):
    rng = random.Random(11)
    base, days = [f"w{i}" for i in range(130)], list(range(300))
    rng.shuffle(days)
    texts = []
    for i in range(300):
        own = list(base)
        for k in rng.sample(range(130), 10):
            own[k] = f"x{i}y{k}"
        texts.append(own)
    start = datetime.datetime(2020, 1, 1)
    at = [(start + datetime.timedelta(days=d)).isoformat() + "Z" for d in days]
    spark.createDataFrame([(f"a{i}", f"h{i}", t) for i, t in enumerate(at)], "id string, response_sha256 string, observed_at string").write.parquet(f"{tmp_path}/acquisitions.parquet")
    rows = [(f"r{i}", f"a{i}", f"doi:10.1234/{i}", "", json.dumps({"abstract": " ".join(t)})) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "id string, acquisition_id string, identity_key string, title string, raw_json string").write.parquet(f"{tmp_path}/source_records.parquet")
    spark.createDataFrame([], "identity_key string").write.parquet(f"{tmp_path}/shared_identifiers.parquet")
    sets = [set(t) for t in texts]
    near = lambda i, j: len(sets[i] & sets[j]) >= 0.7 * len(sets[i] | sets[j])
    expected = {f"r{i}" for i in range(300) if any(days[j] < days[i] and near(i, j) for j in range(300) if j != i)}
    assert len(expected) > 250
    assert {r[0] for r in p2.p2_found(spark, str(tmp_path)).collect()} == expected


def _records(spark, rows, start=0):
    """Texts as records of a batch; their instants rise in order."""
    raw = spark.createDataFrame([(f"r{i}", "", json.dumps({"abstract": t}), start + k) for k, (i, t) in enumerate(rows)], "id string, title string, raw_json string, at bigint")
    return p2.described(raw, ("at",))


def _repeats(history, rows, start=0):
    found = history.accept(_records(history.spark, rows, start), ()).collect()
    return {r.id for r in found if r.first_content < r.at}


SENTENCE = "the quick brown fox jumps over the lazy dog while seven wizards watch from a distant tower at noon"


def test_history_merges_logarithmically(spark):
    history = suffixes.History(spark, 4, 0.7)
    found = set()
    for batch in range(4):
        rows = [(batch * 10, f"{SENTENCE} record {batch}"), (batch * 10 + 1, " ".join(f"u{batch}x{i}" for i in range(40)))]
        found |= _repeats(history, rows, 100 * batch)
        assert [t for t, _ in history.segments] == [i for i in range(10) if (batch + 1) >> i & 1][::-1]
    assert found == {f"r{10 * b}" for b in range(1, 4)}
    history.forget()


def test_history_outlives_the_session(spark):
    first = suffixes.History(spark, 4, 0.7)
    _repeats(first, [(1, f"{SENTENCE} one")])
    _repeats(first, [(2, " ".join(f"v{i}" for i in range(60)))], 10)
    again = suffixes.History.open(spark, first.folder)
    assert (again.batches, again.segments, again.buckets) == (2, first.segments, 4)
    assert _repeats(again, [(3, f"{SENTENCE} three"), (4, "something else altogether"), (5, " ".join(f"v{i}" for i in range(60)))], 20) == {"r3", "r5"}
    assert suffixes.History.open(spark, first.folder).batches == 3


def test_every_holder_is_reached(spark):
    """B's suffixes are held by four others, none of which is near to it; the edited B is found all the same."""
    part = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    x, y = part("x", 120), part("y", 120)
    history = suffixes.History(spark, 4, 0.7)
    texts = [f"{x} {part('p', 90)}", f"{y} {part('q', 90)}", f"{x} {y}", f"{x} {part('s', 90)}", f"{y} {part('t', 90)}"]
    for i, text in enumerate(texts):
        assert not _repeats(history, [(i, text)], i)
    assert _repeats(history, [(9, f"{x} {y}".replace("x5 ", "edit1 ").replace("y77 ", "edit2 "))], 50) == {"r9"}


def test_hot_wording_reaches_late_holders(spark, monkeypatch):
    """Wording that more texts hold than the first search lists: the one relative among them is the last."""
    monkeypatch.setattr(suffixes, "HOLDERS", 2)
    monkeypatch.setattr(suffixes, "FEW", 1)
    part = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    common = part("c", 40)
    history = suffixes.History(spark, 4, 0.7)
    _repeats(history, [(i, f"{common} {part(f'own{i}w', 60)}") for i in range(20)])
    near = " ".join(w if k % 7 else f"new{k}" for k, w in enumerate(part("own19w", 60).split()))
    assert _repeats(history, [(50, f"{common} {near}")], 100) == {"r50"}
    assert _repeats(history, [(60, f"{common} {part('fresh', 60)}")], 200) == set()


def _exchanged(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line]


def test_history_is_not_shuffled(spark):
    history = suffixes.History(spark, 4, 0.7)
    for batch in range(3):
        _repeats(history, [(100 * batch + i, " ".join(f"b{batch}t{i}w{k}" for k in range(50))) for i in range(50)], 1000 * batch)
    queries = spark.createDataFrame([(1, [1], [2], [3])], suffixes.QUERY)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for segment in history.segment_rows():
            plan = queries.repartition(4, "bucket").join(segment, "bucket")
            assert len(_exchanged(plan)) == 1  # the batch's own
        for held, key in ((history.texts(), "cid"), (history.keys(), "key")):
            asked = spark.createDataFrame([(1,)], f"{key} bigint").repartition(4, key)
            assert len(_exchanged(asked.join(held, key))) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_suffix_cases(spark):
    keys = lambda text: suffixes.suffix_keys(codes(text))[0]
    assert len(keys(None)) == 0
    assert len(keys("one two")) == 1 and suffixes.suffix_keys(codes("one two"))[1].tolist() == [-1]
    assert len(keys(" ".join(map(str, range(200_000))))) > 10_000
    run = [f"s{i}" for i in range(suffixes.DEPTH + suffixes.WINDOW - 1)]
    a = keys(" ".join([f"a{i}" for i in range(50)] + run + [f"b{i}" for i in range(50)]))
    b = keys(" ".join([f"c{i}" for i in range(31)] + run + [f"d{i}" for i in range(9)]))
    assert len(np.intersect1d(a, b)) >= 1
    own, masks = suffixes.suffix_keys(codes(" ".join(f"w{i}" for i in range(64))))
    assert all(int(m).bit_count() == suffixes.DEPTH for m in masks.view(np.uint64)) and int(np.bitwise_or.reduce(masks).view(np.uint64)).bit_count() > 50
    assert suffixes.History(spark, 2, 0.7).accept(_records(spark, []), ()).count() == 0


def test_bounded_pieces_find_the_same(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(3)
    held, asked = np.sort(rng.integers(0, 40, 300)), rng.integers(0, 40, 60)
    names = ["bucket", "q_keys", "q_cids", "q_masks", "keys", "cids"]
    cell = lambda v: pa.array([v], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), cell(asked), cell(np.arange(60) % 9), cell(np.ones(60, dtype=np.int64)), cell(held), cell(np.arange(300) % 50 + 100)], names=names)
    pairs = lambda: {t[:2] for b in suffixes.search(True)(iter([batch])) for t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    expected = {(int(q % 9), int(h % 50 + 100)) for q in range(60) for h in range(300) if asked[q] == held[h]}
    assert pairs() == expected
    monkeypatch.setattr(suffixes, "PIECE", 7)
    assert pairs() == expected
