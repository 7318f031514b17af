"""Problem 8: mixing sources to target weights by soft membership and projected gradients.

A classifier fitted on labelled documents predicts for *every* document how likely its text belongs to each domain (source).  A label is
strong but not certain evidence beside the text: it holds with probability ``1 - NOISE``.  The posterior of both is the document's
soft membership, kept on its two likeliest domains in ``GRAIN``-ths.  Nonnegative rates, at most the allowed repeats, are fitted by least squares so that the
expected tokens of every domain match their targets.  Documents of equal membership have equal rates, so the distributed gradient runs over the
tokens summed by membership, and only domains' totals reach the driver.  Rounding to whole copies then goes by the labels themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.functions.words import codes, mix
from siftlake.llm import tokens
from siftlake.session import bounded, drop_stage, stage

#: Labelled documents that the classifier is fitted on, about at most (those with the smallest hashes of their keys); its hashed features.
FIT_DOCUMENTS, FEATURES = 20_000, 1 << 13
#: Words of the whole corpus that stand in each domain's counts beforehand.
COMMON_WORDS = 2000.0
#: A label is wrong with this probability; memberships are kept in so many parts.
NOISE, GRAIN = 0.02, 64
#: More sources than this would be no table for the driver.
MOST_SOURCES = 1000
#: Rates are fitted until all totals are this close to their targets, relative to the mix, or an iteration brings them no nearer.
ITERATIONS, CLOSE, NO_NEARER = 40, 1e-4, 1e-3
#: Bins of the cut between rounding up and down.
BINS = 4096
#: Passes that fill a domain's rest with ever smaller documents.
PASSES = 5
MEMBER = ("label", "first", "second", "level")


@dataclass
class Mix:
    """One mix: the domains' shares (summing to 1 over those with documents) and repeats, and its size in tokens."""

    mix_id: int
    share: np.ndarray
    repeats: np.ndarray
    asked: dict[str, tuple[float, int]]
    target: np.ndarray = field(default_factory=lambda: np.empty(0))
    expected: np.ndarray = field(default_factory=lambda: np.empty(0))


def domain(column) -> F.Column:
    """A source in one way of writing; a null or blank one is no label."""
    name = F.lower(F.trim(column))
    return F.when(name != "", name)


def fit_classifier(documents: DataFrame, key: str, text: str, label: str, names: list[str], limit: int) -> np.ndarray:
    """Multinomial naive Bayes over hashed words: log likelihoods (domains x features), the last column the log prior.

    It reads the labelled documents whose keys hash into the share that makes about ``limit`` of them, all if there are fewer.
    """
    labelled = documents.filter(F.col(label).isNotNull())
    total = labelled.select(label).count()
    share = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("fit")), F.lit(1 << 30)) < int(min(1.0, limit / max(total, 1)) * (1 << 30))
    place = {n: i for i, n in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[int, int] = {}
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = codes(body.as_py())
                cells = place[name] * (FEATURES + 1) + np.concatenate([(mix(words, 9) % np.uint64(FEATURES)).astype(np.int64), [FEATURES]])
                for cell, n in zip(*np.unique(cells, return_counts=True)):
                    counts[int(cell)] = counts.get(int(cell), 0) + int(n)
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["cell", "n"])

    summed = labelled.filter(share).select(label, text).mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(len(names) * (FEATURES + 1))
    table[summed["cell"].to_numpy(dtype=np.int64)] = summed["n"].to_numpy(dtype=float)
    table = table.reshape(len(names), FEATURES + 1)
    whole = table[:, :-1].sum(axis=0) + 0.1
    seen = table[:, :-1] + COMMON_WORDS * whole / whole.sum()  # small domains fall back on the words of all
    words = np.log(seen) - np.log(seen.sum(axis=1, keepdims=True))
    prior = np.log(table[:, -1:] + 1.0) - np.log((table[:, -1:] + 1.0).sum())
    return np.hstack([words, prior])


def posterior(model: np.ndarray, words: np.ndarray, label: int | None = None) -> np.ndarray:
    """Domain probabilities of a text and its label, if it has one; the text's evidence is tempered by its length, as words aren't independent.

    How frequent domains are counts for texts without a label only: a small source's label would be outweighed by it.
    """
    score = model[:, -1].copy() if label is None else np.zeros(len(model))
    if len(words):
        cells, n = np.unique((mix(words, 9) % np.uint64(FEATURES)).astype(np.int64), return_counts=True)
        score += (model[:, cells] @ n) / np.sqrt(len(words))
    if label is not None and len(score) > 1:
        score[label] += np.log((1 - NOISE) * (len(score) - 1) / NOISE)
    score = np.exp(score - score.max())
    return score / score.sum()


def memberships(documents: DataFrame, key: str, text: str, source: str, vocabulary: str = tokens.DEFAULT_VOCABULARY, fit_documents: int = FIT_DOCUMENTS) -> tuple[DataFrame, list[str]]:
    """``key, n_tokens, label, first, second, level``: the tokens of each document and its membership, ``level`` GRAIN-ths of it in ``second``.

    The domains are those of the labelled documents; ``label`` is null without one.  Null and empty texts have no tokens, and their label alone to go by.
    """
    spark = documents.sparkSession
    given = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), domain(F.col(source)).alias("label"))
    names = sorted(r[0] for r in bounded(given.select("label").dropna().distinct(), MOST_SOURCES))
    model = fit_classifier(given, "key", "text", "label", names, fit_documents) if names else None
    shared = spark.sparkContext.broadcast(model)
    place, path = {n: i for i, n in enumerate(names)}, tokens.vocabulary_path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for body, name in zip(batch.column(1), batch.column(2).to_pylist()):
                body, label = body.as_py(), place.get(name)
                first, second, level = 0, 0, 0
                if model is not None:
                    share = posterior(model, codes(body), label)
                    first, second = int(share.argmax()), 0
                    if len(share) > 1:
                        rest = share.copy()
                        rest[first] = -1.0
                        second = int(rest.argmax())
                        level = int(round(GRAIN * share[second] / (share[first] + share[second])))
                for column, value in zip(columns, (tokens.count(body, path), label, first, second if level else first, level)):
                    column.append(value)
            kinds = (pa.int64(), *(pa.int32(),) * 4)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["key", "n_tokens", *MEMBER])

    kind = documents.schema[key].dataType.simpleString()
    return stage(given.mapInArrow(run, f"key {kind}, n_tokens bigint, label int, first int, second int, level int"), "members"), names


def by_membership(members: DataFrame) -> DataFrame:
    """Tokens summed by membership; with the rates of its row each document has its own."""
    return stage(members.groupBy(*MEMBER).agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("documents")), "vectors")


def _dense(batch: pa.RecordBatch, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Memberships (rows x domains), tokens and homes (the label, else the likeliest domain) of a batch."""
    first, second, level = (batch.column(c).to_numpy(zero_copy_only=False).astype(int) for c in MEMBER[1:])
    home = np.array([f if x is None else x for x, f in zip(batch.column("label").to_pylist(), first)], dtype=int)
    dense = np.zeros((len(first), count))
    if count:
        rows = np.arange(len(first))
        np.add.at(dense, (rows, first), 1 - level / GRAIN)
        np.add.at(dense, (rows, second), level / GRAIN)
    return dense, np.asarray(batch.column("n_tokens").to_numpy(zero_copy_only=False), dtype=float), home


def _rates(dense: np.ndarray, home: np.ndarray, repeats: np.ndarray, share: np.ndarray, moves: list[np.ndarray]) -> np.ndarray:
    """Rates after the moves so far: each a step against the gradient, projected to 0..repeats of the row's home.

    A move has two rows: what it takes from a rate by membership, and by home.
    """
    if not dense.shape[1] or not len(dense):
        return np.zeros(len(dense))
    own, back = np.unique(np.column_stack([home, dense]), axis=0, return_inverse=True)
    at = own[:, 0].astype(int)
    most = np.where(share > 0, repeats, 0)[at]
    rate = np.zeros(len(own))
    for soft, hard in moves:
        rate = np.clip(rate - own[:, 1:] @ soft - hard[at], 0.0, most)
    return rate[back.ravel()]


def _totals(vectors: DataFrame, mixes: list[Mix], moves: list[list[np.ndarray]], count: int) -> np.ndarray:
    """Tokens as expected by membership (0) and by home (1), of all documents once (row 0) and of each mix under the rates so far, by domain."""
    shared = vectors.sparkSession.sparkContext.broadcast(([(m.repeats, m.share) for m in mixes], moves))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits, moves = shared.value
        total = np.zeros((2, len(limits) + 1, count))
        for batch in batches:
            dense, size, home = _dense(batch, count)
            every = [size] + [size * _rates(dense, home, repeats, share, own) for (repeats, share), own in zip(limits, moves)]
            for i, taken in enumerate(every if count else ()):
                total[0, i] += taken @ dense
                np.add.at(total[1, i], home, taken)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "t"])

    rows = vectors.select(*MEMBER, "n_tokens").mapInArrow(run, "cell bigint, t double").groupBy("cell").agg(F.sum("t").alias("t")).toPandas()
    total = np.zeros(2 * (len(mixes) + 1) * count)
    total[rows["cell"].to_numpy(dtype=np.int64)] = rows["t"]
    return total.reshape(2, len(mixes) + 1, count)


def fit_rates(members: DataFrame, names: list[str], mixes: list[Mix], iterations: int = ITERATIONS) -> list[list[np.ndarray]]:
    """Moves that lead from zero to the least-squares rates of each mix; sets the mixes' token targets and expected totals.

    A mix is as large as lets every domain that has documents reach its share within its repeats.  The gradient is scaled by the
    domains' tokens, so domains of any size converge alike.  Expected totals come first; then the domains' rates are shifted as wholes until the totals by label, which
    are what is asked for, match as well.
    """
    count, vectors = len(names), by_membership(members)
    moves: list[list[np.ndarray]] = [[] for _ in mixes]
    total = _totals(vectors, mixes, moves, count)
    base, held = total[0, 0], total[1, 0]
    for m in mixes:
        m.share = np.where(held > 0, m.share, 0.0)
        m.share = m.share / m.share.sum() if m.share.sum() > 0 else m.share
        wanted = m.share > 0
        size = (m.repeats[wanted] * held[wanted] / m.share[wanted]).min() if wanted.any() else 0.0
        m.target = m.share * size
    for side, weight in enumerate((base, held)):
        before = np.inf
        for _ in range(iterations):
            off = max((np.abs(t - m.target).sum() / max(m.target.sum(), 1.0) for t, m in zip(total[side, 1:], mixes)), default=0.0)
            if off <= CLOSE or off >= (1 - NO_NEARER) * before:
                break
            before = off
            for own, t, m in zip(moves, total[side, 1:], mixes):
                step = np.zeros((2, count))
                step[side] = np.where(weight > 0, (t - m.target) / np.maximum(weight, 1.0), 0.0)
                own.append(step)
            total = _totals(vectors, mixes, moves, count)
    drop_stage(vectors)
    for m, t in zip(mixes, total[0, 1:]):
        m.expected = t
    return moves


def copies(members: DataFrame, names: list[str], mixes: list[Mix], moves: list[list[np.ndarray]], passes: int = PASSES) -> DataFrame:
    """Whole copies of each document in each mix: ``mix_id, key, label, n_tokens, copies`` (documents without copies have no row, nor do those
    without tokens).

    A rate is rounded up or down by its fraction against the document's own fixed draw.  The cut between both is moved for each
    domain, by a histogram over all documents, to where the domain's tokens come closest below its target; further passes fill what is
    left with documents no larger than that.  A document never exceeds its domain's repeats; one without a label goes by its
    most probable domain.
    """
    spark, count = members.sparkSession, len(names)
    plan = spark.sparkContext.broadcast(([(m.mix_id, m.repeats, m.share) for m in mixes], moves))
    kind = members.schema["key"].dataType.simpleString()
    target = np.array([m.target for m in mixes]).reshape(len(mixes), count)

    def chosen(batch: pa.RecordBatch, cuts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple]:
        """For each mix: home domain, size, whole copies, bin of the margin (-1: no further copy allowed), rounded up so far."""
        limits, moves = plan.value
        dense, size, home = _dense(batch, count)
        draw = mix(codes(" ".join(str(k) for k in batch.column("key").to_pylist())), 77) / 2.0**64
        for i, ((mix_id, repeats, share), own) in enumerate(zip(limits, moves)):
            rate = _rates(dense, home, repeats, share, own)
            whole = np.where(size > 0, np.floor(rate), 0.0)
            room = (size > 0) & (np.where(share > 0, repeats, 0)[home] > whole) if count else np.zeros(len(dense), dtype=bool)
            place = np.where(room, np.clip(((rate - whole - draw + 1) / 2 * BINS).astype(int), 0, BINS - 1), -1)
            up = np.zeros(len(dense), dtype=bool)
            for cut, limit in cuts:
                up |= (place >= 0) & (place >= cut[i][home]) & (size <= limit[i][home])
            yield i, mix_id, home, size, whole, place, up

    def histogram(cuts: list, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the documents that could still be rounded up, by bin; tokens chosen so far."""
        shared = spark.sparkContext.broadcast((cuts, room))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cuts, room = shared.value
            open_, taken = np.zeros((len(mixes), count, BINS)), np.zeros((len(mixes), count))
            for batch in batches:
                for i, _, home, size, whole, place, up in chosen(batch, cuts):
                    np.add.at(taken[i], home, size * (whole + up))
                    can = (place >= 0) & ~up & (size <= room[i][home]) & (size > 0)
                    np.add.at(open_[i], (home[can], place[can]), size[can])
            cells = np.concatenate([open_.ravel(), taken.ravel()])
            at = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], names=["cell", "t"])

        rows = members.mapInArrow(run, "cell bigint, t double").groupBy("cell").agg(F.sum("t").alias("t")).toPandas()
        cells = np.zeros(len(mixes) * count * (BINS + 1))
        cells[rows["cell"].to_numpy(dtype=np.int64)] = rows["t"]
        head = len(mixes) * count * BINS
        return cells[:head].reshape(len(mixes), count, BINS), cells[head:].reshape(len(mixes), count)

    cuts: list[tuple[np.ndarray, np.ndarray]] = []
    room = np.full((len(mixes), count), np.inf)
    for _ in range(passes):
        open_, taken = histogram(cuts, room)
        cut, gap = np.full((len(mixes), count), BINS), target - taken
        for i in range(len(mixes)):
            for s in range(count):
                above = np.cumsum(open_[i, s][::-1])
                cut[i, s] = BINS - int(np.searchsorted(above, gap[i, s] * (1 + 1e-9), "right"))
                gap[i, s] -= above[BINS - cut[i, s] - 1] if cut[i, s] < BINS else 0.0
        cuts.append((cut, room))
        if (gap <= 0.001 * target.sum(axis=1, keepdims=True)).all():
            break
        room = np.maximum(gap, 0.0)
    final = spark.sparkContext.broadcast(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(np.empty(0, dtype=int),) * 5]
            for _, mix_id, home, size, whole, _, up in chosen(batch, final.value):
                n = (whole + up).astype(int)
                at = np.flatnonzero(n)
                parts.append((np.full(len(at), mix_id), at, home[at], size[at].astype(int), n[at]))
            mix_ids, at, home, size, n = (np.concatenate([p[k] for p in parts]) for k in range(5))
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix_ids, pa.int32()), batch.column("key").take(pa.array(at, pa.int64())), pa.array(home, pa.int32()), pa.array(size, pa.int64()), pa.array(n, pa.int32())],
                names=["mix_id", "key", "label", "n_tokens", "copies"],
            )

    return members.mapInArrow(run, f"mix_id int, key {kind}, label int, n_tokens bigint, copies int")


def read_mixes(targets: pd.DataFrame, names: list[str]) -> list[Mix]:
    """Mixes of a target table: sources in any case, shares of any sum; a source listed twice adds up."""
    mixes, place = [], {n: i for i, n in enumerate(names)}
    for mix_id, rows in targets.groupby("mix_id", sort=True):
        share, repeats, asked = np.zeros(len(names)), np.zeros(len(names)), {}
        for name, part, most in zip(rows["source"].str.strip().str.lower(), rows["target_share"], rows["max_repeats"]):
            before = asked.get(name, (0.0, 0))
            asked[name] = (before[0] + max(float(part), 0.0), max(before[1], int(most)))
        for name, (part, most) in asked.items():
            if name in place and most > 0:
                share[place[name]], repeats[place[name]] = part, most
        mixes.append(Mix(int(mix_id), share, repeats, asked))
    return mixes
