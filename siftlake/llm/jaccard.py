"""Problem 1: records with largely the same words, by a metric-space join on Jaccard distances.

The distance of two word sets, one minus their Jaccard similarity, is a metric.  The join works on
classes of equal sets and is exact at every step:

1. *Cells.*  Classes drawn by hash are pivots; each class belongs to the Voronoi cell of its nearest one.  If y's cell is that of
   q and x's that of p, a pair within the radius has d(x, q) <= d(x, p) + 2 radius, so a class goes to its own cell and to those in
   that window.  Large cells are cut into blocks, and every two blocks that have rows for each other meet in a task of their own.
2. *Bounds.*  Distances between unrelated records crowd together far above the radius, so windows leave most pairs open.  These are thinned
   by two bounds that no pair within the radius exceeds: the ratio of the sizes, and the bits in which the sets' sketches differ.  A sketch holds the parity
   of the words that fall on each bit, so two sketches differ in at most as many bits as their sets differ in words.
3. *Words.*  The pairs left, hardly any others than those within the radius, are compared word by word.
4. *Result.*  Pairs of class representatives; ``expand`` and ``groups`` turn them into rows for records.

``part_keys`` (hashed parts of the vocabulary) serves problem 5, ``join_region`` joins a list of sets in memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.functions.words import mix
from siftlake.llm.boruvka import boruvka_components
from siftlake.session import drop_stage, stage

TREES = 8
DEPTH = 7
#: Words that stand in one of so many sets are counted exactly; there are at most RARE words a mean set of them.
RARE = 1024
#: A part of a set stands for about 2^-SPARE sets other than its own relatives.
SPARE = 1.0
#: Words of nearly all sets still count for something, else sets that are all alike would have no telling part.
LEAST_BITS = 0.5
CELL = 48
#: Classes of a block are so many times the square root of the table's over BLOCK_ROOT, so that blocks grow in number and in size.
BLOCK, BLOCK_ROOT = 2000, 20
PIVOTS = 16
#: Bits of the smallest sketch, and bits a word that a sketch has at least: unrelated sets then differ in far more bits than close ones.
SKETCH_BITS, WORD_BITS = 256, 1.7
#: Sketches that are compared at a time with each other, so that they stay in the cache.
ROWS, TILE = 32, 1024


def set_signatures(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums of mixed word codes for each set: equal sets, equal signatures."""
    out = []
    for seed in (101, 102):
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.add.accumulate(mix(flat, seed))])
            out.append((sums[offsets[1:]] - sums[offsets[:-1]]).astype(np.int64))
    return out[0], out[1]


def part_keys(flat: np.ndarray, owner: np.ndarray, known: np.ndarray, rarity: np.ndarray, rest: float, least: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the informative parts of each set under one vocabulary tree: ``(key, owner)``.

    ``rarity`` holds the bits of the ``known`` (sorted) codes, any other word has ``rest`` bits.  A part counts
    if the bits of the set's words in it reach ``least`` while those of neither half do.
    """
    place = mix(flat, seed)
    order = np.lexsort((place, owner))
    flat, owner, place = flat[order], owner[order], place[order]
    at = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
    bits = np.where(known[at] == flat, rarity[at], rest) if len(known) else np.full(len(flat), rest)
    sums = np.concatenate([[0.0], np.cumsum(bits)])
    with np.errstate(over="ignore"):
        hashes = np.concatenate([np.zeros(1, dtype=np.uint64), np.add.accumulate(mix(flat, seed + 1000))])
    keys, owners = [], []
    below = None  # for each word: whether its part one level down is informative
    for level in range(DEPTH, -1, -1):
        node = place >> np.uint64(64 - level) if level else np.zeros(len(place), dtype=np.uint64)
        start = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (owner[1:] != owner[:-1])])) if len(node) else np.empty(0, dtype=np.int64)
        end = np.append(start[1:], len(node))
        enough = sums[end] - sums[start] >= least
        mine = enough if below is None else enough & ~np.logical_or.reduceat(below, start) if len(start) else enough
        with np.errstate(over="ignore"):
            key = hashes[end[mine]] - hashes[start[mine]] + np.uint64(level * 2654435761 + seed)
        keys.append(mix(key, 7).astype(np.int64))
        owners.append(owner[start[mine]])
        below = np.repeat(enough, end - start)
    return np.concatenate(keys), np.concatenate(owners)


def distance(a: frozenset, b: frozenset) -> float:
    """Jaccard distance; two empty sets are equal."""
    common = len(a & b)
    union = len(a) + len(b) - common
    return 1.0 - common / union if union else 0.0


def join_region(sets: list[frozenset], radius: float) -> dict[tuple[int, int], float]:
    """All pairs of a region within ``radius``, exactly: ``(i, j) -> distance`` with i < j."""
    found: dict[tuple[int, int], float] = {}
    _join(sets, list(range(len(sets))), radius, found)
    return found


def _join(sets: list[frozenset], own: list[int], radius: float, found: dict) -> None:
    """Pairs within ``own``: few are compared in windows around one pivot, many fall into the Voronoi cells of several.

    If y's nearest pivot is q and x's is p, a pair within the radius has d(x, q) <= d(x, p) + 2 radius, so each cell meets only those
    members of later cells that lie in that window.
    """
    if len(own) <= CELL:
        _pairs(sets, own, radius, found)
        return
    pivots = [own[0]]
    reach = np.array([[distance(sets[i], sets[pivots[0]]) for i in own]])
    while len(pivots) < math.isqrt(len(own)):
        far = int(reach.min(axis=0).argmax())
        if reach[:, far].min() <= radius:
            break
        pivots.append(own[far])
        reach = np.vstack([reach, [distance(sets[i], sets[pivots[-1]]) for i in own]])
    home, nearest = reach.argmin(axis=0), reach.min(axis=0)
    for cell in range(len(pivots)):
        inside = [i for i, h in zip(own, home) if h == cell]
        window = [i for i, h, d, n in zip(own, home, reach[cell], nearest) if h > cell and d <= n + 2 * radius + 1e-9]
        if len(inside) < len(own):
            _join(sets, inside, radius, found)
            _cross(sets, inside, window, radius, found)
        else:
            _pairs(sets, inside, radius, found)


def _sorted_by_pivot(sets: list[frozenset], members: list[int], pivot: frozenset) -> tuple[list[int], list[float]]:
    away = sorted((distance(sets[i], pivot), i) for i in members)
    return [i for _, i in away], [d for d, _ in away]


def _pairs(sets: list[frozenset], members: list[int], radius: float, found: dict) -> None:
    """Compare the pairs that the triangle inequality leaves open around the first member."""
    if len(members) < 2:
        return
    ids, away = _sorted_by_pivot(sets, members, sets[members[0]])
    for x in range(len(ids)):
        for y in range(x + 1, len(ids)):
            if away[y] - away[x] > radius:
                break
            _compare(sets, ids[x], ids[y], radius, found)


def _cross(sets: list[frozenset], left: list[int], right: list[int], radius: float, found: dict) -> None:
    if not left or not right:
        return
    pivot = sets[left[0]]
    ids, away = _sorted_by_pivot(sets, right, pivot)
    low = 0
    for i, d in zip(*_sorted_by_pivot(sets, left, pivot)):
        while low < len(ids) and away[low] < d - radius:
            low += 1
        for y in range(low, len(ids)):
            if away[y] - d > radius:
                break
            _compare(sets, i, ids[y], radius, found)


def _compare(sets: list[frozenset], i: int, j: int, radius: float, found: dict) -> None:
    d = distance(sets[i], sets[j])
    if d <= radius + 1e-12:
        found[(i, j) if i < j else (j, i)] = d


def _arrays(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list column."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def classes(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal sets as one class: ``(cid, s1, s2, words)`` and the membership ``(cid, id)``; both final tables."""
    reps = stage(sets.select("s1", "s2", "words").dropDuplicates(["s1", "s2"]).withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = sets.select("id", "s1", "s2").distinct().join(reps.select("cid", "s1", "s2"), ["s1", "s2"]).select("cid", "id")
    return reps, stage(members, "members")


def sketches(flat: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The parity of each set's words by bit; the number of bits is a power of two and grows with the set."""
    sizes = np.diff(offsets)
    bits = SKETCH_BITS << np.maximum(np.ceil(np.log2(np.maximum(sizes * WORD_BITS, 1) / SKETCH_BITS)), 0).astype(np.int64)
    place, out = mix(flat, 31).astype(np.int64), []
    start = 0
    while start < len(sizes):
        width = int(bits[start])
        end = start + 1
        while end < len(sizes) and bits[end] == width and (end - start) * width < 1 << 22:
            end += 1
        inside = place[offsets[start] : offsets[end]] & (width - 1)
        owner = np.repeat(np.arange(end - start), sizes[start:end])
        odd = (np.bincount(owner * width + inside, minlength=(end - start) * width) & 1).astype(np.uint8)
        out.extend(row.tobytes() for row in np.packbits(odd.reshape(-1, width), axis=1, bitorder="little"))
        start = end
    return out


def folded(matrix: np.ndarray, width: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded until they have ``width`` words."""
    while matrix.shape[1] > width:
        half = matrix.shape[1] // 2
        matrix = matrix[:, :half] ^ matrix[:, half:]
    return matrix


def by_width(cids: np.ndarray, sizes: np.ndarray, drawn: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Classes by the number of 64-bit words of their sketch, in the order of their sizes: ``cids, sizes, sketches``."""
    order = np.lexsort((cids, sizes))
    widths = np.array([len(d) // 8 for d in drawn], dtype=np.int64)
    out = {}
    for width in np.unique(widths).tolist():
        own = order[widths[order] == width]
        out[width] = cids[own], sizes[own], np.frombuffer(b"".join(drawn[i] for i in own), dtype=np.uint64).reshape(len(own), width)
    return out


def close_pairs(left: dict, right: dict | None, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of classes (``by_width``) that sizes and sketches don't rule out, within ``left`` where ``right`` is None."""
    share, within = (1.0 - threshold) / (1.0 + threshold), right is None
    for wide, (a, a_sizes, a_all) in left.items():
        for other, (b, b_sizes, b_all) in (left if within else right).items():
            if within and other < wide:
                continue
            same, width = within and other == wide, min(wide, other)
            x, y = folded(a_all, width), folded(b_all, width)
            x_half, y_half = folded(x, width // 2), folded(y, width // 2).T.copy()
            kind = np.uint8 if width < 8 else np.uint32
            met, bits, total, passed = (np.zeros(ROWS * TILE, dtype=d) for d in (np.uint64, np.uint8, kind, bool))
            for top in range(0, len(a), ROWS):
                sizes = a_sizes[top : top + ROWS]
                low = max(int(np.searchsorted(b_sizes, sizes[0] * threshold - 1e-9)), top + 1 if same else 0)
                high = int(np.searchsorted(b_sizes, sizes[-1] / threshold + 1e-9, "right"))
                most = np.minimum((b_sizes[low:high] + sizes[-1]) * share + 1e-9, np.iinfo(kind).max).astype(kind)
                for start in range(low, high, TILE):
                    shape = len(sizes), min(TILE, high - start)
                    n = shape[0] * shape[1]
                    m, c, t, ok = (v[:n].reshape(shape) for v in (met, bits, total, passed))
                    for k in range(width // 2):
                        np.bitwise_xor(x_half[top : top + ROWS, k, None], y_half[k, start : start + TILE][: shape[1]], out=m)
                        np.bitwise_count(m, out=c)
                        np.add(t, c, out=t) if k else np.copyto(t, c)
                    np.less_equal(t, most[start - low : start - low + TILE], out=ok)
                    passed[n : -(-n // 8) * 8] = False
                    some = np.flatnonzero(passed[: -(-n // 8) * 8].view(np.uint64))  # most pairs are ruled out: eight at a time are passed over
                    if not len(some):
                        continue
                    hits = (8 * some[:, None] + np.arange(8)).ravel()
                    i, j = np.divmod(hits[passed[hits]], shape[1])
                    i, j = i + top, j + start
                    differ = np.bitwise_count(x[i] ^ y[j]).sum(axis=1, dtype=np.int64)
                    open_ = (differ <= (a_sizes[i] + b_sizes[j]) * share + 1e-9) & (i < j if same else True)
                    if open_.any():
                        i, j = a[i[open_]], b[j[open_]]
                        yield np.minimum(i, j), np.maximum(i, j)


def cells(reps: DataFrame, radius: float, count: int) -> DataFrame:
    """``cid, size, sketch`` of each class with the Voronoi ``cell`` of its nearest pivot and the ``cells`` in its window; a final table."""
    drawn = [frozenset(r[0]) for r in reps.select("words", F.xxhash64("cid").alias("h"), "cid").orderBy("h", "cid").limit(count).select("words").collect()]
    held = np.unique(np.fromiter((w for d in drawn for w in d), dtype=np.int64))
    inside = np.array([[w in d for d in drawn] for w in held.tolist()], dtype=np.int32).reshape(len(held), len(drawn))
    shared = reps.sparkSession.sparkContext.broadcast((held, np.vstack([inside, np.zeros((1, len(drawn)), dtype=np.int32)]), np.array([len(d) for d in drawn])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, inside, lengths = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, offsets = _arrays(batch.column(1))
            sizes = np.diff(offsets)
            at = np.minimum(np.searchsorted(held, flat), max(len(held) - 1, 0))
            found = np.flatnonzero(held[at] == flat) if len(held) else np.empty(0, dtype=np.int64)
            owner = np.repeat(np.arange(len(sizes)), sizes)[found]
            common = np.stack([np.bincount(owner, inside[at[found], p], minlength=len(sizes)) for p in range(len(lengths))], axis=1)
            union = sizes[:, None] + lengths[None, :] - common
            away = 1.0 - np.divide(common, union, out=np.ones(union.shape), where=union > 0)
            open_ = away <= away.min(axis=1)[:, None] + 2 * radius + 1e-9
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], open_.sum(axis=1).cumsum()]).astype(np.int32)), pa.array(np.nonzero(open_)[1].astype(np.int32)))
            arrays = [batch.column(0), pa.array(sizes.astype(np.int32)), pa.array(sketches(flat, offsets), pa.binary()), pa.array(away.argmin(axis=1).astype(np.int32)), lists]
            yield pa.RecordBatch.from_arrays(arrays, names=["cid", "size", "sketch", "cell", "cells"])

    return stage(reps.select("cid", "words").mapInArrow(run, "cid bigint, size int, sketch binary, cell int, cells array<int>"), "cells")


def join_within(reps: DataFrame, threshold: float, blocks: int = 1) -> DataFrame:
    """All pairs of classes with a Jaccard similarity of at least ``threshold``: ``(a, b, similarity)``, a < b; a final table.

    The classes are cut into ``blocks`` blocks or more, as many as their number needs; the pairs don't depend on it.
    """
    total = reps.count()
    rows = BLOCK * math.ceil(math.sqrt(total) / BLOCK_ROOT) if total else BLOCK
    rows = max(1, min(rows, math.ceil(total / blocks)))
    placed = cells(reps, 1.0 - threshold, min(PIVOTS, max(1, math.ceil(total / rows))))
    counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    parts = [math.ceil(counts.get(c, 0) / rows) for c in range(max(counts, default=0) + 1)]
    firsts = np.concatenate([[0], np.cumsum(parts)]).tolist()
    units = max(firsts[-1], 1)
    first, many = F.array(*(F.lit(int(x)) for x in firsts[:-1])), F.array(*(F.lit(int(x)) for x in parts))
    own = F.get(first, F.col("cell")) + F.pmod(F.xxhash64("cid"), F.get(many, F.col("cell"))).cast("int")
    reached = F.filter(F.flatten(F.transform("cells", lambda c: F.transform(F.sequence(F.lit(0), F.get(many, c)), lambda k: F.when(k < F.get(many, c), F.get(first, c) + k)))), lambda u: u.isNotNull())
    spread = placed.withColumn("unit", own).select("cid", "size", "sketch", "unit", F.explode(reached).alias("other"))
    low, high = F.least("unit", "other"), F.greatest("unit", "other")
    spread = spread.select("cid", "size", "sketch", "unit", (F.col("unit") == F.col("other")).alias("within"), (low * units - F.floor(low * (low - 1) / 2).cast("int") + high - low).alias("task"))
    tasks = units * (units + 1) // 2
    met = spread.repartitionById(tasks, F.col("task")).sortWithinPartitions("task", "unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        within = False
        for batch in batches:
            within = within or bool(batch.column("within")[0].as_py()) if batch.num_rows else within
            unit = batch.column("unit").to_numpy()
            for u in np.unique(unit).tolist():
                own = np.flatnonzero(unit == u)
                taken = batch.take(pa.array(own))
                held.setdefault(u, []).append((taken.column("cid").to_numpy(), taken.column("size").to_numpy(), taken.column("sketch").to_pylist()))
        sides = [by_width(np.concatenate([h[0] for h in held[u]]), np.concatenate([h[1] for h in held[u]]).astype(np.int64), [d for h in held[u] for d in h[2]]) for u in sorted(held)]
        rows, count = [], 0
        for pair in _between(sides, within):
            rows.append(pair)
            count += len(pair[0])
            if count > 50_000:
                yield _batch(rows)
                rows, count = [], 0
        if rows:
            yield _batch(rows)

    def _between(sides: list[dict], within: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(sides) == 2:
            yield from close_pairs(sides[0], sides[1], threshold)
        elif within and sides:
            yield from close_pairs(sides[0], None, threshold)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([r[k] for r in rows])) for k in (0, 1)], names=["a", "b"])

    open_ = stage(met.mapInArrow(run, "a bigint, b bigint"), "open")
    sets = reps.select("cid", "words")
    both = open_.join(sets.select(F.col("cid").alias("a"), F.col("words").alias("x")), "a").join(sets.select(F.col("cid").alias("b"), F.col("words").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    rated = both.select("a", "b", (common / (F.size("x") + F.size("y") - common)).alias("similarity"))
    links = stage(rated.filter(F.col("similarity") >= threshold - 1e-12), "links")
    for done in (open_, placed):
        drop_stage(done)
    return links


def expand(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of records ``(id_a, id_b)``, id_a < id_b: linked classes and equal sets."""
    left, right = members.select(F.col("cid").alias("a"), F.col("id").alias("x")), members.select(F.col("cid").alias("b"), F.col("id").alias("y"))
    across = pairs.select("a", "b").join(left, "a").join(right, "b").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    copies = left.join(right.withColumnRenamed("b", "a"), "a").filter("x < y").select(F.col("x").alias("id_a"), F.col("y").alias("id_b"))
    return across.unionByName(copies)


def groups(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """One row per record: ``id, group_key`` (smallest id linked directly or through others) and ``links``.

    ``links`` counts the other records within the threshold, copies included; copies are never paired.
    """
    sizes = members.groupBy("cid").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    ends = F.array(F.struct(F.col("a").alias("cid"), F.col("b").alias("other")), F.struct(F.col("b").alias("cid"), F.col("a").alias("other")))
    linked = pairs.select(F.inline(ends)).join(sizes.select(F.col("cid").alias("other"), "copies"), "other").groupBy("cid").agg(F.sum("copies").alias("outside"))
    roots = boruvka_components(pairs, "a", "b").withColumnRenamed("node", "cid")
    known = sizes.join(roots, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    keys = known.groupBy("component").agg(F.min("least").alias("group_key"))
    whole = known.join(keys, "component").join(linked, "cid", "left").select("cid", "group_key", (F.coalesce("outside", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return members.join(whole, "cid").select("id", "group_key", "links")
