"""Problem 7: evaluation passages that stand in corpus texts, by greedy string tiling."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.functions.words import codes

#: Passages are sent to the tasks in blocks of at most so many words; more passages, more passes.
BLOCK_WORDS = 4_000_000
#: Pairs of equal windows that a task holds at once.
PIECE = 1_000_000
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Running Karp-Rabin hashes (modulo 2^64) of all windows of ``width`` values, in one sweep."""
    n = len(values)
    if n < width:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        powers = np.full(n, _BASE, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        inverse = np.full(n, _INVERSE, dtype=np.uint64)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.add.accumulate(values.astype(np.uint64) * inverse)])
        return (sums[width:] - sums[: n - width + 1]) * powers[: n - width + 1]


def tile(text_words: int, passage_words: int, runs: list[tuple[int, int, int]], width: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from the maximal matches ``(length, place in text, place in passage)``: the tiles, in the same form.

    The longest match without marked words is marked again and again (of equal ones the first in the text); a match with marked words goes back
    with its longest unmarked parts, as long as these have ``width`` words.
    """
    heap = [(-length, a, b) for length, a, b in runs]
    heapq.heapify(heap)
    in_text, in_passage, tiles = np.zeros(text_words, bool), np.zeros(passage_words, bool), []
    while heap:
        length, a, b = heapq.heappop(heap)
        length = -length
        taken = in_text[a : a + length] | in_passage[b : b + length]
        if taken.any():
            edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
            for low, high in zip(edges[::2], edges[1::2]):
                if high - low >= width:
                    heapq.heappush(heap, (-int(high - low), a + int(low), b + int(low)))
            continue
        in_text[a : a + length] = in_passage[b : b + length] = True
        tiles.append((length, a, b))
    return tiles


def diagonals(rows: np.ndarray) -> np.ndarray:
    """Rows ``(text, item, diagonal, place in text, starts)`` sorted, and those that continue one another on a diagonal joined."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    apart = (rows[1:, :3] != rows[:-1, :3]).any(axis=1) | (rows[1:, 3] != rows[:-1, 3] + rows[:-1, 4])
    new = np.flatnonzero(np.concatenate([[True], apart]))
    joined = rows[new]
    joined[:, 4] = np.add.reduceat(rows[:, 4], new)
    return joined


class Passages:
    """The seeds of a block of passages: sorted window hashes and where they stand."""

    def __init__(self, items: list[tuple[int, np.ndarray]], width: int) -> None:
        self.items = [(key, value) for key, value in items if len(value)]
        self.flat = np.concatenate([v for _, v in self.items]) if self.items else np.empty(0, dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum([len(v) for _, v in self.items])]).astype(np.int64)
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in {min(width, len(value)) for _, value in self.items}:
            own = [(i, rolling(v, size)) for i, (_, v) in enumerate(self.items) if min(width, len(v)) == size]
            hashes = np.concatenate([h for _, h in own])
            which = np.concatenate([np.full(len(h), i) for i, h in own])
            places = np.concatenate([np.arange(len(h)) for _, h in own])
            order = np.argsort(hashes, kind="stable")
            self.seeds[size] = (hashes[order], which[order], places[order])

    def leaks(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """``(text, item, tiles)`` of every text of a batch that shares a seed with an item."""
        if not texts:
            return
        flat = np.concatenate(texts)
        start = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        for size, (hashes, which, places) in self.seeds.items():
            found = rolling(flat, size)
            low = np.searchsorted(hashes, found, "left")
            hit = np.flatnonzero((low < len(hashes)) & (hashes[np.minimum(low, len(hashes) - 1)] == found))
            text = np.searchsorted(start, hit, "right") - 1
            inside = hit + size <= start[text + 1]
            hit, text = hit[inside], text[inside]
            low, high = low[hit], np.searchsorted(hashes, found[hit], "right")
            ends = np.cumsum(high - low)
            runs, a = [], 0
            while a < len(hit):  # texts of few words over and over have seeds beyond number: they are joined piece by piece
                b = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PIECE, "right")), a + 1)
                times = high[a:b] - low[a:b]
                at = np.repeat(low[a:b] - (np.cumsum(times) - times), times) + np.arange(times.sum())
                place, own = np.repeat(hit[a:b], times), np.repeat(text[a:b], times)
                same = np.ones(len(at), dtype=bool)
                for k in range(size):
                    same &= flat[place + k] == self.flat[self.start[which[at]] + places[at] + k]
                place, own, at = place[same], own[same], at[same]
                local = place - start[own]
                runs.append(diagonals(np.column_stack([own, which[at], local - places[at], local, np.ones(len(at), dtype=np.int64)])))
                a = b
            whole = diagonals(np.concatenate(runs)) if runs else np.empty((0, 5), dtype=np.int64)
            pairs = np.flatnonzero(np.concatenate([[True], (whole[1:, :2] != whole[:-1, :2]).any(axis=1)])) if len(whole) else []
            for a, b in zip(pairs, [*pairs[1:], len(whole)]):
                t, item = int(whole[a, 0]), int(whole[a, 1])
                own = [(int(n) + size - 1, int(x), int(x - d)) for _, _, d, x, n in whole[a:b]]
                yield t, item, tile(len(texts[t]), len(self.items[item][1]), own, size)


def leaked_passages(
    documents: DataFrame, key: str, text: str, items: DataFrame, item_key: str, passage: str, width: int = 6, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Documents that share tiles of at least ``width`` words with a passage.

    One row per pair: ``key, item_key, longest, covered, passage_words, coverage, tiles``; ``longest`` is the longest common run of
    words, ``covered`` the passage's words under tiles (so reordered passages count whole), ``coverage`` their share.
    A passage shorter than ``width`` matches as a whole only.  Null and empty texts and passages match
    nothing; equal rows give equal results.  The passages are the query side: they are read in blocks of at most
    ``block_words`` words (a longer single passage is a block of its own), each sent to every task and
    held against all documents, so what is sent is bounded; the corpus is never shuffled.  Keys must be integers.
    """
    spark = documents.sparkSession
    parts, block, size = [], [], 0
    for row in items.select(item_key, passage).dropna().distinct().orderBy(item_key, passage).toLocalIterator():
        value = codes(row[1])
        if block and size + len(value) > block_words:
            parts.append(_scan(documents, key, text, Passages(block, width), item_key))
            block, size = [], 0
        block.append((row[0], value))
        size += len(value)
    parts.append(_scan(documents, key, text, Passages(block, width), item_key))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _scan(documents: DataFrame, key: str, text: str, passages: Passages, item_key: str) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(passages)
    names = [key, item_key, "longest", "covered", "passage_words", "coverage", "tiles"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            docs = batch.column(0).to_pylist()
            rows = []
            for t, item, tiles in own.leaks([codes(body.as_py()) for body in batch.column(1)]):
                name, value = own.items[item]
                covered = sum(x[0] for x in tiles)
                rows.append((docs[t], name, max(x[0] for x in tiles), covered, len(value), covered / len(value), len(tiles)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    ddl = f"`{key}` bigint, `{item_key}` bigint, longest int, covered int, passage_words int, coverage double, tiles int"
    return documents.select(F.col(key), F.col(text)).mapInArrow(run, ddl)
