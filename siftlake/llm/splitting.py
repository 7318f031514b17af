"""Problem 9: cutting oversized texts at their strongest boundaries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftlake.llm import tokens

#: Boundary strengths, weakest first: (strength, pattern; its matches' ends are the places to cut).
INSIDE_CHARACTER = -1
BOUNDARIES = (
    (1, re.compile(r"\s+")),
    (1, re.compile(r"(?=\s)(?<=\S)")),
    (2, re.compile(r"[;:,](?=\s)|[、，；：]")),
    (3, re.compile(r"[.!?…]+[\"')\]»”’]*(?=\s)|[。！？]+[」』）]*")),
    (4, re.compile(r"\r\n|\r|\n")),
    (5, re.compile(r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)\s*")),
)


def strengths(text: str, data: bytes, offsets: np.ndarray) -> np.ndarray:
    """How natural a cut is at each byte offset of ``offsets``."""
    n = len(data)
    if n == len(text):
        starts = None
        level = np.zeros(n + 1, dtype=np.int64)
    else:
        lead = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
        starts = np.append(np.flatnonzero(lead), n)
        level = np.full(n + 1, INSIDE_CHARACTER, dtype=np.int64)
        level[starts] = 0
    for strength, pattern in BOUNDARIES:
        at = np.fromiter((m.end() for m in pattern.finditer(text)), dtype=np.int64)
        if len(at):
            level[at if starts is None else starts[at]] = strength
    return level[offsets]


class RangeMaximum:
    """Sparse table over boundary strengths: the strongest place of any range in constant time.

    Of equally strong places the rightmost wins, so the keys are strength x length + place.
    """

    def __init__(self, values: np.ndarray) -> None:
        self.n = len(values)
        self.rows = [(values - INSIDE_CHARACTER) * self.n + np.arange(self.n)]
        width = 1
        while 2 * width <= self.n:
            last = self.rows[-1]
            self.rows.append(np.maximum(last[:-width], last[width:]))
            width *= 2

    def best(self, low: int, high: int) -> int:
        """The place of the maximum in ``low..high``, both included."""
        k = (high - low + 1).bit_length() - 1
        row = self.rows[k]
        return int(max(row[low], row[high - (1 << k) + 1]) % self.n)


def pieces(text: str, path: str, limit: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """Cut a text: ``(first token, end token, first byte, end byte)`` of each piece.

    A piece has at most ``limit`` tokens, counted in the text and again in the piece by itself.  It ends at
    the strongest boundary among its permissible lengths, which are those from half the limit (and
    beyond the overlap) to the limit; of equal ones at the rightmost.  The next piece starts
    ``overlap`` tokens before that, moved back to the start of a character.  A text within the limit is one piece.
    """
    if limit < 1 or not 0 <= overlap < limit:
        raise ValueError("0 <= overlap < limit is required")
    offsets = np.concatenate([[0], tokens.ends(text, path)])
    total = len(offsets) - 1
    if total <= limit:
        return [(0, total, 0, int(offsets[-1]))]
    data = text.encode()
    level = strengths(text, data, offsets)
    table = RangeMaximum(level)
    found, start = [], 0
    while True:
        if total - start <= limit and fits(data, offsets, start, total, path, limit):
            found.append((start, total, int(offsets[start]), int(offsets[total])))
            return found
        least = max(overlap + 1, limit // 2)
        room = min(limit, total - start)
        while True:
            low = min(start + least, start + room)
            end = table.best(low, start + room)
            if level[end] == INSIDE_CHARACTER:  # no character ends in the window
                end = table.best(start + 1, start + room)
                if level[end] == INSIDE_CHARACTER:
                    raise ValueError("the limit is below the tokens of one character")
            if fits(data, offsets, start, end, path, limit) or end == start + 1:
                break
            room = end - start - 1 if end - start - 1 >= 1 else 1
            least = min(least, max(1, room // 2))
        found.append((start, end, int(offsets[start]), int(offsets[end])))
        if end >= total:
            return found
        back = end - overlap
        while level[back] == INSIDE_CHARACTER and back > start + 1:
            back -= 1
        start = back if back > start else end


def fits(data: bytes, offsets: np.ndarray, start: int, end: int, path: str, limit: int) -> bool:
    """Whether the piece by itself has at most ``limit`` tokens (merges differ at cuts inside words)."""
    return end - start <= limit and tokens.count(data[offsets[start] : offsets[end]].decode("utf-8", "replace"), path) <= limit


COLUMNS = (
    ("id", pa.int64()),
    ("setting_id", pa.int32()),
    ("piece_no", pa.int32()),
    ("start_token", pa.int64()),
    ("end_token", pa.int64()),
    ("piece", pa.string()),
)


def split_documents(
    documents: DataFrame, key: str, text: str, settings: list[tuple[int, int, int]], vocabulary: str = tokens.DEFAULT_VOCABULARY, with_text: bool = True
) -> DataFrame:
    """The pieces of the texts that exceed a setting's limit: ``key, setting_id, piece_no, start_token, end_token, piece``.

    ``settings`` are ``(setting_id, max_tokens, overlap_tokens)``, a list of the caller.  Null and empty texts and texts within
    the limit give no rows; the start of a piece is inside the one before by ``overlap_tokens`` (more where a
    character would be cut).  A text with fewer bytes than the limit has no more tokens than that and
    isn't tokenized.  One pass over the documents, no shuffle; ``key`` must be an integer column.
    """
    path = tokens.vocabulary_path(vocabulary)
    least = min((s[1] for s in settings), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in COLUMNS]
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = body.as_py()
                if not body or 4 * len(body) <= least or len(body.encode("utf-8", "replace")) <= least:
                    continue
                body = body.encode("utf-8", "replace").decode()
                data = body.encode()
                for setting, limit, overlap in settings:
                    if len(data) <= limit:
                        continue
                    parts = pieces(body, path, limit, overlap)
                    if len(parts) < 2:
                        continue
                    for no, (first, end, a, b) in enumerate(parts, 1):
                        row = (doc, setting, no, first, end, data[a:b].decode() if with_text else None)
                        for column, value in zip(out, row):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(out, COLUMNS)], names=[key, *(n for n, _ in COLUMNS[1:])])

    ddl = f"`{key}` bigint, setting_id int, piece_no int, start_token bigint, end_token bigint, piece string"
    return documents.select(key, text).mapInArrow(run, ddl)
