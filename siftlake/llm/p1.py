"""Queries of problem 1: near-duplicate source records by title and abstract."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siftlake.functions.words import codes
from siftlake.llm import jaccard
from siftlake.session import drop_stage, stage, table

#: The limit that TESTDATA.md sets for these pairs.
THRESHOLD = 0.7


def content(title: str | None, raw: str | None) -> str | None:
    """Title plus abstract, or None for a record without an abstract."""
    try:
        abstract = json.loads(raw).get("abstract") if raw else None
    except (ValueError, AttributeError, RecursionError):
        return None
    return f"{title or ''} {abstract}" if isinstance(abstract, str) and abstract.strip() else None


def record_sets(records: DataFrame) -> DataFrame:
    """``id, s1, s2, words``: the distinct words of each record that has an abstract."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets = [], []
            for key, title, raw in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                body = content(title.as_py(), raw.as_py())
                if body is not None and key is not None:
                    ids.append(key)
                    sets.append(np.unique(codes(body, entities=True)))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
            flat = np.concatenate(sets) if sets else np.empty(0, dtype=np.int64)
            s1, s2 = jaccard.set_signatures(flat, offsets)
            words = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(s1), pa.array(s2), words], names=["id", "s1", "s2", "words"])

    return records.select("id", "title", "raw_json").mapInArrow(run, "id string, s1 bigint, s2 bigint, words array<bigint>")


def near_duplicates(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Linked classes ``(a, b, similarity)`` and their members ``(cid, id)``, both staged."""
    sets = stage(record_sets(table(spark, folder, "source_records")), "sets")
    reps, members = jaccard.classes(sets)
    drop_stage(sets)
    links = jaccard.join_within(reps, THRESHOLD)
    drop_stage(reps)
    return links, members


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of records with at least the threshold of their words in common."""
    return jaccard.expand(*near_duplicates(spark, folder))


def p1_groups(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record with an abstract: its near-duplicate group and its number of links."""
    return jaccard.groups(*near_duplicates(spark, folder)).withColumnRenamed("id", "source_record_id")
