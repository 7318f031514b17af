"""Queries of problem 2: what each acquisition repeats of earlier ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.functions.identifiers import identity_form
from siftlake.functions.words import codes
from siftlake.llm import jaccard
from siftlake.llm.p1 import THRESHOLD, content
from siftlake.llm.suffixes import BUCKET_ROWS, History, exact_key, parities, suffix_keys
from siftlake.session import drop_stage, stage, table

#: Batches in which p2_found replays the ledger; the rows don't depend on it.
EPOCHS = 4
#: Suffixes that winnowing leaves of a text, about, for the number of buckets.
SUFFIXES = 48
TEXT = "s1 bigint, s2 bigint, size int, p0 bigint, p1 bigint, p2 bigint, p3 bigint, words array<bigint>, keys array<bigint>, masks array<bigint>"


def described(records: DataFrame, beside: tuple[str, ...]) -> DataFrame:
    """``records`` (``id, title, raw_json`` and the columns ``beside``) with the description of their texts in place of title and JSON.

    ``s1, s2`` sign the set of words, ``size, p0 ... p3`` are its size and parity bits, ``words`` the set, ``keys, masks`` the suffixes of the text.  All are null
    for a record without an abstract.
    """
    kinds = (pa.int64(), pa.int64(), pa.int32(), *(pa.int64(),) * 4, *(pa.list_(pa.int64()),) * 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, title, raw in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                body = content(title.as_py(), raw.as_py()) if key is not None else None
                if body is None:
                    rows.append((None,) * len(kinds))
                    continue
                words = codes(body, entities=True)
                own = np.unique(words)
                s1, s2 = jaccard.set_signatures(own, np.array([0, len(own)]))
                rows.append((int(s1[0]), int(s2[0]), len(own), *parities(own).tolist(), own, *suffix_keys(words)))
            arrays = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[3:], *arrays], names=["id", *beside, *(c.split()[0] for c in TEXT.split(", "))])

    ddl = ", ".join(["id string", *(f"{c} {records.schema[c].dataType.simpleString()}" for c in beside), TEXT])
    return records.select("id", "title", "raw_json", *beside).mapInArrow(run, ddl)


def instant(column: str) -> Column:
    """ISO-8601 text as an instant; text that is none becomes null."""
    return F.try_to_timestamp(F.col(column))


def ledger(spark: SparkSession, folder: str, epochs: int) -> DataFrame:
    """Records with the instant of their acquisition, the keys of identity and response, their texts and the batch they come in, staged by batch.

    Acquisitions without records have a row without ``id``; records without a readable instant have no batch.
    """
    batches = table(spark, folder, "acquisitions").select(
        F.col("id").alias("acquisition_id"), exact_key("response", F.col("response_sha256")).alias("response"), F.unix_micros(instant("observed_at")).alias("at")
    ).dropDuplicates(["acquisition_id"])
    cuts = batches.approxQuantile("at", [i / epochs for i in range(1, epochs)], 0.01) if epochs > 1 else []
    batch = sum((F.when(F.col("at") > F.lit(int(c)), 1).otherwise(0) for c in cuts), F.lit(0))
    shared = table(spark, folder, "shared_identifiers").select(identity_form(F.col("identity_key")).alias("form"), F.lit(True).alias("is_shared")).distinct()
    form = identity_form(F.col("identity_key"))
    records = table(spark, folder, "source_records").select("id", "acquisition_id", form.alias("form"), "title", "raw_json").join(F.broadcast(shared), "form", "left")
    # A shared identifier may stand on a third of all rows: it never becomes a key.
    named = records.select("id", "acquisition_id", exact_key("identity", F.when(F.col("is_shared").isNull(), F.col("form"))).alias("identity"), "title", "raw_json")
    dated = batches.withColumn("batch", F.when(F.col("at").isNotNull(), batch).otherwise(-1)).join(named, "acquisition_id", "left")
    return stage(described(dated, ("batch", "at", "response", "identity")), "ledger", by="batch")


def repeated_records(spark: SparkSession, folder: str, epochs: int = EPOCHS) -> DataFrame:
    """Every record with the reasons for which it repeats something that an earlier acquisition brought.

    ``source_record_id, by_response, by_identity, by_content``: booleans.  Records without a readable
    ``observed_at`` repeat nothing and are repeated by nothing; records without an abstract never match by content; records of no
    listed acquisition have no row.  The ledger is accepted in ``epochs`` batches by time.
    """
    rows = ledger(spark, folder, epochs)
    texts = rows.filter("size is not null").select("size").count()
    history = History(spark, max(8, -(-texts * SUFFIXES // BUCKET_ROWS)), THRESHOLD)
    exact = ("response", "identity")
    found = [history.accept(rows.filter(F.col("batch") == e), exact) for e in range(epochs)]
    history.forget()
    late = [F.coalesce(F.col(f"first_{name}") < F.col("at"), F.lit(False)).alias(f"by_{name}") for name in (*exact, "content")]
    every = rows.filter("batch = -1 and id is not null").select("id", *(F.lit(False).alias(f"by_{name}") for name in (*exact, "content")))
    for part in found:
        every = every.unionByName(part.select("id", *late))
    done = stage(every.groupBy(F.col("id").alias("source_record_id")).agg(*(F.bool_or(f"by_{n}").alias(f"by_{n}") for n in (*exact, "content"))), "repeated")
    for part in (rows, *found):
        drop_stage(part)
    return done


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_records(spark, folder).filter("by_response or by_identity or by_content").select("source_record_id")


def p2_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Every record with the reasons for which it counts as a repetition, if any."""
    return repeated_records(spark, folder)
