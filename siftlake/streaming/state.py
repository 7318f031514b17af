"""Structured Streaming: keyed review states, exactly-once appends and event windows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from siftlake.operators.ledger import EDGES
from siftlake.session import shared_dir

LEGAL = {(actor, a, b) for actor, edges in EDGES.items() for a, b in edges}
OUTPUT = "group_id bigint, event_id bigint, from_state string, to_state string, outcome string"
STATE = "current string, last_event bigint"


def _run(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there into a table of the shared folder, and read that."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{base}/rows").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
    writer.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The event files as a stream."""
    schema = spark.read.parquet(path).schema
    folder, _, file = path.rstrip("/").rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", file).option("recursiveFileLookup", "false").parquet(folder)


def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One group's events in order of their ids: an event up to the last one seen is a replay, an illegal transition is rejected.

    ``accepted`` events move the group's state; the others leave it.
    """
    current, last = state.get if state.exists else ("", -1)
    events = pd.concat(list(batches)).sort_values("event_id", kind="stable")
    rows: list[tuple[Any, ...]] = []
    for event_id, to_state, actor in zip(events["event_id"], events["to_state"], events["actor_kind"]):
        if event_id <= last:
            rows.append((key[0], event_id, current, to_state, "replayed"))
        elif (actor, current, to_state) in LEGAL:
            rows.append((key[0], event_id, current, to_state, "accepted"))
            current, last = to_state, int(event_id)
        else:
            rows.append((key[0], event_id, current, to_state, "rejected"))
    state.update((current, last))
    yield pd.DataFrame(rows, columns=["group_id", "event_id", "from_state", "to_state", "outcome"])


def state_machine(events: DataFrame) -> DataFrame:
    """A stream of ``group_id, event_id, to_state, actor_kind`` through the review state machine."""
    return events.groupBy("group_id").applyInPandasWithState(advance, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)


def run_state_machine(spark: SparkSession, path: str) -> DataFrame:
    from siftlake.plans.ledger_queries import review_events

    return _run(state_machine(review_events(read_events(spark, path)).select("group_id", "event_id", "to_state", "actor_kind")), "states")


def append_once(spark: SparkSession, path: str, deliveries: int = 2) -> DataFrame:
    """The same events delivered several times, each delivery to a run of its own that continues from the checkpoint of the one before.

    What a run has seen is in its state, so a later run takes no id again; ids are told apart within the watermark.
    """
    base = f"{shared_dir(spark)}/appended-{uuid.uuid4().hex}"
    events = spark.read.parquet(path).withColumn("ts", F.col("ts").cast(T.TimestampType()))
    for _ in range(deliveries):
        events.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        writer = stream.withWatermark("ts", "60 days").dropDuplicatesWithinWatermark(["event_id"]).writeStream.format("parquet").outputMode("append")
        writer.option("path", f"{base}/rows").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{base}/rows")


def hourly_counts(spark: SparkSession, path: str, late: str = "60 days") -> DataFrame:
    """Events and values by hour and type: a stream whose state keeps a window until the watermark has passed it.

    Each batch appends the windows it changed under its number, so nothing is rewritten; of a window the latest batch counts.  Events later than ``late`` behind
    the latest one are dropped.
    """
    timed = read_events(spark, path).withColumn("ts", F.col("ts").cast(T.TimestampType())).withWatermark("ts", late)
    counted = timed.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total"))
    rows = counted.select(F.col("w.start").cast(T.TimestampNTZType()).alias("window_start"), "event_type", "events", "total")
    base = f"{shared_dir(spark)}/windows-{uuid.uuid4().hex}"
    # A batch that is run again after a failure writes the same folder again.
    query = rows.writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
    query.foreachBatch(lambda batch, number: batch.withColumn("number", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{base}/rows/batch={number}")).start().awaitTermination()
    found = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("number", T.LongType())])).parquet(f"{base}/rows")
    last = F.max(F.struct("number", "events", "total")).alias("r")
    return found.groupBy("window_start", "event_type").agg(last).select("window_start", "event_type", "r.events", "r.total")
