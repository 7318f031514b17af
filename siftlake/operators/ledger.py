"""Append-only ledgers: idempotent appends, hash chains, audits and the review state machine."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftlake.functions import normalise as N
from siftlake.session import stage

#: The legal transitions by actor; an empty state stands for "not yet known".
EDGES = {
    "deterministic": (("", "discovered"), ("discovered", "triaged"), ("triaged", "proposed_include"), ("triaged", "proposed_exclude"), ("triaged", "awaiting_review")),
    "human": (
        ("proposed_include", "included"), ("proposed_include", "excluded"), ("proposed_exclude", "included"), ("proposed_exclude", "excluded"),
        ("awaiting_review", "included"), ("awaiting_review", "excluded"), ("fulltext_obtained", "appraised"),
    ),
    "system": (("included", "fulltext_planned"), ("fulltext_planned", "fulltext_obtained"), ("fulltext_planned", "fulltext_unavailable")),
}
RECORD_CAP = 20


def acquisition_rows(responses: DataFrame) -> DataFrame:
    """Captured responses ``(provider, endpoint, request_json, response_json, observed_at)`` as ledger rows.

    Requests with credential-like keys are refused; ids are content addresses, so a repeated response has the same id.
    """
    safe = responses.withColumn("request_json", F.when(N.has_secret(F.col("request_json")), F.raise_error(F.lit("the request holds a credential"))).otherwise(N.canonical_json(F.col("request_json"))))
    hashed = safe.withColumn("response_json", N.canonical_json(F.col("response_json"))).withColumns(
        {"request_sha256": F.sha2("request_json", 256), "response_sha256": F.sha2("response_json", 256)}
    )
    own = F.to_json(F.struct("endpoint", "provider", "request_sha256", "response_sha256"))
    return hashed.withColumn("id", F.sha2(own, 256))


def record_rows(acquisitions: DataFrame) -> DataFrame:
    """The items of acquisitions as source records, ranked from 1 in their response; untitled items are refused upstream."""
    body = F.coalesce(F.get_json_object("response_json", "$.papers"), F.get_json_object("response_json", "$.trials"))
    kind = F.when(F.get_json_object("response_json", "$.papers").isNotNull(), "paper").otherwise("trial")
    items = acquisitions.select(F.col("id").alias("acquisition_id"), kind.alias("kind"), F.col("observed_at").alias("retrieved_at"), F.posexplode(F.from_json(body, "array<string>")).alias("pos", "raw_json"))
    raw = items.withColumn("raw_json", N.canonical_json(F.col("raw_json"))).withColumn("rank", F.col("pos") + 1).withColumn("raw_sha256", F.sha2("raw_json", 256))
    get = lambda f: F.get_json_object("raw_json", f"$.{f}")
    own = F.to_json(F.struct("acquisition_id", "rank", "raw_sha256"))
    flat = raw.withColumns({"title": get("title"), "year": get("year").cast("int"), "doi": get("doi"), "pmid": get("pmid"), "nct_id": get("nctId"), "id": F.sha2(own, 256)})
    identity = N.source_identity(F.col("kind"), F.col("title"), F.col("year"), F.col("doi"), F.col("pmid"), F.col("nct_id"))
    return flat.withColumn("identity_key", identity).drop("pos")


def append_new(existing: DataFrame, batch: DataFrame, key: str = "id") -> DataFrame:
    """Rows of a batch that a ledger doesn't hold yet, each id once (exactly-once append)."""
    return batch.dropDuplicates([key]).join(existing.select(key), key, "left_anti")


def conflicting(existing: DataFrame, batch: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows of a batch that contradict a recorded immutable decision."""
    return batch.join(existing.select(*keys, F.col(value).alias("_recorded")), keys).filter(~F.col(value).eqNullSafe(F.col("_recorded")))


def lookup(rows: DataFrame, key: str, value: object) -> DataFrame:
    """The row of one key; rows delivered twice count once, an unknown or null key has none."""
    return rows.filter(F.col(key) == F.lit(value)).dropDuplicates([key])


def append_referenced(existing: DataFrame, batch: DataFrame, referred: DataFrame, key: str, target: str, own: str = "id") -> tuple[DataFrame, DataFrame]:
    """The rows of a batch to append, and those refused as what they refer to doesn't exist.

    Rows already held are neither (a repeated append changes nothing); a null reference is refused.
    """
    known = referred.select(F.col(target).alias(key)).distinct()
    return append_new(existing, batch.join(known, key, "left_semi"), own), batch.join(known, key, "left_anti")


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """``rows`` with ``sequence``, their place from 1 in the order of a column of distinct values.

    Places within range partitions plus the counts of the partitions before; no task holds more than its partition.
    """
    ranged = stage(rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("_p", F.spark_partition_id()), "ranged")
    before = ranged.groupBy("_p").count().withColumn("_before", F.coalesce(F.sum("count").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    placed = ranged.withColumn("_r", F.row_number().over(W.partitionBy("_p").orderBy(order)))
    return placed.join(F.broadcast(before.select("_p", "_before")), "_p").withColumn("sequence", (F.col("_before") + F.col("_r")).cast("bigint")).drop("_p", "_r", "_before")


def verbatim_spans(proposals: DataFrame, sources: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    """``proposals`` (``key, spans`` of ``field, exact_text``) with ``verbatim``: there are spans, and each stands letter for letter in its field of the source.

    A span of another field, an empty one, and a source that doesn't exist or has a null field aren't verbatim.
    """
    texts = sources.select(key, *(F.col(f).alias(f"_{f}") for f in fields)).dropDuplicates([key])
    place = F.create_map(*(x for f in fields for x in (F.lit(f), F.col(f"_{f}"))))
    stands = F.forall("spans", lambda s: F.coalesce((s["exact_text"] != "") & F.contains(F.try_element_at(place, s["field"]), s["exact_text"]), F.lit(False)))
    joined = proposals.join(texts, key, "left").withColumn("verbatim", F.coalesce((F.size("spans") > 0) & stands, F.lit(False)))
    return joined.drop(*(f"_{f}" for f in fields))


def payload_holds(payload: Column, recorded: Column, own: str, derived: tuple[str, ...]) -> Column:
    """Whether a JSON object has the recorded hash, left out its own hash field and any choice of the fields that were derived later."""

    @F.pandas_udf("array<string>")
    def forms(texts: pd.Series) -> pd.Series:
        def hashes(text: str | None) -> list[str]:
            try:
                body = json.loads(text) if text is not None else None
            except (ValueError, RecursionError):
                body = None
            if not isinstance(body, dict):
                return []
            body.pop(own, None)
            found = []
            for choice in range(1 << len(derived)):
                kept = {k: v for k, v in body.items() if not any(choice >> i & 1 and k == name for i, name in enumerate(derived))}
                found.append(hashlib.sha256(json.dumps(kept, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest())
            return found

        return texts.map(hashes)

    return F.coalesce(F.array_contains(forms(payload), recorded), F.lit(False))


def audit_rows(checks: dict[str, tuple[DataFrame, Column, Column]]) -> DataFrame:
    """One row per check of a ledger: ``check, rows, failures, first_failure``; each check is ``(table, key, condition)``, a null condition fails.

    Counts and the smallest failing key combine before the shuffle; a table without rows passes.
    """
    every = None
    for name, (rows, key, holds) in sorted(checks.items()):
        bad = ~F.coalesce(holds, F.lit(False))
        part = rows.agg(F.lit(name).alias("check"), F.count("*").alias("rows"), F.count_if(bad).alias("failures"), F.min(F.when(bad, key.cast("string"))).alias("first_failure"))
        every = part if every is None else every.unionByName(part)
    return every


def missing_references(rows: DataFrame, referred: DataFrame, key: str, target: str) -> DataFrame:
    """Foreign keys without a target, each once."""
    return rows.select(key).filter(F.col(key).isNotNull()).distinct().join(referred.select(F.col(target).alias(key)), key, "left_anti")


def budget(ledgers: Iterable[DataFrame], cap: int) -> DataFrame:
    """Rows and distinct identities over the union of ledgers, what is left of the cap, and whether it is broken."""
    every = None
    for ledger in ledgers:
        part = ledger.select("identity_key")
        every = part if every is None else every.unionByName(part)
    found = every.agg(F.count("*").alias("records"), F.count_distinct("identity_key").alias("identities"))
    most = F.greatest("records", "identities")
    return found.withColumn("remaining", F.greatest(F.lit(0).cast("bigint"), F.lit(cap) - most)).withColumn("over_cap", most > cap)


def fair_share(asked: Column, cap: Column) -> Column:
    """Running quotas of a list of requests: each may take its part of what is left among those still to come, rounded up."""
    start = F.struct(cap.cast("bigint").alias("left"), F.size(asked).cast("bigint").alias("pending"), F.array().cast("array<bigint>").alias("given"))

    def step(state: Column, want: Column) -> Column:
        give = F.least(want.cast("bigint"), F.ceil(state["left"] / state["pending"]).cast("bigint"))
        return F.struct((state["left"] - give).alias("left"), (state["pending"] - 1).alias("pending"), F.concat(state["given"], F.array(give)).alias("given"))

    return F.aggregate(asked, start, step, lambda s: s["given"])


def chain(payload_hashes: list[tuple[str, str, str]], head: str | None = None) -> list[dict]:
    """Chained ledger entries for a new batch of ``(kind, recorded_at, payload_sha256)``; the chain is serial by nature."""
    entries, previous = [], head
    for kind, recorded_at, payload in payload_hashes:
        own = {"kind": kind, "payload_sha256": payload, "previous_entry_sha256": previous, "recorded_at": recorded_at}
        digest = hashlib.sha256(json.dumps(own, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
        entries.append(own | {"entry_sha256": digest})
        previous = digest
    return entries


def chain_breaks(entries: DataFrame, sequence: str, entry: str, previous: str) -> DataFrame:
    """Entries whose recorded predecessor isn't the entry before: a join of each sequence number with the next.

    Sequence numbers are consecutive by construction, so no global sort is needed; a gap shows as a break.
    """
    before = entries.select((F.col(sequence) + 1).alias(sequence), F.col(entry).alias("_before"))
    first = entries.agg(F.min(sequence)).first()[0]
    return entries.join(before, sequence, "left").filter((F.col(sequence) > F.lit(first)) & ~F.col("_before").eqNullSafe(F.col(previous))).drop("_before")


def current_states(events: DataFrame, keys: list[str], state: str, sequence: str) -> DataFrame:
    """Latest state of each key, combined before the shuffle."""
    return events.groupBy(*keys).agg(F.max_by(state, sequence).alias("current_state"))


def state_breaks(events: DataFrame, keys: list[str], before: str, after: str, sequence: str) -> DataFrame:
    """Events whose from-state isn't the to-state of the key's event before."""
    last = F.lag(after).over(W.partitionBy(*keys).orderBy(sequence))
    return events.withColumn("_last", last).filter(~F.col("_last").eqNullSafe(F.col(before))).drop("_last")


def is_legal(before: Column, after: Column, actor: Column) -> Column:
    """Whether an actor may make a transition."""
    legal = F.lit(False)
    for name, edges in EDGES.items():
        for a, b in edges:
            legal = legal | ((actor == name) & (F.coalesce(before, F.lit("")) == a) & (after == b))
    return F.coalesce(legal, F.lit(False))


def acquisition_audit(acquisitions: DataFrame, records: DataFrame) -> DataFrame:
    """One row per acquisition: rows delivered, whether its hashes hold, and whether its count of sources is that of its records."""
    unique = records.select("acquisition_id", "rank").distinct().groupBy("acquisition_id").agg(F.count("*").alias("found"))
    kept = acquisitions.groupBy("id").agg(
        F.count("*").alias("deliveries"), F.first("source_count").alias("source_count"),
        F.bool_and(F.sha2("request_json", 256) == F.col("request_sha256")).alias("request_ok"), F.bool_and(F.sha2("response_json", 256) == F.col("response_sha256")).alias("response_ok"),
    )
    joined = kept.join(unique.withColumnRenamed("acquisition_id", "id"), "id", "left").withColumn("found", F.coalesce("found", F.lit(0).cast("bigint")))
    return joined.withColumn("count_ok", F.col("found") == F.col("source_count"))


def latest(rows: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """The latest row per key by a total order, without a window: the largest struct wins."""
    packed = F.struct(*(o.alias(f"_o{i}") for i, o in enumerate(order)), *columns)
    return rows.groupBy(*keys).agg(F.max(packed).alias("_r")).select(*keys, *(F.col(f"_r.{c}") for c in columns))
