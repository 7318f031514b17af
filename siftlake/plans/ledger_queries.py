"""Ledger, state, provenance and planning queries, each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.functions import normalise as N
from siftlake.operators import contracts, ledger, provenance
from siftlake.operators.nested import provider_key
from siftlake.plans import campaign
from siftlake.plans.screening_queries import ONTOLOGY, SPECIFICATION
from siftlake.session import table
from siftlake.sources import requests
from siftlake.streaming import state

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: Event types of the stream table as states and actors of a review.
SQL_STATE = "CASE event_type WHEN 'signup' THEN 'discovered' WHEN 'view' THEN 'triaged' WHEN 'click' THEN 'awaiting_review' WHEN 'purchase' THEN 'included' ELSE 'excluded' END"
SQL_ACTOR = "CASE WHEN event_type IN ('purchase', 'error') THEN 'human' ELSE 'deterministic' END"


def review_events(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    to_state = F.when(kind == "signup", "discovered").when(kind == "view", "triaged").when(kind == "click", "awaiting_review").when(kind == "purchase", "included").otherwise("excluded")
    return events.select("event_id", F.col("user_id").alias("group_id"), to_state.alias("to_state"), F.when(kind.isin("purchase", "error"), "human").otherwise("deterministic").alias("actor_kind"), "ts")


@query(f"SELECT user_id AS group_id, max_by({SQL_STATE}, event_id) AS current_state FROM events GROUP BY 1")
def current_states(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.current_states(review_events(table(spark, folder, "events")), ["group_id"], "to_state", "event_id")


@query(f"SELECT current_state, count(*) AS groups FROM (SELECT user_id, max_by({SQL_STATE}, event_id) AS current_state FROM events GROUP BY 1) GROUP BY 1")
def state_counts(spark: SparkSession, folder: str) -> DataFrame:
    return current_states(spark, folder).groupBy("current_state").agg(F.count("*").alias("groups"))


SQL_MOVES = f"""WITH e AS (SELECT event_id, user_id AS group_id, {SQL_STATE} AS to_state, {SQL_ACTOR} AS actor_kind FROM events),
    m AS (SELECT *, coalesce(lag(to_state) OVER (PARTITION BY group_id ORDER BY event_id), '') AS from_state FROM e)"""


def _moves(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import Window as W

    events = review_events(table(spark, folder, "events"))
    return events.withColumn("from_state", F.coalesce(F.lag("to_state").over(W.partitionBy("group_id").orderBy("event_id")), F.lit("")))


_LEGAL = " OR ".join(f"(actor_kind = '{actor}' AND from_state = '{a}' AND to_state = '{b}')" for actor, edges in ledger.EDGES.items() for a, b in edges)


@query(f"{SQL_MOVES} SELECT actor_kind, from_state, to_state, count(*) AS transitions FROM m WHERE NOT ({_LEGAL}) GROUP BY ALL")
def illegal_transitions(spark: SparkSession, folder: str) -> DataFrame:
    bad = _moves(spark, folder).filter(~ledger.is_legal(F.col("from_state"), F.col("to_state"), F.col("actor_kind")))
    return bad.groupBy("actor_kind", "from_state", "to_state").agg(F.count("*").alias("transitions"))


@query(f"""{SQL_MOVES}, w AS (SELECT event_id, group_id, CASE WHEN event_id % 50 = 0 THEN 'appraised' ELSE from_state END AS from_state, to_state FROM m)
    SELECT w.event_id FROM w JOIN m USING (event_id) WHERE w.from_state <> m.from_state""")
def state_chain_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Every fiftieth event is given a wrong from-state; the audit must name exactly the events whose claim contradicts the one before."""
    claimed = _moves(spark, folder).withColumn("from_state", F.when(F.col("event_id") % 50 == 0, "appraised").otherwise(F.nullif("from_state", F.lit(""))))
    return ledger.state_breaks(claimed, ["group_id"], "from_state", "to_state", "event_id").select("event_id")


@query("""
    WITH s AS (SELECT row_number() OVER (ORDER BY id) AS seq, id FROM (SELECT DISTINCT id FROM acquisitions)),
    c AS (SELECT seq, sha256(id) AS entry, sha256(lag(id) OVER (ORDER BY seq)) AS prev FROM s)
    SELECT seq FROM c WHERE seq % 40 = 0 AND seq > 1""")
def ledger_chain_audit(spark: SparkSession, folder: str) -> DataFrame:
    """A chain over the acquisitions in which every fortieth link is broken; the audit must name exactly those."""
    seq = ledger.numbered(table(spark, folder, "acquisitions").select("id").distinct(), "id").withColumnRenamed("sequence", "seq")
    before = seq.select((F.col("seq") + 1).alias("seq"), F.sha2("id", 256).alias("prev"))
    entries = seq.select("seq", F.sha2("id", 256).alias("entry")).join(before, "seq", "left")
    return ledger.chain_breaks(entries.withColumn("prev", F.when(F.col("seq") % 40 == 0, F.lit("?")).otherwise(F.col("prev"))), "seq", "entry", "prev").select("seq")


@query("""
    WITH f AS (SELECT acquisition_id AS id, count(*) AS found FROM (SELECT DISTINCT acquisition_id, rank FROM source_records) GROUP BY 1)
    SELECT id, count(*) AS deliveries, any_value(source_count) AS source_count, bool_and(sha256(request_json) = request_sha256) AS request_ok, bool_and(sha256(response_json) = response_sha256) AS response_ok,
        coalesce(any_value(found), 0) AS found, coalesce(any_value(found), 0) = any_value(source_count) AS count_ok FROM acquisitions LEFT JOIN f USING (id) GROUP BY id""")
def acquisition_audit(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.acquisition_audit(table(spark, folder, "acquisitions"), table(spark, folder, "source_records"))


@query("""SELECT pair_sha256, max_by(decided_by, (CAST(decided_at AS TIMESTAMPTZ), id)) AS decided_by, max_by(id, (CAST(decided_at AS TIMESTAMPTZ), id)) AS id FROM duplicate_decisions GROUP BY 1""")
def latest_appraisal(spark: SparkSession, folder: str) -> DataFrame:
    """The latest decision on each pair: by instant, then id."""
    rows = table(spark, folder, "duplicate_decisions").withColumn("at", N.instant_utc(F.col("decided_at")))
    return ledger.latest(rows, ["pair_sha256"], [F.col("at"), F.col("id")], ["decided_by", "id"])


@query("""
    WITH u AS (SELECT identity_key FROM source_records WHERE kind = 'paper' UNION ALL SELECT identity_key FROM source_records WHERE kind = 'trial')
    SELECT count(*) AS records, count(DISTINCT identity_key) AS identities, greatest(0, 5000 - greatest(count(*), count(DISTINCT identity_key))) AS remaining, greatest(count(*), count(DISTINCT identity_key)) > 5000 AS over_cap FROM u""")
def acquisition_budget(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "source_records")
    return ledger.budget([rows.filter("kind = 'paper'"), rows.filter("kind = 'trial'")], 5000)


@query("""
    WITH RECURSIVE j AS (SELECT n_regionkey AS pool, n_nationkey, 20 + n_nationkey % 7 * 10 AS want, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i, count(*) OVER (PARTITION BY n_regionkey) AS n FROM nation),
    q AS (SELECT pool, n_nationkey, i, n, least(want, CAST(ceil(150.0 / n) AS BIGINT)) AS given, 150 - least(want, CAST(ceil(150.0 / n) AS BIGINT)) AS left_over FROM j WHERE i = 1
        UNION ALL SELECT j.pool, j.n_nationkey, j.i, j.n, least(j.want, CAST(ceil(q.left_over / (j.n - j.i + 1)) AS BIGINT)), q.left_over - least(j.want, CAST(ceil(q.left_over / (j.n - j.i + 1)) AS BIGINT)) FROM q JOIN j ON j.pool = q.pool AND j.i = q.i + 1)
    SELECT pool, n_nationkey, given FROM q""")
def fair_share_quota(spark: SparkSession, folder: str) -> DataFrame:
    """150 records of each region shared among its nations' requests in order."""
    rows = table(spark, folder, "nation").select(F.col("n_regionkey").alias("pool"), "n_nationkey", (F.lit(20) + F.col("n_nationkey") % 7 * 10).alias("want"))
    lists = rows.groupBy("pool").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "want"))).alias("jobs"))
    given = lists.withColumn("given", ledger.fair_share(F.col("jobs.want"), F.lit(150)))
    return given.select("pool", F.explode(F.arrays_zip(F.col("jobs.n_nationkey").alias("n_nationkey"), "given")).alias("r")).select("pool", "r.n_nationkey", "r.given")


@query("""
    WITH r AS (SELECT DISTINCT id, request_sha256, endpoint, sha256(request_json ->> '$.query') AS loose FROM acquisitions)
    SELECT a.id, count(DISTINCT b.id) FILTER (WHERE b.request_sha256 = a.request_sha256) - 1 AS exact_prior, count(DISTINCT b.id) - 1 AS relaxed_prior FROM r a JOIN r b ON a.endpoint = b.endpoint AND a.loose = b.loose GROUP BY a.id""")
def prior_request_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """For each acquisition the others with the same request, exactly and without its paging: counted per request, never paired."""
    rows = table(spark, folder, "acquisitions").select("id", "request_sha256", "endpoint", F.sha2(F.get_json_object("request_json", "$.query"), 256).alias("loose")).distinct()
    exact = rows.groupBy("endpoint", "loose", "request_sha256").agg(F.count("*").alias("same"))
    relaxed = rows.groupBy("endpoint", "loose").agg(F.count("*").alias("all"))
    joined = rows.join(exact, ["endpoint", "loose", "request_sha256"]).join(relaxed, ["endpoint", "loose"])
    return joined.select("id", (F.col("same") - 1).alias("exact_prior"), (F.col("all") - 1).alias("relaxed_prior"))


@query("""
    WITH r AS (SELECT DISTINCT id, regexp_replace(lower(trim(provider)), '[^a-z0-9]+', '_', 'g') AS provider, request_json ->> '$.query' AS q, CAST(request_json ->> '$.maxResults' AS INTEGER) AS m FROM acquisitions),
    look AS (SELECT provider AS p, q, m, min(id) AS query_id, true AS compiled FROM r WHERE provider = 'pubmed' GROUP BY ALL UNION ALL SELECT NULL, q, m, min(id), false FROM r WHERE provider = 'europe_pmc' GROUP BY ALL),
    loose AS (SELECT p, q, min(query_id) AS query_id, any_value(compiled) AS compiled FROM look GROUP BY p, q HAVING count(DISTINCT query_id) = 1)
    SELECT r.id, coalesce(a.query_id, b.query_id, c.query_id, d.query_id, 'unmapped') AS query_id, coalesce(a.compiled, b.compiled, c.compiled, d.compiled, false) AS compiled FROM r
        LEFT JOIN look a ON a.p = r.provider AND a.q = r.q AND a.m = r.m LEFT JOIN look b ON b.p IS NULL AND b.q = r.q AND b.m = r.m
        LEFT JOIN loose c ON c.p = r.provider AND c.q = r.q LEFT JOIN loose d ON d.p IS NULL AND d.q = r.q""")
def query_provenance(spark: SparkSession, folder: str) -> DataFrame:
    """Which query an acquisition came from, by four keys in turn; one provider's requests stand in as the campaign's questions, another's as compiled expressions."""
    rows = table(spark, folder, "acquisitions").select(
        "id", provider_key(F.col("provider")).alias("provider"), F.get_json_object("request_json", "$.query").alias("expression"), F.get_json_object("request_json", "$.maxResults").cast("int").alias("maximum")
    ).distinct()
    named = lambda provider, *keys: rows.filter(F.col("provider") == provider).groupBy(*keys, "expression", "maximum").agg(F.min("id").alias("query_id")).withColumn("negative_control", F.lit(False))
    lookup = provenance.lookup_rows(named("europe_pmc"), named("pubmed", "provider"))
    return provenance.trace_queries(rows, lookup).select("id", "query_id", "compiled")


@query("""
    WITH q AS (SELECT request_json ->> '$.query' AS q, max(id) AS query_id FROM acquisitions WHERE regexp_replace(lower(trim(provider)), '[^a-z0-9]+', '_', 'g') = 'europe_pmc' GROUP BY 1)
    SELECT DISTINCT id, coalesce(query_id, 'unmapped') AS query_id, CASE WHEN query_id IS NULL THEN 0 ELSE 2 END AS phase FROM acquisitions LEFT JOIN q ON q = request_json ->> '$.query'""")
def question_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The older lookup of acquisitions by their question."""
    rows = table(spark, folder, "acquisitions").select("id", provider_key(F.col("provider")).alias("provider"), F.get_json_object("request_json", "$.query").alias("expression")).distinct()
    asked = rows.filter("provider = 'europe_pmc'").select("expression", F.col("id").alias("query_id"), F.lit(2).alias("phase"))
    return provenance.trace_questions(rows, asked).select("id", "query_id", "phase")


@query("SELECT id, contains(response_json, replace(title, chr(34), chr(92) || chr(34))) AS verbatim FROM (SELECT DISTINCT s.id, s.title, a.response_json FROM source_records s JOIN acquisitions a ON a.id = s.acquisition_id WHERE length(s.title) > 0)")
def verbatim_span_check(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each record's title stands verbatim in the response it is said to come from."""
    batch = table(spark, folder, "acquisitions").dropDuplicates(["id"]).select(F.col("id").alias("acquisition_id"), "response_json")
    rows = table(spark, folder, "source_records").filter("length(title) > 0").select("id", "acquisition_id", "title").distinct().join(batch, "acquisition_id")
    return rows.select("id", F.contains("response_json", F.replace("title", F.lit('"'), F.lit('\\"'))).alias("verbatim"))


@query("SELECT doc_id, array_to_string([x FOR x IN regexp_split_to_array(text, '\\s+') IF x <> ''], ' ') AS abstract FROM documents WHERE doc_kind = 'abstract' AND length(trim(text)) > 0")
def inverted_index_abstract(spark: SparkSession, folder: str) -> DataFrame:
    """Abstracts inverted to word -> positions and rebuilt from that."""
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    docs = table(spark, folder, "documents").filter("doc_kind = 'abstract' and length(trim(text)) > 0").withColumn("w", words)
    places = lambda w: F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", i) == w)
    index = F.map_from_entries(F.transform(F.array_distinct("w"), lambda w: F.struct(w, places(w))))
    return docs.withColumn("index", index).select("doc_id", N.inverted_abstract(F.col("index")).alias("abstract"))


@query("SELECT id, retrieved_at, rank FROM (SELECT DISTINCT id, retrieved_at, rank, CAST(retrieved_at AS TIMESTAMPTZ) AS t FROM source_records) ORDER BY t DESC, rank, id LIMIT 100")
def source_list_topn(spark: SparkSession, folder: str) -> DataFrame:
    """The 100 latest sources (a top-k report)."""
    rows = table(spark, folder, "source_records").select("id", "retrieved_at", "rank", N.instant_utc(F.col("retrieved_at")).alias("t")).distinct()
    return rows.orderBy(F.col("t").desc(), "rank", "id").limit(100).drop("t")


@query("""
    SELECT id, len([x FOR x IN [CASE WHEN NOT coalesce(regexp_full_match(id, '[0-9a-f]{64}'), false) THEN 'id' END, CASE WHEN NOT coalesce(decision IN ('same_study', 'different_study', 'uncertain'), false) THEN 'decision' END,
        CASE WHEN coalesce(state_authority, 1) <> 0 THEN 'state_authority' END, CASE WHEN sha256(evidence_json) IS DISTINCT FROM evidence_sha256 THEN 'evidence_sha256' END] IF x IS NOT NULL]) AS errors FROM duplicate_decisions""")
def closed_world_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions with the number of fields that break the closed schema."""
    no = F.lit(False)
    errors = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("id").rlike("^[0-9a-f]{64}$"), no), "id"), F.when(~F.coalesce(F.col("decision").isin("same_study", "different_study", "uncertain"), no), "decision"),
        F.when(F.coalesce("state_authority", F.lit(1)) != 0, "state_authority"), F.when(~F.sha2("evidence_json", 256).eqNullSafe(F.col("evidence_sha256")), "evidence_sha256"),
    ))
    return table(spark, folder, "duplicate_decisions").select("id", F.size(errors).cast("bigint").alias("errors"))


@query("""SELECT DISTINCT id, regexp_matches(replace(lower(request_json), '-', '_'), '"[a-z0-9_]*(authorization|api_key|apikey|access_token|secret|password|credential|bearer)[a-z0-9_]*"\\s*:') AS has_secret FROM acquisitions""")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "acquisitions").select("id", N.has_secret(F.col("request_json")).alias("has_secret")).distinct()


@query("SELECT DISTINCT pair_sha256 FROM duplicate_decisions WHERE pair_sha256 NOT IN (SELECT pair_sha256 FROM duplicate_pairs)")
def unlisted_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions on pairs that aren't listed (foreign keys without a target)."""
    return ledger.missing_references(table(spark, folder, "duplicate_decisions"), table(spark, folder, "duplicate_pairs"), "pair_sha256", "pair_sha256")


@query("""SELECT pair_sha256, count(DISTINCT regexp_replace(lower(trim(decision)), '[^a-z]+', '_', 'g')) AS words, count(DISTINCT campaign_id) AS campaigns FROM duplicate_decisions GROUP BY 1 HAVING count(DISTINCT campaign_id) > 1""")
def decided_twice(spark: SparkSession, folder: str) -> DataFrame:
    word = F.regexp_replace(F.lower(F.trim("decision")), "[^a-z]+", "_")
    found = table(spark, folder, "duplicate_decisions").groupBy("pair_sha256").agg(F.count_distinct(word).alias("words"), F.count_distinct("campaign_id").alias("campaigns"))
    return found.filter("campaigns > 1")


@query("""
    SELECT list_sort(list_intersect(a, b)) AS common, list_sort([x FOR x IN a IF NOT list_contains(b, x)]) AS only_first, list_sort(list_distinct(list_concat(a, b))) AS either, group_id FROM
        (SELECT g.group_id, list_distinct(string_split(g.normalised_title, ' ')) AS a, list_distinct(string_split(h.normalised_title, ' ')) AS b FROM (SELECT DISTINCT left_group_id, right_group_id FROM duplicate_pairs) p
            JOIN dedup_groups g ON g.group_id = p.left_group_id JOIN dedup_groups h ON h.group_id = p.right_group_id)""")
def title_set_algebra(spark: SparkSession, folder: str) -> DataFrame:
    """Intersection, difference and union of the title words of listed pairs."""
    groups = table(spark, folder, "dedup_groups").select("group_id", F.array_distinct(F.split("normalised_title", " ")).alias("w"))
    pairs = table(spark, folder, "duplicate_pairs").select("left_group_id", "right_group_id").distinct()
    rows = pairs.join(groups.select(F.col("group_id").alias("left_group_id"), F.col("w").alias("a")), "left_group_id").join(groups.select(F.col("group_id").alias("right_group_id"), F.col("w").alias("b")), "right_group_id")
    return rows.select(
        F.array_sort(F.array_intersect("a", "b")).alias("common"), F.array_sort(F.array_except("a", "b")).alias("only_first"), F.array_sort(F.array_union("a", "b")).alias("either"), F.col("left_group_id").alias("group_id")
    )


@query("""SELECT table_name, n FROM (SELECT 'acquisitions' AS table_name, count(DISTINCT id) AS n FROM acquisitions UNION ALL SELECT 'source_records', count(DISTINCT id) FROM source_records
    UNION ALL SELECT 'duplicate_decisions', count(DISTINCT id) FROM duplicate_decisions UNION ALL SELECT 'dedup_groups', count(*) FROM dedup_groups)""")
def ledger_counts(spark: SparkSession, folder: str) -> DataFrame:
    parts = [table(spark, folder, t).agg(F.lit(t).alias("table_name"), F.count_distinct("id" if t != "dedup_groups" else "group_id").alias("n")) for t in ("acquisitions", "source_records", "duplicate_decisions", "dedup_groups")]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


@query()
def compiled_queries(spark: SparkSession, folder: str) -> DataFrame:
    """The specification's queries and controls as every provider writes them."""
    ontology = {k: {c: {"terms": t} for c, t in ONTOLOGY[k].items()} for k in ONTOLOGY}
    spec = {"queries": [q for q in SPECIFICATION if not q.get("negative_control")], "negative_controls": [q for q in SPECIFICATION if q.get("negative_control")]}
    manifest = campaign.compile_manifest({"queries": []}, ontology, spec, ("europe_pmc", "pubmed", "openalex"))
    return campaign.manifest_frame(spark, manifest)


@query("""
    SELECT window_start, event_type, count(*) AS events, sum(value) AS total FROM (SELECT date_trunc('hour', ts) AS window_start, event_type, value FROM events) GROUP BY ALL""")
def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly windows over the event stream, read as a stream with a watermark and run to its end."""
    return state.hourly_counts(spark, f"{folder}/events.parquet")


@query("SELECT count(*) AS events, count(DISTINCT event_id) AS distinct_events FROM events")
def stream_dedup_append(spark: SparkSession, folder: str) -> DataFrame:
    """The event table streamed twice into an append-only ledger that takes each id once."""
    ledger_rows = state.append_once(spark, f"{folder}/events.parquet")
    return ledger_rows.agg(F.count("*").alias("events"), F.count_distinct("event_id").alias("distinct_events"))


@query(f"""
    WITH RECURSIVE e AS (SELECT event_id, user_id AS group_id, {SQL_STATE} AS to_state, {SQL_ACTOR} AS actor_kind, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
    run AS (
        SELECT group_id, event_id, k, '' AS from_state, to_state, CASE WHEN actor_kind = 'deterministic' AND to_state = 'discovered' THEN 'accepted' ELSE 'rejected' END AS outcome,
            CASE WHEN actor_kind = 'deterministic' AND to_state = 'discovered' THEN to_state ELSE '' END AS current FROM e WHERE k = 1
        UNION ALL
        SELECT e.group_id, e.event_id, e.k, run.current, e.to_state, CASE WHEN ok THEN 'accepted' ELSE 'rejected' END, CASE WHEN ok THEN e.to_state ELSE run.current END
        FROM run JOIN e ON e.group_id = run.group_id AND e.k = run.k + 1, LATERAL (SELECT
            (e.actor_kind = 'deterministic' AND (run.current, e.to_state) IN (('', 'discovered'), ('discovered', 'triaged'), ('triaged', 'awaiting_review')))
            OR (e.actor_kind = 'human' AND (run.current, e.to_state) IN (('awaiting_review', 'included'), ('awaiting_review', 'excluded'))) AS ok))
    SELECT group_id, event_id, from_state, to_state, outcome FROM run""")
def stream_state_machine(spark: SparkSession, folder: str) -> DataFrame:
    """Review events run through the keyed state machine as a stream: accepted, replayed and rejected ones by group."""
    return state.run_state_machine(spark, f"{folder}/events.parquet")


@query("""
    SELECT 'acquisition_count' AS check, count(*) AS rows, count(*) FILTER (WHERE n IS DISTINCT FROM source_count) AS failures, min(CASE WHEN n IS DISTINCT FROM source_count THEN id END) AS first_failure FROM
        (SELECT id, any_value(source_count) AS source_count FROM acquisitions GROUP BY id) LEFT JOIN (SELECT acquisition_id AS id, count(DISTINCT rank) AS n FROM source_records GROUP BY 1) USING (id) UNION ALL
    SELECT 'acquisition_request', count(*), count(*) FILTER (WHERE sha256(request_json) IS DISTINCT FROM request_sha256), min(CASE WHEN sha256(request_json) IS DISTINCT FROM request_sha256 THEN id END) FROM acquisitions UNION ALL
    SELECT 'acquisition_response', count(*), count(*) FILTER (WHERE sha256(response_json) IS DISTINCT FROM response_sha256), min(CASE WHEN sha256(response_json) IS DISTINCT FROM response_sha256 THEN id END) FROM acquisitions UNION ALL
    SELECT 'decision_authority', count(*), count(*) FILTER (WHERE state_authority IS DISTINCT FROM 0), min(CASE WHEN state_authority IS DISTINCT FROM 0 THEN id END) FROM duplicate_decisions UNION ALL
    SELECT 'decision_evidence', count(*), count(*) FILTER (WHERE sha256(evidence_json) IS DISTINCT FROM evidence_sha256), min(CASE WHEN sha256(evidence_json) IS DISTINCT FROM evidence_sha256 THEN id END) FROM duplicate_decisions UNION ALL
    SELECT 'decision_pair', count(*), count(*) FILTER (WHERE NOT listed), min(CASE WHEN NOT listed THEN id END) FROM (SELECT id, pair_sha256 IN (SELECT pair_sha256 FROM duplicate_pairs) AS listed FROM duplicate_decisions) UNION ALL
    SELECT 'record_acquisition', count(*), count(*) FILTER (WHERE NOT held), min(CASE WHEN NOT held THEN id END) FROM (SELECT id, acquisition_id IN (SELECT id FROM acquisitions) AS held FROM source_records) UNION ALL
    SELECT 'record_payload', count(*), count(*) FILTER (WHERE sha256(raw_json) IS DISTINCT FROM raw_sha256), min(CASE WHEN sha256(raw_json) IS DISTINCT FROM raw_sha256 THEN id END) FROM source_records UNION ALL
    SELECT 'record_title', count(*), count(*) FILTER (WHERE raw_json ->> '$.title' IS DISTINCT FROM title), min(CASE WHEN raw_json ->> '$.title' IS DISTINCT FROM title THEN id END) FROM source_records""")
def ledger_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Hashes, counts, references, projections and authority of all ledger tables recomputed, one row a check."""
    taken, records, said = (table(spark, folder, t) for t in ("acquisitions", "source_records", "duplicate_decisions"))
    counted = ledger.acquisition_audit(taken, records).withColumn("fits", F.col("count_ok") & (F.col("found") > 0))
    hashed = lambda c: F.sha2(f"{c}_json", 256) == F.col(f"{c}_sha256")
    held = taken.select(F.col("id").alias("acquisition_id"), F.lit(True).alias("_held")).distinct()
    listed = table(spark, folder, "duplicate_pairs").select("pair_sha256", F.lit(True).alias("_listed")).distinct()
    key = F.col("id")
    return ledger.audit_rows({
        "acquisition_count": (counted, key, F.col("fits")), "acquisition_request": (taken, key, hashed("request")), "acquisition_response": (taken, key, hashed("response")),
        "decision_authority": (said, key, F.col("state_authority") == 0), "decision_evidence": (said, key, hashed("evidence")), "decision_pair": (said.join(listed, "pair_sha256", "left"), key, F.col("_listed")),
        "record_acquisition": (records.join(held, "acquisition_id", "left"), key, F.col("_held")), "record_payload": (records, key, F.sha2("raw_json", 256) == F.col("raw_sha256")),
        "record_title": (records, key, F.get_json_object("raw_json", "$.title").eqNullSafe(F.col("title"))),
    })


@query("""
    SELECT id, substr(title, 1, 12) <> '' AND contains(title, substr(title, 1, 12)) AND length(coalesce(venue, '')) % 4 <> 0 AND venue IS NOT NULL AS verbatim
    FROM (SELECT DISTINCT id, title, raw_json ->> '$.venue' AS venue FROM source_records WHERE length(title) > 0)""")
def verbatim_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Evidence spans of proposals against their sources: the title's begin always stands there, the venue's only where its length doesn't fall to a planted slip."""
    rows = table(spark, folder, "source_records").filter("length(title) > 0").select("id", "title", F.get_json_object("raw_json", "$.venue").alias("venue")).distinct()
    span = lambda field, text: F.struct(F.lit(field).alias("field"), text.alias("exact_text"))
    slip = F.when(F.length("venue") % 4 == 0, F.concat("venue", F.lit("~"))).otherwise(F.col("venue"))
    said = rows.select("id", F.array(span("title", F.left("title", F.lit(12))), span("venue", slip)).alias("spans"))
    return ledger.verbatim_spans(said, rows, "id", ("title", "venue")).select("id", "verbatim")


@query("""
    WITH held AS (SELECT DISTINCT id FROM duplicate_decisions WHERE campaign_id = (SELECT min(campaign_id) FROM duplicate_decisions)), b AS (SELECT DISTINCT id, pair_sha256 FROM duplicate_decisions)
    SELECT id, pair_sha256, CASE WHEN pair_sha256 NOT IN (SELECT pair_sha256 FROM duplicate_pairs) THEN 'refused' ELSE 'appended' END AS outcome FROM b
        WHERE pair_sha256 NOT IN (SELECT pair_sha256 FROM duplicate_pairs) OR id NOT IN (SELECT id FROM held)""")
def referenced_append(spark: SparkSession, folder: str) -> DataFrame:
    """All decisions delivered to a ledger that holds one campaign's already: new ones on listed pairs are appended, those on unlisted pairs refused."""
    batch = table(spark, folder, "duplicate_decisions").select("id", "pair_sha256", "campaign_id").distinct()
    held = batch.join(F.broadcast(batch.agg(F.min("campaign_id").alias("campaign_id"))), "campaign_id", "left_semi")
    added, refused = ledger.append_referenced(held, batch.drop("campaign_id"), table(spark, folder, "duplicate_pairs"), "pair_sha256", "pair_sha256")
    return added.withColumn("outcome", F.lit("appended")).unionByName(refused.withColumn("outcome", F.lit("refused"))).distinct()


@query("""
    SELECT id, CASE WHEN k IN (0, 1) THEN true ELSE false END AS holds FROM (SELECT DISTINCT id, length(title) % 3 AS k FROM source_records WHERE title IS NOT NULL)""")
def payload_binding(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads bound by a hash that was taken before (0) or after (1) a field was derived, or of another payload (2)."""
    rows = table(spark, folder, "source_records").filter("title is not null").select("id", "title", "raw_json").distinct()
    plain = N.canonical_json(F.to_json(F.struct("id", "title")))
    derived = N.canonical_json(F.to_json(F.struct("id", "title", F.lit(7).alias("screening_priority"))))
    k = F.length("title") % 3
    recorded = F.sha2(F.when(k == 0, plain).when(k == 1, derived).otherwise(F.concat(plain, F.lit("~"))), 256)
    return rows.select("id", ledger.payload_holds(derived, recorded, "group_payload_sha256", ("screening_priority", "priority_reason_codes")).alias("holds"))


_APPRAISAL = """
    WITH r AS (SELECT DISTINCT id, title, length(title) % 9 AS k FROM source_records WHERE title IS NOT NULL)
    SELECT id, CASE k WHEN 1 THEN ['missing:notes'] WHEN 2 THEN ['extra:verdict'] WHEN 3 THEN ['study_design'] WHEN 4 THEN ['human_verified'] WHEN 5 THEN ['verified_without_quote'] WHEN 6 THEN ['assessed_at', 'source_record_id']
        WHEN 7 THEN ['full_text_without_locator', 'risk_of_bias'] WHEN 8 THEN ['not_an_object'] ELSE []::VARCHAR[] END AS breaches FROM r"""


@query(_APPRAISAL)
def appraisal_contract(spark: SparkSession, folder: str) -> DataFrame:
    """An appraisal of every record with faults planted by the length of its title; the contract must name exactly those."""
    rows = table(spark, folder, "source_records").filter("title is not null").select("id", "title", (F.length("title") % 9).alias("k")).distinct()
    when = lambda k, bad, good: F.when(F.col("k") == k, F.lit(bad)).otherwise(F.lit(good))
    body = {
        "schema_version": F.lit("appraisal.v1"), "source_record_id": F.when(F.col("k") == 6, F.upper(F.concat(F.lit("x"), "id"))).otherwise(F.col("id")), "study_identity": F.col("id"), "study_design": when(3, "sort of a trial", "cohort"), "full_text_verified": F.lit(True),
        "risk_of_bias": when(7, "dreadful", "low"), "population_applicability": F.lit("direct"), "harms_assessed": F.lit(True), "conflicts_assessed": F.lit(False), "retraction_status": F.lit("clear"),
        "effect_estimate": F.lit("1.2"), "confidence_interval": F.lit("0.9 to 1.5"), "outcome_direction": F.lit("mixed"), "supporting_quote": F.when(F.col("k") != 5, F.lit("quoted")), "source_locator": F.when(F.col("k") != 7, F.lit("p. 1")),
        "assessed_by": F.lit("somebody"), "assessed_at": when(6, "2024-05-01T10:00:00", "2024-05-01T10:00:00Z"), "notes": F.when(F.col("k") != 1, F.array(F.lit("n"))),
    }
    text = F.to_json(F.struct(*(c.alias(n) for n, c in body.items()), F.lit(True).alias("human_verified")), {"ignoreNullFields": "false"})
    text = F.when(F.col("k") == 4, F.replace(text, F.lit('"human_verified":true'), F.lit('"human_verified":"true"'))).otherwise(text)
    text = F.when(F.col("k") == 1, F.replace(text, F.lit('"notes":null,'), F.lit(""))).when(F.col("k") == 2, F.replace(text, F.lit('"notes":'), F.lit('"verdict":1,"notes":'))).when(F.col("k") == 8, F.lit("[1]")).otherwise(text)
    return rows.select("id", contracts.appraisal_contract("appraisal.v1").breaches(text).alias("breaches"))


@query("""
    SELECT DISTINCT id, '{"apiKeyProvided":false,"contactEmailProvided":true,"endpoint":' || to_json(endpoint) || ',"filters":{},"maxResults":' || coalesce(request_json ->> '$.maxResults', 'null') || ',"provider":' || to_json(provider)
        || ',"query":' || coalesce(to_json(request_json ->> '$.query')::VARCHAR, 'null') || '}' AS envelope,
        '(' || (request_json ->> '$.query') || ') NOT (hasretractionin OR retracted publication[pt]) AND (review[pt] OR randomized controlled trial[pt]) AND 1990:2200[dp]' AS effective,
        CASE WHEN length(id || provider) % 2 = 0 THEN 'https://api.example/records/' || id END AS address FROM acquisitions""")
def request_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Requests rebuilt as envelopes and effective queries, and which of two addresses is the official one."""
    rows = table(spark, folder, "acquisitions").select("id", "provider", "endpoint", F.get_json_object("request_json", "$.query").alias("q"), F.get_json_object("request_json", "$.maxResults").cast("int").alias("m")).distinct()
    none = F.lit(None).cast("string")
    url = F.when(F.length(F.concat("id", "provider")) % 2 == 0, F.concat(F.lit("https://api.example/records/"), "id")).otherwise(F.concat(F.lit("https://api.example.evil.example/records/"), "id"))
    return rows.select(
        "id", requests.request_envelope(F.col("provider"), F.col("endpoint"), F.col("q"), F.col("m"), none, F.lit("a@b.example"), none).alias("envelope"),
        requests.effective_query(F.col("q"), F.lit(True), F.array(F.lit("Review"), F.lit("RCT"), F.lit("Poem")), F.lit(1990), F.lit(None).cast("int")).alias("effective"),
        requests.official_address(url, "api.example", "/records/").alias("address"),
    )


@query("SELECT * FROM (SELECT DISTINCT id, kind, title, year FROM source_records) WHERE id = (SELECT min(id) FROM source_records)")
def source_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """One source by its id: the filter reaches the scan, so only its row groups are read."""
    rows = table(spark, folder, "source_records")
    return ledger.lookup(rows, "id", rows.agg(F.min("id")).first()[0]).select("id", "kind", "title", "year")
