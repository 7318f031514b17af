"""Scans, normalisers and deduplication over the ledger tables, each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.functions import normalise as N
from siftlake.functions.identifiers import identity_form
from siftlake.operators import dedup
from siftlake.operators.nested import provider_key
from siftlake.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# SQL of the normalisers, as far as these tables need them.
def sql_text(x: str) -> str:
    return f"nullif(trim(regexp_replace(replace(replace(replace(replace({x}, '&amp;', '&'), '&#37;', '%'), 'ﬁ', 'fi'), '…', '...'), '\\s+', ' ', 'g')), '')"


def sql_title(x: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents(replace(replace(replace(coalesce({x}, ''), '&amp;', '&'), 'ﬁ', 'fi'), 'ß', 'ss'))), '[^a-z0-9]+', ' ', 'g'))"


def sql_doi(x: str) -> str:
    bare = f"trim(regexp_replace(trim({x}), '^(https://doi\\.org/|http://doi\\.org/|doi:)', '', 'i'))"
    found = f"lower(regexp_replace({bare}, '[.,;]+$', ''))"
    return f"CASE WHEN regexp_full_match({found}, '10\\.\\d{{4,9}}/\\S+') THEN {found} END"


def sql_own(column: str, field: str) -> str:
    """A record's own value, else that of its raw JSON."""
    return f"coalesce(CASE WHEN trim({column}) <> '' THEN {column} END, raw_json ->> '$.{field}')"


SQL_PROVIDER = "regexp_replace(lower(trim(provider)), '[^a-z0-9]+', '_', 'g')"
SQL_BATCH = f"""
    batch AS (SELECT DISTINCT ON (id) id AS acquisition_id, {SQL_PROVIDER} AS provider, endpoint, observed_at,
        request_json ->> '$.query' AS query FROM acquisitions)"""
SQL_RECORD = f"""
    rec AS (SELECT DISTINCT ON (id) id AS source_record_id, acquisition_id, kind, {sql_text('title')} AS title, {sql_title('title')} AS normalised_title,
        {sql_text("(raw_json ->> '$.abstract')")} AS abstract,
        coalesce(year, CAST(nullif(regexp_extract(raw_json ->> '$.year', '\\b(1[6-9]\\d{{2}}|20\\d{{2}}|21\\d{{2}}|2200)\\b', 1), '') AS INTEGER)) AS year, {sql_doi(sql_own('doi', 'doi'))} AS doi,
        CASE WHEN regexp_full_match(trim(regexp_replace({sql_own('pmid', 'pmid')}, '^pmid:\\s*', '', 'i')), '\\d{{1,12}}') THEN trim(regexp_replace({sql_own('pmid', 'pmid')}, '^pmid:\\s*', '', 'i')) END AS pmid,
        CASE WHEN regexp_full_match(upper(raw_json ->> '$.pmcid'), 'PMC\\d+') THEN upper(raw_json ->> '$.pmcid') END AS pmcid,
        CASE WHEN regexp_full_match(upper(trim({sql_own('nct_id', 'nctId')})), 'NCT\\d{{8}}') THEN upper(trim({sql_own('nct_id', 'nctId')})) END AS nct_id,
        raw_json ->> '$.isOpenAccess' AS open_flag, coalesce(CAST(raw_json -> '$.urls' AS VARCHAR[]), []) AS all_urls,
        coalesce(CAST(raw_json -> '$.authors' AS VARCHAR[]), []) AS authors, retrieved_at
        FROM source_records),
    can AS (SELECT rec.*, batch.provider, batch.endpoint, batch.query, batch.observed_at FROM rec JOIN batch USING (acquisition_id)),
    tok AS (
        SELECT source_record_id, 'doi:' || lower(doi) AS token FROM can WHERE doi IS NOT NULL UNION ALL
        SELECT source_record_id, 'pmid:' || pmid FROM can WHERE pmid IS NOT NULL UNION ALL
        SELECT source_record_id, 'pmcid:' || lower(pmcid) FROM can WHERE pmcid IS NOT NULL UNION ALL
        SELECT source_record_id, 'nct_id:' || lower(nct_id) FROM can WHERE nct_id IS NOT NULL UNION ALL
        SELECT source_record_id, 'title-year:' || normalised_title || ':' || coalesce(CAST(year AS VARCHAR), 'unknown') FROM can WHERE length(normalised_title) >= 20),
    hub AS (SELECT token, min(source_record_id) AS centre FROM tok GROUP BY token),
    edge AS (SELECT DISTINCT source_record_id AS a, centre AS b FROM tok JOIN hub USING (token)),
    both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge UNION SELECT source_record_id, source_record_id FROM can),
    reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, e.b FROM reach JOIN both_ways e ON reach.b = e.a),
    comp AS (SELECT a AS source_record_id, min(b) AS component FROM reach GROUP BY a)"""
SQL_CANONICAL = f"WITH RECURSIVE {SQL_BATCH}, {SQL_RECORD}"


def canonical(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.canonical_records(table(spark, folder, "source_records"), table(spark, folder, "acquisitions"))


def components(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    records = canonical(spark, folder)
    return records, dedup.exact_deduplicate(records, dedup.exact_tokens(records))


def golden(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.golden_records(*components(spark, folder))


@query(f"{SQL_CANONICAL} SELECT source_record_id, acquisition_id, provider, endpoint, kind, query, title, normalised_title, year, doi, pmid, pmcid, nct_id, len(authors) AS author_count FROM can")
def scan_join_canonical(spark: SparkSession, folder: str) -> DataFrame:
    return canonical(spark, folder).select(
        "source_record_id", "acquisition_id", "provider", "endpoint", "kind", "query", "title", "normalised_title", "year", "doi", "pmid", "pmcid", "nct_id",
        F.size("authors").alias("author_count"),
    )


@query(f"SELECT DISTINCT id, {sql_title('title')} AS normalised_title FROM source_records")
def normalise_title(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "source_records").select("id", N.normalise_title(F.col("title")).alias("normalised_title")).distinct()


@query(f"SELECT doc_id, {sql_title('regexp_extract(text, ' + chr(39) + '^[^' + chr(92) + 'n' + chr(92) + 'r]*' + chr(39) + ')')} AS heading FROM documents")
def document_headings(spark: SparkSession, folder: str) -> DataFrame:
    heading = F.regexp_extract("text", "^[^\\n\\r]*", 0)
    return table(spark, folder, "documents").select("doc_id", N.normalise_title(heading).alias("heading"))


@query("""
    SELECT DISTINCT id, nullif(trim(regexp_replace(regexp_replace(replace(replace(raw_json ->> '$.abstract', '&amp;', '&'), '&#37;', '%'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), '') AS abstract
    FROM source_records""")
def clean_html_abstract(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "source_records")
    return raw.select("id", N.clean_abstract(F.get_json_object("raw_json", "$.abstract")).alias("abstract")).distinct()


@query(f"""
    SELECT DISTINCT id, {sql_doi('doi')} AS doi, CASE WHEN regexp_full_match(trim(pmid), '\\d{{1,12}}') THEN trim(pmid) END AS pmid,
        CASE WHEN regexp_full_match(upper(trim(nct_id)), 'NCT\\d{{8}}') THEN upper(trim(nct_id)) END AS nct_id FROM source_records""")
def identifiers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "source_records").select(
        "id", N.normalise_doi(F.col("doi")).alias("doi"), N.normalise_identifier(F.col("pmid"), N.PMID).alias("pmid"), N.normalise_identifier(F.col("nct_id"), N.NCT, True).alias("nct_id")
    ).distinct()


@query(r"""
    SELECT ref_id, CAST(nullif(regexp_extract(cited_year, '(1[6-9]\d{2}|20\d{2}|21\d{2}|2200)', 1), '') AS INTEGER) AS year FROM cited_references""")
def cited_years(spark: SparkSession, folder: str) -> DataFrame:
    loose = F.regexp_extract("cited_year", N.YEAR.replace(r"\b", ""), 1)
    return table(spark, folder, "cited_references").select("ref_id", F.nullif(loose, F.lit("")).cast("int").alias("year"))


@query(f"""
    WITH RECURSIVE {SQL_BATCH}, {SQL_RECORD}
    SELECT source_record_id, list_sort(list_distinct([u FOR u IN [regexp_replace(x, '^http://(dx\\.)?doi\\.org/', 'https://doi.org/') FOR x IN all_urls] IF starts_with(u, 'https://')])) AS urls,
        pmcid IS NOT NULL OR coalesce(upper(open_flag) IN ('Y', 'TRUE'), false) OR len([u FOR u IN all_urls IF starts_with(u, 'https://') AND ends_with(lower(u), '.pdf')]) > 0 AS open_access_candidate
    FROM can""")
def url_normalise(spark: SparkSession, folder: str) -> DataFrame:
    return canonical(spark, folder).select("source_record_id", "urls", "open_access_candidate")


@query("""
    SELECT DISTINCT id, coalesce('doi:' || nullif(lower(trim(doi)), ''), 'pmid:' || nullif(lower(trim(pmid)), ''), 'nct:' || nullif(lower(trim(nct_id)), ''),
        kind || ':fallback:' || sha256('{"title":' || coalesce(CAST(to_json(title) AS VARCHAR), 'null') || ',"year":' || coalesce(CAST(year AS VARCHAR), 'null') || '}')) AS identity
    FROM source_records""")
def identity_key_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "source_records")
    identity = N.source_identity(F.col("kind"), F.col("title"), F.col("year"), F.col("doi"), F.col("pmid"), F.col("nct_id"))
    return rows.select("id", identity.alias("identity")).distinct()


@query("""
    SELECT id, sha256(request_json) = request_sha256 AS request_ok, sha256(response_json) = response_sha256 AS response_ok FROM (SELECT DISTINCT * FROM acquisitions)""")
def payload_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """The stored hashes recomputed from the canonical form of the stored JSON."""
    rows = table(spark, folder, "acquisitions").distinct()
    ok = lambda c: (N.payload_hash(N.canonical_json(F.col(f"{c}_json"))) == F.col(f"{c}_sha256")).alias(f"{c}_ok")
    return rows.select("id", ok("request"), ok("response"))


@query(f"{SQL_CANONICAL} SELECT DISTINCT source_record_id, token FROM tok")
def exact_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.exact_tokens(canonical(spark, folder)).distinct()


@query(f"{SQL_CANONICAL} SELECT source_record_id, component FROM comp")
def exact_dedup_components(spark: SparkSession, folder: str) -> DataFrame:
    return components(spark, folder)[1]


SQL_GOLDEN = f"""{SQL_CANONICAL},
    pref AS (SELECT can.*, component, coalesce(preference, 99) AS p FROM can JOIN comp USING (source_record_id) LEFT JOIN provider_preference USING (provider)),
    gold AS (SELECT component, min_by(title, (p, abstract IS NULL, source_record_id)) FILTER (WHERE title <> '') AS title,
        min_by(normalised_title, (p, abstract IS NULL, source_record_id)) FILTER (WHERE normalised_title <> '') AS normalised_title,
        min_by(year, (p, abstract IS NULL, source_record_id)) FILTER (WHERE year IS NOT NULL) AS year,
        min_by(doi, (p, abstract IS NULL, source_record_id)) FILTER (WHERE doi IS NOT NULL) AS doi,
        min_by(pmid, (p, abstract IS NULL, source_record_id)) FILTER (WHERE pmid IS NOT NULL) AS pmid,
        min_by(nct_id, (p, abstract IS NULL, source_record_id)) FILTER (WHERE nct_id IS NOT NULL) AS nct_id,
        min_by(source_record_id, (p, abstract IS NULL, source_record_id)) AS preferred_source_record_id,
        list_sort(list_distinct(list(provider))) AS providers, count(*) AS retrieval_record_count
        FROM pref GROUP BY component)"""


@query(f"{SQL_GOLDEN} SELECT * FROM gold")
def golden_record(spark: SparkSession, folder: str) -> DataFrame:
    return golden(spark, folder).select("component", "title", "normalised_title", "year", "doi", "pmid", "nct_id", "preferred_source_record_id", "providers", "retrieval_record_count")


@query(f"{SQL_GOLDEN} SELECT (SELECT count(*) FROM can) AS records_identified, count(*) AS unique_groups, (SELECT count(*) FROM can) - count(*) AS duplicates_removed FROM gold")
def screening_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Retrieval records, groups left after exact deduplication, and the difference."""
    found = components(spark, folder)[1]
    return found.agg(F.count("*").alias("records_identified"), F.count_distinct("component").alias("unique_groups")).withColumn(
        "duplicates_removed", F.col("records_identified") - F.col("unique_groups")
    )


@query()
def fuzzy_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.possible_duplicate_pairs(golden(spark, folder))


SQL_DECIDED = """
    WITH RECURSIVE said AS (SELECT pair_sha256, min(CASE regexp_replace(lower(trim(decision)), '[^a-z]+', '_', 'g') WHEN 'same_study' THEN 0 WHEN 'different_study' THEN 1 ELSE 2 END) AS best
        FROM duplicate_decisions GROUP BY pair_sha256),
    pair AS (SELECT DISTINCT left_group_id, right_group_id, pair_sha256 FROM duplicate_pairs),
    decided AS (SELECT pair.*, CASE best WHEN 0 THEN 'same_study' WHEN 1 THEN 'different_study' WHEN 2 THEN 'uncertain' END AS decision FROM pair LEFT JOIN said USING (pair_sha256))"""


def _decided(spark: SparkSession, folder: str) -> DataFrame:
    pairs = table(spark, folder, "duplicate_pairs").select("left_group_id", "right_group_id", "pair_sha256").distinct()
    return dedup.latest_decisions(pairs, table(spark, folder, "duplicate_decisions"))


@query(f"{SQL_DECIDED} SELECT * FROM decided")
def pair_decisions(spark: SparkSession, folder: str) -> DataFrame:
    return _decided(spark, folder)


@query(f"""{SQL_DECIDED},
    link AS (SELECT left_group_id AS a, right_group_id AS b FROM decided WHERE decision = 'same_study'),
    both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link UNION SELECT group_id, group_id FROM dedup_groups),
    reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, e.b FROM reach JOIN both_ways e ON reach.b = e.a)
    SELECT a AS group_id, min(b) AS merged_group FROM reach GROUP BY a""")
def apply_merge_decisions(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.merge_decided(table(spark, folder, "dedup_groups"), _decided(spark, folder))


@query(f"""{SQL_DECIDED}
    SELECT count(*) AS pairs, count(*) FILTER (WHERE decision = 'same_study') AS same_study, count(*) FILTER (WHERE decision = 'different_study') AS different_study,
        count(*) FILTER (WHERE decision = 'uncertain' OR decision IS NULL) AS unresolved,
        count(*) FILTER (WHERE decision = 'uncertain' OR decision IS NULL) = 0 AS complete FROM decided""")
def decision_report(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("decision")
    unresolved = F.count_if(d.isNull() | (d == "uncertain"))
    return _decided(spark, folder).agg(
        F.count("*").alias("pairs"), F.count_if(d == "same_study").alias("same_study"), F.count_if(d == "different_study").alias("different_study"),
        unresolved.alias("unresolved"), (unresolved == 0).alias("complete"),
    )


#: An identity key without case, percent-encoding, label, resolver address, padding and closing punctuation.
SQL_IDENTITY = """lower(regexp_extract(trim({0}), '^([A-Za-z_]+):', 1)) || ':' || regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(replace(replace(regexp_replace(trim({0}), '^[A-Za-z_]+:', ''), '%2F', '/'), '%2f', '/'))),
        '^(\\s|(doi|pmid|pubmed)\\s*:|https?://[^/\\s]+/)+', ''), '^nct([0-9])', '\\1'), '[\\s.,;:]+$', ''), '^0+([0-9]+)$', '\\1')"""


@query(f"""
    WITH shared AS (SELECT {SQL_IDENTITY.format('identity_key')} AS i FROM shared_identifiers)
    SELECT DISTINCT id, {SQL_IDENTITY.format('identity_key')} AS identity, {SQL_IDENTITY.format('identity_key')} IN (SELECT i FROM shared) AS is_shared FROM source_records""")
def identity_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Identity keys in the one form that their ways of writing share; shared identifiers marked."""
    shared = table(spark, folder, "shared_identifiers").select(identity_form(F.col("identity_key")).alias("identity")).distinct().withColumn("is_shared", F.lit(True))
    rows = table(spark, folder, "source_records").select("id", identity_form(F.col("identity_key")).alias("identity")).distinct()
    return rows.join(F.broadcast(shared), "identity", "left").select("id", "identity", F.coalesce("is_shared", F.lit(False)).alias("is_shared"))


@query(f"SELECT {SQL_PROVIDER} AS provider, count(DISTINCT id) AS acquisitions, CAST(sum(source_count) AS BIGINT) AS sources FROM (SELECT DISTINCT * FROM acquisitions) GROUP BY 1")
def provider_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "acquisitions").distinct()
    return rows.groupBy(provider_key(F.col("provider")).alias("provider")).agg(F.count_distinct("id").alias("acquisitions"), F.sum("source_count").alias("sources"))


@query("""
    SELECT campaign_id, pair_sha256, list_sort(list_distinct(list(regexp_replace(lower(trim(decision)), '[^a-z]+', '_', 'g')))) AS words FROM duplicate_decisions
    GROUP BY 1, 2 HAVING count(DISTINCT regexp_replace(lower(trim(decision)), '[^a-z]+', '_', 'g')) > 1""")
def decision_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs that one campaign decided in two ways, which a ledger of immutable decisions must refuse."""
    word = F.regexp_replace(F.lower(F.trim("decision")), "[^a-z]+", "_")
    found = table(spark, folder, "duplicate_decisions").groupBy("campaign_id", "pair_sha256").agg(F.array_sort(F.collect_set(word)).alias("words"))
    return found.filter(F.size("words") > 1)
