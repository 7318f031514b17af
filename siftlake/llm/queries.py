"""All corpus queries by name, and the SQL of those that SQL can state."""

from __future__ import annotations

from siftlake.llm import p1, p2, p3, p4, p5, p7, p8, p9
from siftlake.llm.p4 import PLACEHOLDERS

QUERIES = {
    f.__name__: f
    for f in (
        p1.p1_found, p1.p1_groups, p2.p2_found, p2.p2_reasons, p3.p3_found,
        p4.p4_found, p4.p4_fused, p4.p4_sources, p5.p5_found, p5.p5_confidences,
        p7.p7_found, p7.p7_leaks, p7.p7_items, p8.p8_shares, p8.p8_copies, p9.p9_found, p9.p9_pieces,
    )
}

WORDS = "regexp_extract_all(lower(strip_accents(replace({}, 'ﬁ', 'fi'))), '[a-z0-9]+')"
PLAIN = "replace(replace({}, '&amp;', '&'), '&#37;', '%')"
#: Every pair of records by comparing all their word sets: plain, quadratic and independent of the operator.
PAIRS = f"""
    rec AS (SELECT DISTINCT id, acquisition_id, title, doi, identity_key, raw_json ->> '$.abstract' AS abstract FROM source_records),
    sets AS (SELECT id, list_distinct({WORDS.format(PLAIN.format("title || ' ' || abstract"))}) AS w FROM rec WHERE trim(abstract) <> ''),
    pair AS (SELECT a.id AS id_a, b.id AS id_b FROM sets a JOIN sets b ON a.id < b.id AND 10 * len(a.w) >= 7 * len(b.w) AND 10 * len(b.w) >= 7 * len(a.w)
        WHERE 17 * len(list_intersect(a.w, b.w)) >= 7 * (len(a.w) + len(b.w)))"""
IDENTITY = """lower(regexp_extract(trim({0}), '^([A-Za-z_]+):', 1)) || ':' || regexp_replace(regexp_replace(regexp_replace(lower(trim(replace(replace(regexp_replace(trim({0}), '^[A-Za-z_]+:', ''), '%2F', '/'), '%2f', '/'))),
        '^(\\s|(doi|pmid|pubmed)\\s*:|https?://[^/\\s]+/)+', ''), '[\\s.,;:]+$', ''), '^0+([0-9]+)$', '\\1')"""
LINKED = """
    both_ways AS (SELECT {a} AS a, {b} AS b FROM {t} UNION SELECT {b}, {a} FROM {t}),
    reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, e.b FROM reach JOIN both_ways e ON reach.b = e.a)"""
REPEATS = f"""
        WITH {PAIRS},
        bat AS (SELECT DISTINCT id AS acquisition_id, response_sha256, CAST(observed_at AS TIMESTAMPTZ) AS t FROM acquisitions),
        shared AS (SELECT {IDENTITY.format('identity_key')} AS i FROM shared_identifiers),
        led AS (SELECT id, {IDENTITY.format('identity_key')} AS i, t, response_sha256 FROM rec JOIN bat USING (acquisition_id)),
        r AS (SELECT response_sha256, min(t) AS t FROM bat GROUP BY 1), n AS (SELECT i, min(t) AS t FROM led WHERE i NOT IN (SELECT i FROM shared) GROUP BY 1),
        near AS (SELECT id_a AS x, id_b AS y FROM pair UNION ALL SELECT id_b, id_a FROM pair),
        c AS (SELECT x, min(led.t) AS t FROM near JOIN led ON led.id = y GROUP BY x)"""
REPEAT_JOINS = "led LEFT JOIN r USING (response_sha256) LEFT JOIN n USING (i) LEFT JOIN c ON c.x = led.id"
ORACLES: dict[str, str] = {
    "p1_found": f"WITH {PAIRS} SELECT id_a, id_b FROM pair",
    "p1_groups": f"""
        WITH RECURSIVE {PAIRS}, {LINKED.format(a='id_a', b='id_b', t='pair')}
        SELECT id AS source_record_id, coalesce(min(reach.b), id) AS group_key, (SELECT count(*) FROM both_ways w WHERE w.a = id) AS links FROM sets LEFT JOIN reach ON reach.a = id GROUP BY id""",
    "p2_found": f"""{REPEATS} SELECT led.id AS source_record_id FROM {REPEAT_JOINS} WHERE r.t < led.t OR n.t < led.t OR c.t < led.t""",
    "p2_reasons": f"""{REPEATS} SELECT led.id AS source_record_id, bool_or(coalesce(r.t < led.t, false)) AS by_response, bool_or(coalesce(n.t < led.t, false)) AS by_identity,
        bool_or(coalesce(c.t < led.t, false)) AS by_content FROM {REPEAT_JOINS} GROUP BY led.id""",
    "p3_found": f"""
        WITH RECURSIVE link AS (SELECT DISTINCT left_group_id AS l, right_group_id AS r FROM duplicate_pairs WHERE pair_sha256 IN
            (SELECT pair_sha256 FROM duplicate_decisions WHERE regexp_replace(lower(decision), '[^a-z]', '', 'g') = 'samestudy')),
        {LINKED.format(a='l', b='r', t='link')},
        named AS (SELECT g.canonical_identity AS identity_key, h.canonical_identity AS other FROM reach JOIN dedup_groups g ON g.group_id = a JOIN dedup_groups h ON h.group_id = b)
        SELECT identity_key, min(other) AS component_key FROM named GROUP BY 1 HAVING count(DISTINCT other) > 1""",
    "p4_found": f"""
        WITH RECURSIVE {PAIRS}, {LINKED.format(a='id_a', b='id_b', t='pair')},
        grp AS (SELECT a AS id, min(b) AS group_key FROM reach GROUP BY a),
        bat AS (SELECT DISTINCT id AS acquisition_id, regexp_replace(lower(trim(provider)), '[^a-z0-9]+', '_', 'g') AS provider, CAST(observed_at AS TIMESTAMPTZ) AS t FROM acquisitions),
        shared AS (SELECT {IDENTITY.format('identity_key')} AS i FROM shared_identifiers),
        val AS (SELECT group_key, rec.id, coalesce(preference, 99) AS p, t, title, doi FROM grp JOIN rec USING (id) JOIN bat USING (acquisition_id) LEFT JOIN provider_preference USING (provider)),
        use AS (SELECT group_key, 'title' AS field, id, p, t FROM val WHERE title IS NOT NULL AND trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) NOT IN ({', '.join(f"'{x}'" for x in PLACEHOLDERS)})
                AND NOT regexp_matches(title, '(\\.\\.\\.|…)\\s*$')
            UNION ALL SELECT group_key, 'doi', id, p, t FROM val WHERE trim(doi) <> '' AND {IDENTITY.format("('doi:' || doi)")} NOT IN (SELECT i FROM shared))
        SELECT group_key, field, arg_min(id, (p, -epoch_us(t), id)) AS source_record_id FROM use GROUP BY ALL""",
    # A subword token of such texts spells about four bytes, and no text is near the limit.
    "p9_found": "SELECT DISTINCT doc_id FROM documents JOIN split_settings ON setting_id = 1 WHERE strlen(text) > 4 * max_tokens",
    "p7_found": f"""
        WITH d AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents WHERE text IS NOT NULL),
        i AS (SELECT item_id, {WORDS.format('passage')} AS w FROM eval_items WHERE passage IS NOT NULL),
        ds AS (SELECT DISTINCT doc_id, array_to_string(w[k:k+11], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d)),
        seeds AS (SELECT DISTINCT item_id, array_to_string(w[k:k+11], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i))
        SELECT DISTINCT doc_id, item_id FROM ds JOIN seeds USING (s)
    """,
}
