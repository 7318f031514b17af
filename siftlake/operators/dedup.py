"""Canonical records, exact deduplication, golden records, fuzzy pairs and human merge decisions."""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlake.functions import normalise as N
from siftlake.functions.records import record_fields
from siftlake.operators.components import connected_components
from siftlake.operators.nested import provider_key
from siftlake.session import stage

#: Providers in the order of trust; others come last.
PREFERENCE = ("europe_pmc", "pubmed", "clinical_trials", "semantic_scholar", "openalex", "crossref", "unpaywall", "elicit", "local_file")
LEAST_TITLE = 20
FUZZY = 0.94
#: A rounded ratio may lie this much below its threshold before rounding.
SLACK = 1e-6
PARITIES = ("p0", "p1", "p2", "p3")
RAW = "abstract string, venue string, isOpenAccess string, doi string, pmid string, nctId string, year string"


def canonical_records(records: DataFrame, acquisitions: DataFrame) -> DataFrame:
    """Source records joined with their acquisition and projected to one set of normalised columns.

    Rows delivered twice count once; a record without its acquisition is left out (inner join on the foreign key).
    """
    batch = acquisitions.select(
        F.col("id").alias("acquisition_id"), provider_key(F.col("provider")).alias("provider"), "endpoint", "observed_at",
        F.get_json_object("request_json", "$.query").alias("query"), F.get_json_object("request_json", "$.maxResults").cast("int").alias("max_results"),
    ).dropDuplicates(["acquisition_id"])
    flat = records.dropDuplicates(["id"]).withColumn("raw", F.from_json("raw_json", RAW)).withColumn("told", record_fields("raw_json")).join(batch, "acquisition_id")
    own = lambda column, field: F.coalesce(F.when(F.trim(F.col(column).cast("string")) != "", F.col(column).cast("string")), F.col(f"raw.{field}"))
    doi, pmid = N.normalise_doi(own("doi", "doi")), N.normalise_identifier(F.regexp_replace(own("pmid", "pmid"), "(?i)^pmid:\\s*", ""), N.PMID)
    urls, types = F.col("told.urls"), F.col("told.publication_types")
    pmcid = N.normalise_identifier(F.col("told.pmcid"), N.PMCID, upper=True)
    return flat.select(
        F.col("id").alias("source_record_id"), "acquisition_id", "provider", "endpoint", "kind", "query", "max_results", "observed_at",
        N.normalise_text(F.col("title")).alias("title"), N.normalise_title(F.col("title")).alias("normalised_title"),
        N.normalise_text(F.col("raw.abstract")).alias("abstract"), N.normalise_year(own("year", "year")).alias("year"), doi.alias("doi"), pmid.alias("pmid"), pmcid.alias("pmcid"),
        N.normalise_identifier(own("nct_id", "nctId"), N.NCT, upper=True).alias("nct_id"), F.col("told.authors").alias("authors"),
        F.col("raw.venue").alias("venue"), urls.alias("urls"), types.alias("publication_types"),
        N.open_access(pmcid, F.col("raw.isOpenAccess"), urls).alias("open_access_candidate"),
        N.retracted(N.retraction_flags(F.col("raw_json")), F.col("title"), types).alias("retracted"), "retrieved_at", "raw_sha256",
    )


def exact_tokens(records: DataFrame, legacy: bool = False) -> DataFrame:
    """``(source_record_id, token)``: identifiers, and title with year where the title is long enough.

    ``legacy``: the older set of tokens, without pmcid.
    """
    long_title = F.length("normalised_title") >= LEAST_TITLE
    year = F.coalesce(F.col("year").cast("string"), F.lit("unknown"))
    parts = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}:"), F.lower(c))) for c in ("doi", "pmid", "pmcid", "nct_id") if not (legacy and c == "pmcid")]
    parts.append(F.when(long_title, F.concat(F.lit("title-year:"), "normalised_title", F.lit(":"), year)))
    return records.select("source_record_id", F.explode(F.array_compact(F.array(*parts))).alias("token"))


def exact_deduplicate(records: DataFrame, tokens: DataFrame) -> DataFrame:
    """``(source_record_id, component)``: records linked by common tokens, directly or through others.

    A token's records are joined as a star around its smallest one, so a token on a third of all rows adds as many edges as
    rows and no pairs.
    """
    centre = tokens.groupBy("token").agg(F.min("source_record_id").alias("centre"), F.max("source_record_id").alias("last")).filter("centre < last")
    edges = tokens.join(centre, "token").filter("source_record_id <> centre").select("source_record_id", "centre")
    found = connected_components(records, edges, "source_record_id", "source_record_id", "centre")
    return found.withColumnRenamed("node", "source_record_id")


def preference(provider: Column) -> Column:
    ranks = F.create_map(*(F.lit(x) for i, p in enumerate(PREFERENCE) for x in (p, i)))
    return F.coalesce(F.try_element_at(ranks, provider), F.lit(99))


def golden_records(records: DataFrame, components: DataFrame) -> DataFrame:
    """One row per component: per field the first non-empty value by trust, abstract at hand, id; unions and flags.

    All aggregates combine before the shuffle; only the sorted unions of ids, providers and addresses grow with a group.
    """
    rank = F.struct(preference(F.col("provider")).alias("p"), F.col("abstract").isNull().alias("a"), F.col("source_record_id").alias("i"))

    def first(column: str) -> Column:
        return F.min_by(F.col(column), F.when(F.col(column).isNotNull() & (F.col(column).cast("string") != ""), rank)).alias(column)

    def union(column: str, name: str) -> Column:
        return F.array_sort(F.collect_set(column)).alias(name)

    def flat_union(column: str) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.collect_set(column)))).alias(column)

    grouped = records.drop("component").join(components.select("source_record_id", "component"), "source_record_id").groupBy("component").agg(
        *(first(c) for c in ("title", "normalised_title", "abstract", "year", "doi", "pmid", "pmcid", "nct_id")),
        F.min_by("authors", F.when(F.size("authors") > 0, rank)).alias("authors"),
        union("provider", "providers"), union("source_record_id", "source_record_ids"), flat_union("urls"), flat_union("publication_types"),
        F.bool_or("open_access_candidate").alias("open_access_candidate"), F.bool_or("retracted").alias("retracted"),
        F.min_by("source_record_id", rank).alias("preferred_source_record_id"), F.count("*").alias("retrieval_record_count"),
        *(F.bool_and(c).alias(c) for c in ("negative_control",) if c in records.columns), *(F.bool_or(c).alias(c) for c in ("compiled",) if c in records.columns),
        *(union(c, f"{c}_set") for c in ("doi", "pmid", "pmcid", "nct_id")),
    )
    identity = F.coalesce(
        F.concat(F.lit("doi:"), "doi"), F.concat(F.lit("pmid:"), "pmid"), F.concat(F.lit("pmcid:"), F.lower("pmcid")), F.concat(F.lit("nct:"), F.lower("nct_id")),
        F.concat(F.lit("title-year:"), F.coalesce("normalised_title", F.lit("")), F.lit(":"), F.coalesce(F.col("year").cast("string"), F.lit("unknown"))),
    )
    named = grouped.withColumn("canonical_identity", identity)
    own = F.to_json(F.struct("canonical_identity", "source_record_ids"))
    return named.withColumn("group_id", F.sha2(own, 256)).withColumn("authors", F.coalesce("authors", F.array().cast("array<string>")))


def common_letters(left: str, right: str) -> int:
    """Length of the longest common subsequence, a row of bits at a time; no matching blocks hold more letters."""
    at: dict[str, int] = {}
    for i, c in enumerate(left):
        at[c] = at.get(c, 0) | 1 << i
    row = every = (1 << len(left)) - 1
    for c in right:
        met = row & at.get(c, 0)
        row = (row + met | row - met) & every
    return len(left) - row.bit_count()


@F.pandas_udf(T.DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series, least: pd.Series) -> pd.Series:
    """Ratio of matching blocks, rounded as Python rounds; the order of the arguments matters.  Null where the letters in common show that it is under ``least``."""

    def one(a: str, b: str, bound: float) -> float | None:
        if a == b:
            return 1.0
        if 2 * common_letters(a, b) < (bound - SLACK) * (len(a) + len(b)):
            return None
        return round(SequenceMatcher(None, a, b, autojunk=False).ratio(), 6)

    return pd.Series([one(*x) for x in zip(left, right, least)], dtype="float64")


@F.pandas_udf(T.StructType([T.StructField(p, T.LongType()) for p in PARITIES]))
def bigram_parities(titles: pd.Series) -> pd.DataFrame:
    """256 bits: which of as many classes of bigrams stand in a title an odd number of times.  A letter put in or taken out changes 3 of them at most."""
    rows = []
    for title in titles:
        bits = 0
        for x, y in zip(title, title[1:]):
            bits ^= 1 << (31 * ord(x) + ord(y)) % 256
        rows.append(bits.to_bytes(32, "little"))
    return pd.DataFrame(np.frombuffer(b"".join(rows), "<i8").reshape(-1, 4), columns=[*PARITIES])


def met_pairs(side: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a``, ``b`` of titles that can reach the threshold and whose authors agree; ``a`` has the smaller id.

    Two groups with an author meet by year and author.  One without an author meets all of its year whose lengths are near enough, by
    classes of length: lengths up to ``longest`` times each other lie two classes apart at most.
    """
    longest = 2 / (threshold - SLACK) - 1
    step = math.log(longest * 1.0001) / 2
    own, known = F.floor(F.log(F.col("size").cast("double")) / step), F.col("author").isNotNull()
    name, of = F.concat(F.lit("author:"), F.col("author")), lambda c: F.concat(F.lit("size:"), c.cast("string"))
    near = F.array(*(of(own + i) for i in range(-2, 3)))
    a = side.withColumn("key", F.explode(F.when(known, F.array(name)).otherwise(near)))
    b = side.withColumn("key", F.explode(F.when(known, F.array(name, of(own))).otherwise(F.array(of(own)))))
    a, b = (x.select(*(F.col(c).alias(f"{n}_{c}") for c in x.columns)) for n, x in (("a", a), ("b", b)))
    total = F.col("a_size") + F.col("b_size")
    apart = sum((F.bit_count(F.col(f"a_{p}").bitwiseXOR(F.col(f"b_{p}"))) for p in PARITIES), F.lit(0))
    once = (F.col("a_group_id") < F.col("b_group_id")) | (F.col("a_author").isNull() & F.col("b_author").isNotNull())
    met = a.join(
        b,
        F.col("a_year").eqNullSafe(F.col("b_year")) & (F.col("a_key") == F.col("b_key")) & (apart <= 3 * (1 - threshold + SLACK) * total)
        & (2 * F.least("a_size", "b_size") >= (threshold - SLACK) * total) & once,
    )
    ends = F.array_sort(F.array(*(F.struct(F.col(f"{n}_group_id").alias("group_id"), F.col(f"{n}_title").alias("title")) for n in "ab")))
    return met.select(F.col("a_year").alias("year"), ends.alias("ends")).select("year", F.col("ends")[0].alias("a"), F.col("ends")[1].alias("b"))


def possible_duplicate_pairs(groups: DataFrame, threshold: float = FUZZY) -> DataFrame:
    """Pairs of groups of one year (null is a year of its own) with nearly the same title and no contradicting first author.

    Before titles are compared, bounds drop pairs that cannot reach the threshold: the shorter title's length, the bigrams that titles
    don't share, and the letters both have in common in one order.  Titles under ``LEAST_TITLE`` letters form no pairs.
    """
    if not 0.8 <= threshold <= 1:
        raise ValueError("the threshold of possible duplicates must be 0.8 to 1")
    side = groups.filter(F.length("normalised_title") >= LEAST_TITLE).select(
        "group_id", "year", F.col("normalised_title").alias("title"), N.normalise_title(F.try_element_at("authors", F.lit(1))).alias("author")
    )
    side = side.withColumn("author", F.nullif("author", F.lit(""))).withColumn("size", F.length("title")).withColumn("parities", bigram_parities("title"))
    met = met_pairs(stage(side.select("*", "parities.*").drop("parities"), "titles"), threshold)
    close = met.withColumn("title_similarity", sequence_ratio("a.title", "b.title", F.lit(threshold)))
    return close.filter(F.col("title_similarity") >= threshold).select(
        F.col("a.group_id").alias("left_group_id"), F.col("b.group_id").alias("right_group_id"), "year", "title_similarity",
        F.lit(True).alias("first_author_compatible"), F.lit("manual_review_required").alias("disposition"), F.lit(False).alias("auto_merged"),
    )


def latest_decisions(pairs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every listed pair with its decision: one of ``same_study``, ``different_study``, ``uncertain`` or null (undecided).

    ``same_study`` in any campaign wins, then ``different_study``.
    """
    word = F.regexp_replace(F.lower(F.trim("decision")), "[^a-z]+", "_")
    said = decisions.select("pair_sha256", word.alias("word")).groupBy("pair_sha256").agg(
        F.min(F.when(F.col("word") == "same_study", 0).when(F.col("word") == "different_study", 1).otherwise(2)).alias("best")
    )
    words = F.when(F.col("best") == 0, "same_study").when(F.col("best") == 1, "different_study").when(F.col("best") == 2, "uncertain")
    return pairs.join(said, "pair_sha256", "left").withColumn("decision", words).drop("best")


def merge_decided(groups: DataFrame, decided: DataFrame) -> DataFrame:
    """``(group_id, merged_group)``: groups joined by ``same_study`` decisions, transitively."""
    same = decided.filter("decision = 'same_study'")
    found = connected_components(groups, same, "group_id", "left_group_id", "right_group_id")
    return found.select(F.col("node").alias("group_id"), F.col("component").alias("merged_group"))
