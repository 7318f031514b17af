"""Queries of problem 4: the surviving values of each group of near-duplicate records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.functions.identifiers import bare_identifier, identity_form
from siftlake.llm import fusion, jaccard
from siftlake.llm.p1 import near_duplicates
from siftlake.llm.p2 import instant
from siftlake.operators.nested import provider_key
from siftlake.session import stage, table

#: The words of titles that stand in a title's stead.
PLACEHOLDERS = (
    "", "n a", "na", "none", "null", "no title", "title pending", "title unavailable", "title not available",
    "title not provided", "not available", "pending", "unknown", "unknown title", "untitled",
)


def title_form(title: Column) -> Column:
    """A title's letters and digits in lower case, without markup; enough to tell spellings of one title apart from others."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(title), "<[^>]*>|&[a-z#0-9]+;", " "), r"[^\p{L}\p{N}]+", " ")
    return F.trim(plain)


def usable_title(title: Column) -> Column:
    """Neither null nor a placeholder nor cut off (ending in an ellipsis)."""
    return title.isNotNull() & ~title_form(title).isin(*PLACEHOLDERS) & ~title.rlike(r"(?:\.\.\.|…)\s*$")


def grouped_records(spark: SparkSession, folder: str) -> DataFrame:
    """``group_key, id`` of the records that are linked to another one."""
    pairs, members = near_duplicates(spark, folder)
    return jaccard.groups(pairs, members).filter("links > 0").select("group_key", "id")


def claims(spark: SparkSession, folder: str, fields: tuple[str, ...]) -> DataFrame:
    """The usable values of the grouped records, with the trust in and the time of their acquisition."""
    trust = table(spark, folder, "provider_preference").select(provider_key(F.col("provider")).alias("source"), "preference")
    batches = table(spark, folder, "acquisitions").select(
        F.col("id").alias("acquisition_id"), provider_key(F.col("provider")).alias("source"), instant("observed_at").alias("at")
    ).dropDuplicates(["acquisition_id"]).join(F.broadcast(trust), "source", "left")
    shared = table(spark, folder, "shared_identifiers").select(identity_form(F.col("identity_key")).alias("bad")).distinct()
    bare = F.when(F.trim("doi") != "", bare_identifier(F.col("doi")))
    records = table(spark, folder, "source_records").select(
        "id", "acquisition_id", "title", "year", "doi", "pmid", identity_form(F.concat(F.lit("doi:"), F.col("doi"))).alias("bad")
    ).dropDuplicates(["id"])
    known = records.join(F.broadcast(shared.withColumn("is_shared", F.lit(True))), "bad", "left")
    pmid = bare_identifier(F.col("pmid"))
    every = {
        "title": (F.when(usable_title(F.col("title")), title_form(F.col("title"))), F.col("title")),
        "doi": (F.when(F.col("is_shared").isNull(), bare), F.col("doi")),
        "year": (F.col("year").cast("string"), F.col("year").cast("string")),
        "pmid": (F.when(pmid.rlike("^[1-9][0-9]*$"), pmid), F.col("pmid")),
    }
    wide = known.join(grouped_records(spark, folder), "id").join(batches, "acquisition_id", "left")
    cells = F.array(*(F.struct(F.lit(f).alias("field"), every[f][0].alias("value"), every[f][1].alias("chosen_value")) for f in fields))
    stated = wide.select("group_key", "id", "source", "preference", "at", F.explode(cells).alias("c"))
    return stated.select("group_key", "id", "source", "preference", "at", "c.*").filter("value is not null")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The claims that TESTDATA.md's order puts first: usability, then trust in the provider, then recency, then the smallest id.

    This order leaves nothing for votes to decide, so no fusion is run for it; in ``p4_fused`` votes decide.
    """
    return fusion.foremost(claims(spark, folder, ("title", "doi")))


def p4_fused(spark: SparkSession, folder: str) -> DataFrame:
    """The values of maximum posterior of each group under a mild prior, with the record that gives each."""
    return fusion.survivors(stage(claims(spark, folder, ("title", "doi", "year", "pmid")), "claims")).drop("log_posterior")


def p4_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Estimated accuracy of each provider and the most probable copying it takes part in."""
    _, accuracy, copying = fusion.posteriors(claims(spark, folder, ("title", "doi", "year", "pmid")))
    rows = [(s, round(a, 6), round(max([p for pair, p in copying.items() if s in pair], default=0.0), 6)) for s, a in sorted(accuracy.items())]
    return spark.createDataFrame(rows, "provider string, accuracy double, copying double")
