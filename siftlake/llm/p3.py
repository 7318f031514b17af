"""Queries of problem 3 on the ledger's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.llm.boruvka import boruvka_components
from siftlake.session import table

#: ``duplicate_decisions.decision`` without case, blanks and punctuation.
SAME = "samestudy"


def same_study_links(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of canonical identities that some campaign decided to be the same study."""
    said = F.regexp_replace(F.lower("decision"), "[^a-z]+", "")
    decided = table(spark, folder, "duplicate_decisions").filter(said == SAME).select("pair_sha256").distinct()
    pairs = table(spark, folder, "duplicate_pairs").select("pair_sha256", "left_group_id", "right_group_id").distinct()
    return pairs.join(decided, "pair_sha256", "left_semi").select("left_group_id", "right_group_id")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every identity of a group linked to another one, with the smallest identity of its component."""
    groups = boruvka_components(same_study_links(spark, folder), "left_group_id", "right_group_id")
    names = table(spark, folder, "dedup_groups").select(F.col("group_id").alias("node"), F.col("canonical_identity").alias("identity_key")).distinct()
    named = groups.join(names, "node").select("component", "identity_key").distinct()
    keys = named.groupBy("component").agg(F.min("identity_key").alias("component_key"), F.count("*").alias("members"))
    return named.join(keys.filter("members > 1"), "component").select("identity_key", "component_key")
