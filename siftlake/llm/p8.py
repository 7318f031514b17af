"""Queries of problem 8: three mixes of the corpus."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.llm import mixing
from siftlake.session import bounded, table

#: A table of targets is configuration; a longer one is an error.
MOST_TARGETS = 100_000


def mixed(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str], list[mixing.Mix]]:
    """Copies of each document in each mix, the domains' names and the mixes."""
    columns = ["mix_id", "source", "target_share", "max_repeats"]
    targets = pd.DataFrame(bounded(table(spark, folder, "mixture_targets").select(*columns).dropna().distinct(), MOST_TARGETS), columns=columns)
    members, names = mixing.memberships(table(spark, folder, "documents"), "doc_id", "text", "source")
    mixes = mixing.read_mixes(targets, names)
    moves = mixing.fit_rates(members, names, mixes)
    return mixing.copies(members, names, mixes, moves), names, mixes


def p8_copies(spark: SparkSession, folder: str) -> DataFrame:
    """``mix_id, doc_id, copies``: the mixes themselves."""
    return mixed(spark, folder)[0].select("mix_id", F.col("key").alias("doc_id"), "copies")


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target, expected and reached share of each source of each mix; a source without documents reaches 0.

    ``expected_share`` is that of the expected tokens under the fitted rates and soft memberships, ``reached_share`` that of the whole copies by label.
    """
    rows, names, mixes = mixed(spark, folder)
    reached = rows.groupBy("mix_id", "label").agg(
        F.count("*").alias("documents"), F.sum("copies").alias("copies"), F.max("copies").alias("most_repeats"), F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens")
    )
    place = {n: i for i, n in enumerate(names)}
    of = lambda values, s: float(values[place[s]]) if s in place else 0.0
    asked = [
        (m.mix_id, place.get(s), s, share / max(sum(x for x, _ in m.asked.values()), 1e-12), of(m.share, s), of(m.expected / max(m.expected.sum(), 1e-12), s), most)
        for m in mixes
        for s, (share, most) in sorted(m.asked.items())
    ]
    plan = spark.createDataFrame(asked, "mix_id int, label int, source string, target_share double, available_share double, expected_share double, max_repeats int")
    whole = reached.groupBy("mix_id").agg(F.sum("tokens").alias("mix_tokens"))
    zero = F.lit(0).cast("bigint")
    return plan.join(reached, ["mix_id", "label"], "left").join(whole, "mix_id", "left").select(
        "mix_id", "source", "target_share", "available_share", "expected_share", "max_repeats",
        F.coalesce("documents", zero).alias("documents"), F.coalesce("copies", zero).alias("copies"), F.coalesce(F.col("most_repeats"), F.lit(0)).alias("most_repeats"),
        F.coalesce("tokens", zero).alias("tokens"), F.coalesce(F.col("tokens") / F.col("mix_tokens"), F.lit(0.0)).alias("reached_share"),
    )
