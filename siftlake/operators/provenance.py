"""Which query of a campaign an acquisition came from, and the older lookup by the question alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALUE = ("query_id", "negative_control", "compiled")


def lookup_rows(questions: DataFrame, compiled: DataFrame) -> DataFrame:
    """``provider, expression, maximum`` with the query they stand for: a campaign's questions serve any provider (null), compiled expressions their own.

    ``questions`` are ``query_id, expression, maximum, negative_control``, ``compiled`` the same with ``provider``.  Rows said twice count once.
    """
    plain = questions.select(F.lit(None).cast("string").alias("provider"), "expression", "maximum", "query_id", "negative_control", F.lit(False).alias("compiled"))
    return plain.unionByName(compiled.select("provider", "expression", "maximum", "query_id", "negative_control", F.lit(True).alias("compiled"))).distinct()


def ambiguous(lookup: DataFrame) -> DataFrame:
    """Keys of a lookup that stand for more than one query; a campaign must have none."""
    return lookup.groupBy("provider", "expression", "maximum").agg(F.count("*").alias("queries")).filter("queries > 1").drop("queries")


def trace_queries(requests: DataFrame, lookup: DataFrame) -> DataFrame:
    """``requests`` (``provider, expression, maximum`` and others) with ``query_id, negative_control, compiled``.

    Four keys are tried in turn: provider, expression and maximum; any provider; any maximum; neither.  A key without the maximum counts only where all its
    rows stand for one query.  What none of them finds is ``unmapped``.  An ambiguous full key is an error.
    """
    value = F.struct(*VALUE).alias("v")
    full = lookup.groupBy("provider", "expression", "maximum").agg(F.collect_set(value).alias("s")).select(
        "provider", "expression", "maximum", F.when(F.size("s") == 1, F.get("s", F.lit(0))).otherwise(F.raise_error(F.concat(F.lit("query provenance is ambiguous for "), "expression"))).alias("v")
    )
    loose = lookup.groupBy("provider", "expression").agg(F.collect_set(value).alias("s")).filter(F.size("s") == 1).select("provider", "expression", F.get("s", F.lit(0)).alias("v"))
    parts = (
        (full.filter("provider is not null"), ["provider", "expression", "maximum"]), (full.filter("provider is null").drop("provider"), ["expression", "maximum"]),
        (loose.filter("provider is not null"), ["provider", "expression"]), (loose.filter("provider is null").drop("provider"), ["expression"]),
    )
    found = requests
    for level, (part, keys) in enumerate(parts):
        found = found.join(part.withColumnRenamed("v", f"_v{level}"), keys, "left")
    first: Column = F.coalesce(*(F.col(f"_v{k}") for k in range(4)), F.struct(F.lit("unmapped").alias("query_id"), F.lit(False).alias("negative_control"), F.lit(False).alias("compiled")))
    return found.withColumn("_v", first).select(*requests.columns, *(F.col(f"_v.{c}").alias(c) for c in VALUE))


def trace_questions(requests: DataFrame, questions: DataFrame) -> DataFrame:
    """The older lookup: ``requests`` with ``query_id, phase`` of the question they ask, ``unmapped`` and 0 where it isn't asked.

    ``questions`` are ``expression, query_id, phase``; of a question asked by two queries the last id counts.
    """
    last = questions.groupBy("expression").agg(F.max(F.struct("query_id", "phase")).alias("q"))
    found = requests.join(last, "expression", "left")
    return found.select(*requests.columns, F.coalesce("q.query_id", F.lit("unmapped")).alias("query_id"), F.coalesce("q.phase", F.lit(0)).alias("phase"))
