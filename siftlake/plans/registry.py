"""All queries of the core by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftlake.plans import dedup_queries, ledger_queries, nested_queries, screening_queries

MODULES = (dedup_queries, screening_queries, ledger_queries, nested_queries)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_queries.screening_counts(spark, folder)
