"""Queries of problem 7: evaluation items in the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.llm.tiling import leaked_passages
from siftlake.session import table

#: A run of so many words leaks an item; so does a passage covered to this share by shorter tiles.
LEAK_RUN = 12
LEAK_COVERAGE = 0.5


def _tiles(spark: SparkSession, folder: str, width: int) -> DataFrame:
    return leaked_passages(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "passage", width)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs whose longest tile has at least ``LEAK_RUN`` words."""
    return _tiles(spark, folder, LEAK_RUN).filter(F.col("longest") >= LEAK_RUN).select("doc_id", "item_id")


def p7_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs by run or coverage, reordered passages included, with their figures."""
    return _tiles(spark, folder, 6).filter((F.col("longest") >= LEAK_RUN) | (F.col("coverage") >= LEAK_COVERAGE))


def p7_items(spark: SparkSession, folder: str) -> DataFrame:
    """Every leaked item with the number of documents that hold it."""
    return p7_leaks(spark, folder).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("longest").alias("longest"), F.max("coverage").alias("coverage"))
