"""Queries of problem 9 on the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftlake.llm.splitting import split_documents
from siftlake.session import bounded, table


def settings(spark: SparkSession, folder: str) -> list[tuple[int, int, int]]:
    """The rows of ``split_settings``, a table of fixed size; more than 1000 are an error."""
    rows = bounded(table(spark, folder, "split_settings").select("setting_id", "max_tokens", "overlap_tokens").distinct(), 1000)
    return sorted((r.setting_id, r.max_tokens, r.overlap_tokens) for r in rows)


def p9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """All pieces under every setting."""
    return split_documents(table(spark, folder, "documents"), "doc_id", "text", settings(spark, folder))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that setting 1 cuts: those that have a second piece."""
    own = [s for s in settings(spark, folder) if s[0] == 1]
    cut = split_documents(table(spark, folder, "documents"), "doc_id", "text", own, with_text=False)
    return cut.filter("piece_no = 2").select("doc_id")
