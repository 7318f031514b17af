"""Sinks: canonical JSONL, CSV in three dialects, reports and receipts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlake.functions.normalise import canonical_json
from siftlake.session import bounded


def write_jsonl(df: DataFrame, path: str) -> None:
    """One canonical JSON object a line (sorted keys, nulls kept)."""
    whole = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    df.select(canonical_json(whole).alias("value")).write.mode("errorifexists").text(path)


def _cell(df: DataFrame, name: str, dialect: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.ArrayType) and dialect == "pipe":
        return F.array_join(name, "|").alias(name)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return canonical_json(F.to_json(name)).alias(name)
    return F.col(name).cast("string").alias(name)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, dialect: str = "json") -> None:
    """CSV with a header; lists and objects as canonical JSON or joined by ``|``; columns not named are ignored."""
    df.select(*(_cell(df, c, dialect) for c in columns or df.columns)).write.mode("errorifexists").csv(path, header=True, quote='"', escape='"', lineSep="\n")


def receipt(spark: SparkSession, path: str) -> DataFrame:
    """Files of an artifact with bytes and SHA-256, and the hash over all of them in the order of their names."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", F.sha2("content", 256).alias("sha256"))
    return files.filter(~F.col("file").startswith("_"))


def verify(spark: SparkSession, path: str, receipts: DataFrame) -> DataFrame:
    """Files whose content differs from their receipt, or that are missing on either side."""
    now = receipt(spark, path).select("file", F.col("sha256").alias("now"))
    return receipts.join(now, "file", "full").filter(~F.col("now").eqNullSafe(F.col("sha256")))


def write_json(report: dict, path: str) -> None:
    """A one-row report as an indented JSON file."""
    with open(path, "x", encoding="utf-8") as file:
        json.dump(report, file, sort_keys=True, ensure_ascii=False, indent=2)
        file.write("\n")


def escape_markdown(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\`*_{}\[\]<>()#+!|-])", r"\\$1")


def write_markdown(title: str, rows: DataFrame, path: str, limit: int = 1000) -> None:
    """A report as a Markdown table; one of more than ``limit`` rows is an error, never cut off."""
    cells = bounded(rows.select(*(escape_markdown(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in rows.columns)), limit)
    with open(path, "x", encoding="utf-8") as file:
        file.write(f"# {title}\n\n| {' | '.join(rows.columns)} |\n|{'---|' * len(rows.columns)}\n")
        file.writelines(f"| {' | '.join(r)} |\n" for r in cells)
