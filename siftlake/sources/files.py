"""JSONL, CSV, JSON, XML and document files."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SECTIONS = ("article-title", "abstract", "sec", "p", "table-wrap")
XML_LIMIT = 100 * 1024 * 1024


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; blank lines are skipped, anything else that isn't an object fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of text under a header; quotes are doubled, cells may hold line breaks."""
    return spark.read.schema(", ".join(f"`{c}` string" for c in columns)).csv(path, header=True, quote='"', escape='"', multiLine=True)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Local files with their size and SHA-256."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def parse_document(content: bytes | None, limit: int = XML_LIMIT) -> tuple[ET.Element | None, str | None]:
    """A document's root, or why it is refused: ``empty``, ``too_large``, ``entities`` (entities or a document type of its own) or ``unreadable``."""
    if not content:
        return None, "empty"
    if len(content) > limit:
        return None, "too_large"
    if b"<!ENTITY" in content or b"<!DOCTYPE" in content.replace(b"<!DOCTYPE article", b"").replace(b"<!DOCTYPE PubmedArticleSet", b""):
        return None, "entities"
    try:
        return ET.fromstring(content), None
    except ET.ParseError:
        return None, "unreadable"


def _parse(content: bytes | None) -> ET.Element | None:
    return parse_document(content)[0]


def refused_documents(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """``path, reason`` of the XML files that no reader takes; ``root`` names the element they must begin with (``wrong_root`` otherwise).

    Files without a byte aren't listed: Spark's scan of files skips them.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, reason = parse_document(content)
                if found is not None and root and found.tag.rpartition("}")[2] != root:
                    reason = "wrong_root"
                if reason:
                    out.append((name, reason))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in range(2)], names=["path", "reason"])

    return files.mapInArrow(run, "path string, reason string")


def fetched_document(spark: SparkSession, path: str, expected_sha256: str) -> DataFrame:
    """A captured full text bound to its hash: ``path, length, sha256, root``; a file with another hash or a refused one is an error."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "content", F.sha2("content", 256).alias("sha256"))

    @F.udf("string")
    def told(content: bytes | None) -> str:
        found, reason = parse_document(bytes(content) if content is not None else None)
        return f"!{reason}" if found is None else found.tag.rpartition("}")[2]

    seen = files.select("path", "length", "sha256", told("content").alias("root"))
    wrong = (F.col("sha256") != expected_sha256) | F.startswith("root", F.lit("!"))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("not the document that was fetched: "), "path", F.lit(" "), "root"))).otherwise(F.col("root"))
    return seen.withColumn("root", checked)


def _text(node: ET.Element) -> str:
    return " ".join("".join(node.itertext()).split())


def pmc_sections(spark: SparkSession, path: str) -> DataFrame:
    """Full-text XML as ``path, locator, tag, text``: five kinds of elements in document order, each text once."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                root = _parse(content)
                if root is None or root.tag.rpartition("}")[2] != "article":
                    continue
                counts: dict[str, int] = {}
                seen: set[str] = set()
                for node in root.iter():
                    tag = node.tag.rpartition("}")[2] if isinstance(node.tag, str) else ""
                    if tag in SECTIONS:
                        counts[tag] = counts.get(tag, 0) + 1
                        text = _text(node)
                        if text and text not in seen:
                            seen.add(text)
                            out.append((name, f"xml:{tag}[{counts[tag]}]", tag, text))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in range(4)], names=["path", "locator", "tag", "text"])

    return files.mapInArrow(run, "path string, locator string, tag string, text string")


def pubmed_abstracts(spark: SparkSession, path: str) -> DataFrame:
    """Abstract batches as ``pmid, abstract, row_sha256``: labelled parts become ``LABEL: text``, ids in numeric order."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for content in batch.column(1).to_pylist():
                root = _parse(content)
                for article in root.iter("PubmedArticle") if root is not None else ():
                    pmid = article.findtext(".//PMID")
                    parts = [f"{p.get('Label')}: {_text(p)}" if p.get("Label") else _text(p) for p in article.iter("AbstractText")]
                    if pmid:
                        out.append((pmid.strip(), " ".join(x for x in parts if x) or None))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in range(2)], names=["pmid", "abstract"])

    rows = files.mapInArrow(run, "pmid string, abstract string")
    own = F.to_json(F.struct("abstract", "pmid"), {"ignoreNullFields": "false"})
    return rows.withColumn("row_sha256", F.sha2(own, 256)).orderBy(F.col("pmid").cast("bigint"))
