"""Captured provider responses as tables: what live clients would fetch is read from files.

``read_captured`` reads whole JSON files through Spark; ``CapturedResponses`` is a Python data source over the same files
with one partition per file, for ``spark.read.format("captured").option("provider", ...)``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siftlake.functions import normalise as N

CAPTURED = "provider string, endpoint string, request_json string, response_json string, observed_at string"
PROVIDERS = ("europe_pmc", "pubmed", "semantic_scholar", "openalex", "clinical_trials", "crossref", "unpaywall", "elicit", "local_file")


def read_captured(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one object ``{provider, endpoint, request, response, observed_at}``; request and response keep their text."""
    text = spark.read.text(path, wholetext=True)
    get = lambda f: F.get_json_object("value", f"$.{f}")
    return text.select(get("provider").alias("provider"), get("endpoint").alias("endpoint"), get("request").alias("request_json"), get("response").alias("response_json"), get("observed_at").alias("observed_at"))


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[_File]:
        import glob

        return [_File(p) for p in sorted(glob.glob(f"{self.options['path'].removeprefix('file://')}/*.json"))]

    def read(self, partition: _File) -> Iterator[tuple]:
        with open(partition.path, encoding="utf-8") as file:
            body = json.load(file)
        provider = self.options.get("provider")
        if provider and body.get("provider") != provider:
            return
        text = lambda v: json.dumps(v, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
        yield body.get("provider"), body.get("endpoint"), text(body.get("request")), text(body.get("response")), body.get("observed_at")


class CapturedResponses(DataSource):
    """Captured responses by provider; an unknown provider is an error."""

    @classmethod
    def name(cls) -> str:
        return "captured"

    def schema(self) -> str:
        return CAPTURED

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001 - the interface's
        if (provider := self.options.get("provider")) and provider not in PROVIDERS:
            raise ValueError(f"unsupported provider {provider}")
        return _Reader(dict(self.options))


PAPER = "struct<title:string,authors:array<string>,year:int,doi:string,pmid:string,abstract:string,venue:string,urls:array<string>,provider_record:string>"


def _rows(raw: DataFrame, path: str) -> DataFrame:
    """The elements of a list in the raw payload, as JSON text with their rank from 1."""
    return raw.select("*", F.posexplode(F.from_json(F.get_json_object("response_json", path), "array<string>")).alias("_p", "item")).withColumn("rank", F.col("_p") + 1).drop("_p")


def _get(path: str) -> Column:
    return F.get_json_object("item", f"$.{path}")


def _list(path: str, element: str = "string") -> Column:
    return F.coalesce(F.from_json(_get(path), f"array<{element}>"), F.array().cast(f"array<{element}>"))


def _named(rows: DataFrame, **columns: Column) -> DataFrame:
    order = ("title", "authors", "year", "doi", "pmid", "pmcid", "nct_id", "abstract", "venue", "urls")
    empty = {"authors": F.array().cast("array<string>"), "urls": F.array().cast("array<string>")}
    text = F.lit(None).cast("string")
    cells = [columns.get(c, empty.get(c, F.lit(None).cast("int") if c == "year" else text)).alias(c) for c in order]
    return rows.select("rank", *cells, F.col("item").alias("provider_record")).filter(F.trim(F.coalesce("title", F.lit(""))) != "")


def europe_pmc(raw: DataFrame) -> DataFrame:
    """One page of results; retracted ones are dropped, the author string is split at commas."""
    rows = _rows(raw, "$.resultList.result").filter(~F.coalesce(_get("isRetracted") == "Y", F.lit(False)))
    authors = F.filter(F.transform(F.split(F.coalesce(_get("authorString"), F.lit("")), ","), lambda a: F.trim(a)), lambda a: a != "")
    return _named(rows, title=_get("title"), authors=authors, year=N.normalise_year(_get("pubYear")), doi=N.provider_doi(_get("doi")), pmid=_get("pmid"), pmcid=_get("pmcid"), abstract=_get("abstractText"), venue=_get("journalTitle"))


def pubmed(raw: DataFrame) -> DataFrame:
    """Summaries in the order of their id list; identifiers from the list of typed ids."""
    body = F.from_json(F.get_json_object("response_json", "$.result"), "map<string,string>")
    rows = raw.withColumn("body", body).select("*", F.posexplode(F.from_json(F.col("body")["uids"], "array<string>")).alias("_p", "uid"))
    rows = rows.withColumn("item", F.col("body")[F.col("uid")]).withColumn("rank", F.col("_p") + 1)
    ids = F.map_from_entries(F.transform(_list("articleids", "struct<idtype:string,value:string>"), lambda x: F.struct(x["idtype"], x["value"])))
    return _named(
        rows.withColumn("ids", ids), title=_get("title"), authors=F.transform(_list("authors", "struct<name:string>"), lambda a: a["name"]), year=N.normalise_year(_get("pubdate")),
        doi=N.provider_doi(F.try_element_at("ids", F.lit("doi"))), pmid=F.col("uid"), pmcid=F.try_element_at("ids", F.lit("pmc")), venue=_get("fulljournalname"),
    )


def semantic_scholar(raw: DataFrame) -> DataFrame:
    return _named(
        _rows(raw, "$.data"), title=_get("title"), authors=F.transform(_list("authors", "struct<name:string>"), lambda a: a["name"]), year=N.normalise_year(_get("year")),
        doi=N.provider_doi(_get("externalIds.DOI")), pmid=_get("externalIds.PubMed"), abstract=_get("abstract"), venue=_get("venue"), urls=F.array_compact(F.array(_get("url"), _get("openAccessPdf.url"))),
    )


def openalex(raw: DataFrame) -> DataFrame:
    """Works with their abstracts rebuilt from the inverted index."""
    index = F.from_json(_get("abstract_inverted_index"), "map<string,array<int>>")
    return _named(
        _rows(raw, "$.results"), title=F.coalesce(_get("title"), _get("display_name")), authors=F.transform(_list("authorships", "struct<author:struct<display_name:string>>"), lambda a: a["author"]["display_name"]),
        year=N.normalise_year(_get("publication_year")), doi=N.provider_doi(_get("doi")), pmid=F.nullif(F.regexp_extract(F.coalesce(_get("ids.pmid"), F.lit("")), r"(\d+)$", 1), F.lit("")),
        abstract=N.inverted_abstract(index), venue=_get("primary_location.source.display_name"),
    )


def clinical_trials(raw: DataFrame) -> DataFrame:
    """Studies by their brief title, else the official one; the address is built from the registry number."""
    base = "protocolSection.identificationModule"
    nct = _get(f"{base}.nctId")
    return _named(
        _rows(raw, "$.studies"), title=F.coalesce(F.nullif(F.trim(_get(f"{base}.briefTitle")), F.lit("")), _get(f"{base}.officialTitle")), nct_id=nct,
        year=N.normalise_year(_get("protocolSection.statusModule.startDateStruct.date")), abstract=_get("protocolSection.descriptionModule.briefSummary"),
        urls=F.array_compact(F.array(F.concat(F.lit("https://clinicaltrials.gov/study/"), nct))),
    )


def crossref(raw: DataFrame) -> DataFrame:
    """One work by its DOI: year from the first date part, given and family names joined."""
    rows = raw.select("*", F.get_json_object("response_json", "$.message").alias("item"), F.lit(1).alias("rank"))
    authors = F.transform(_list("author", "struct<given:string,family:string>"), lambda a: F.concat_ws(" ", a["given"], a["family"]))
    return _named(rows, title=F.try_element_at(_list("title"), F.lit(1)), authors=authors, year=N.normalise_year(_get("published.date-parts[0][0]")), doi=N.provider_doi(_get("DOI")), venue=F.try_element_at(_list("container-title"), F.lit(1)), abstract=_get("abstract"))


def unpaywall(raw: DataFrame) -> DataFrame:
    """One work by its DOI with the addresses of all its open copies, in order and distinct."""
    rows = raw.select("*", F.col("response_json").alias("item"), F.lit(1).alias("rank"))
    places = _list("oa_locations", "struct<url:string,url_for_landing_page:string,url_for_pdf:string>")
    urls = F.array_distinct(F.array_compact(F.flatten(F.transform(places, lambda p: F.array(p["url"], p["url_for_landing_page"], p["url_for_pdf"])))))
    authors = F.transform(_list("z_authors", "struct<given:string,family:string>"), lambda a: F.concat_ws(" ", a["given"], a["family"]))
    return _named(rows, title=_get("title"), authors=authors, year=N.normalise_year(_get("year")), doi=N.provider_doi(_get("doi")), venue=_get("journal_name"), urls=urls)


def elicit(raw: DataFrame) -> DataFrame:
    return _named(_rows(raw, "$.papers"), title=_get("title"), authors=_list("authors"), year=N.normalise_year(_get("year")), doi=N.provider_doi(_get("doi")), pmid=_get("pmid"), abstract=_get("abstract"), venue=_get("venue"), urls=_list("urls"))


PROJECTIONS = {"europe_pmc": europe_pmc, "pubmed": pubmed, "semantic_scholar": semantic_scholar, "openalex": openalex, "clinical_trials": clinical_trials, "crossref": crossref, "unpaywall": unpaywall, "elicit": elicit}


def project(raw: DataFrame, provider: str) -> DataFrame:
    """A provider's raw payloads (``response_json``) as uniform records; untitled items are dropped."""
    if provider not in PROJECTIONS:
        raise ValueError(f"unsupported provider {provider}")
    return PROJECTIONS[provider](raw)
