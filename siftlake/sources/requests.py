"""Requests as data: envelopes without secrets, filters written into a query, official addresses, redacted messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftlake.functions.normalise import canonical_json, safe_https

#: How one provider's queries spell the tags of study types.
TYPE_TAGS = {
    "Longitudinal": "longitudinal studies[mh]", "Meta-Analysis": "meta-analysis[pt]", "RCT": "randomized controlled trial[pt]", "Review": "review[pt]", "Systematic Review": "systematic[sb]",
}
NOT_RETRACTED = "NOT (hasretractionin OR retracted publication[pt])"
FIRST_YEAR, LAST_YEAR = 1600, 2200
#: Seconds that a request may take.
TIMEOUTS = (1, 1200)


def request_envelope(provider: Column, endpoint: Column, query: Column, maximum: Column, filters_json: Column, contact_email: Column, api_key: Column) -> Column:
    """The canonical JSON of a request; of contact and key only whether there is one.  Filters are JSON text, an object or null (none)."""
    there = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    text = F.concat(
        F.lit('{"apiKeyProvided":'), there(api_key).cast("string"), F.lit(',"contactEmailProvided":'), there(contact_email).cast("string"), F.lit(',"endpoint":'), quoted(endpoint),
        F.lit(',"filters":'), F.coalesce(filters_json, F.lit("{}")), F.lit(',"maxResults":'), F.coalesce(maximum.cast("string"), F.lit("null")), F.lit(',"provider":'), quoted(provider),
        F.lit(',"query":'), quoted(query), F.lit("}"),
    )
    return canonical_json(text)


def quoted(text: Column) -> Column:
    """A text as a JSON string, a null as ``null``."""
    return F.coalesce(F.regexp_extract(F.to_json(F.struct(text.alias("t"))), r'(?s)^\{"t":(.*)\}$', 1), F.lit("null"))


def effective_query(query: Column, exclude_retracted: Column, type_tags: Column, first_year: Column, last_year: Column) -> Column:
    """A query with its filters written into it: retracted records, tags of study types (unknown ones say nothing), years."""
    names = F.create_map(*(F.lit(x) for pair in TYPE_TAGS.items() for x in pair))
    tags = F.array_compact(F.transform(F.coalesce(type_tags, F.array().cast("array<string>")), lambda t: F.try_element_at(names, t)))
    years = F.concat(F.lit("AND "), F.coalesce(first_year, F.lit(FIRST_YEAR)).cast("string"), F.lit(":"), F.coalesce(last_year, F.lit(LAST_YEAR)).cast("string"), F.lit("[dp]"))
    return F.concat_ws(
        " ", F.concat(F.lit("("), query, F.lit(")")), F.when(exclude_retracted, NOT_RETRACTED), F.when(F.size(tags) > 0, F.concat(F.lit("AND ("), F.array_join(tags, " OR "), F.lit(")"))),
        F.when(first_year.isNotNull() | last_year.isNotNull(), years),
    )


def official_address(url: Column, host: str, path: str) -> Column:
    """An https address of exactly this host and of a path that begins with ``path``, without user information or port; else null."""
    here = (F.try_parse_url(url, F.lit("AUTHORITY")) == host) & F.startswith(F.try_parse_url(url, F.lit("PATH")), F.lit(path))
    return F.when(F.coalesce(here, F.lit(False)), safe_https(url))


def allowed_timeout(seconds: Column) -> Column:
    """A timeout within the allowed range, else null."""
    return F.when(seconds.between(*TIMEOUTS), seconds)


def redacted(message: Column, secret: Column, most: int = 1000) -> Column:
    """A message without the secret, cut to a length; a null or empty secret takes nothing away."""
    clean = F.when(F.coalesce(secret, F.lit("")) != "", F.replace(message, secret, F.lit("[redacted]"))).otherwise(message)
    return F.left(clean, F.lit(most))
