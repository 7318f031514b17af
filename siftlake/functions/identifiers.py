"""Identifiers in one way of writing, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels and resolver addresses that may stand before an identifier.
LEAD = r"^(?:\s|(?:doi|pmid|pubmed|nct)(?=[\s:0-9])\s*:?|https?://[^/\s]+/(?:pubmed/)?)+"
TAIL = r"[\s.,;:]+$"


def percent_decoded(value: Column) -> Column:
    """Text with its percent-encoding resolved; text that is no valid encoding stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)


def bare_identifier(value: Column) -> Column:
    """An identifier without case, percent-encoding, label, resolver address, padding and closing punctuation.

    Null stays null; a value that consists of such parts only becomes an empty string.
    """
    text = F.lower(F.trim(percent_decoded(F.trim(value))))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, LEAD, ""), TAIL, ""), r"^0+(?=[0-9]+$)", "")


def identity_form(key: Column) -> Column:
    """An identity key ``kind:value`` in the one form that all its ways of writing share."""
    kind = F.lower(F.regexp_extract(F.trim(key), r"^([A-Za-z_]+):", 1))
    value = F.regexp_replace(F.trim(key), r"^[A-Za-z_]+:", "")
    return F.when(key.isNotNull(), F.concat_ws(":", kind, bare_identifier(value)))
