"""Lists and identifiers that providers keep in differing places and shapes of a raw record."""

from __future__ import annotations

import json
from typing import Any

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlake.functions.normalise import _text

FIELDS = T.StructType(
    [T.StructField(name, T.ArrayType(T.StringType())) for name in ("publication_types", "authors", "urls")] + [T.StructField(name, T.StringType()) for name in ("pmcid", "provider_retracted")]
)
#: The keys under which types stand, at the top and in the provider's own record.
TYPE_KEYS = ("publicationTypes", "pubType", "pubtype")


def named_strings(value: Any) -> list[str]:
    """Normalised texts of a text or a list: texts as they are, objects by name, display name, or given and family name; in order, each once."""
    items = [value] if isinstance(value, str) else value if isinstance(value, list) else []
    found: dict[str, None] = {}
    for item in items:
        if isinstance(item, dict):
            whole = " ".join(str(item.get(k) or "").strip() for k in ("given", "family")).strip()
            item = item.get("name") or item.get("display_name") or whole
        if text := _text(item):
            found[text] = None
    return list(found)


def _within(value: Any, *path: str) -> Any:
    for key in path:
        value = value.get(key) if isinstance(value, dict) else None
    return value


def publication_types(raw: dict) -> list[str]:
    """All types that a record or its provider's record names, by case-folded name; types that differ in case only stay apart."""
    places = [_within(raw, k) for k in TYPE_KEYS] + [_within(raw, "providerRecord", k) for k in TYPE_KEYS] + [_within(raw, "providerRecord", "pubTypeList", "pubType")]
    return sorted({t for place in places for t in named_strings(place)}, key=lambda t: (t.casefold(), t))


def author_names(raw: dict) -> list[str]:
    """The record's authors, else the provider's, else its author string at the commas."""
    for place in (_within(raw, "authors"), _within(raw, "providerRecord", "authors")):
        if names := named_strings(place):
            return names
    return [part for name in (_text(_within(raw, "providerRecord", "authorString")) or "").split(",") if (part := name.strip())]


def https_addresses(raw: dict) -> list[str]:
    """Addresses that begin with https, resolvers upgraded; sorted, each once."""
    better = (u.replace("http://doi.org/", "https://doi.org/", 1) if u.startswith("http://doi.org/") else u for u in named_strings(_within(raw, "urls")))
    return sorted({u for u in better if u.startswith("https://")})


@F.pandas_udf(FIELDS)
def record_fields(raw_json: pd.Series) -> pd.DataFrame:
    """Types, authors, addresses, PMC id and the provider's retraction flag of raw records; a record that is no JSON object has empty lists and nulls."""
    rows = []
    for text in raw_json:
        try:
            raw = json.loads(text) if isinstance(text, str) else {}
        except (ValueError, RecursionError):
            raw = {}
        raw = raw if isinstance(raw, dict) else {}
        pmcid = next((x for x in (_text(raw.get("pmcid")), _text(_within(raw, "providerRecord", "pmcid"))) if x), None)
        flag = _within(raw, "providerRecord", "isRetracted")
        rows.append((publication_types(raw), author_names(raw), https_addresses(raw), pmcid, None if flag is None else str(flag)))
    return pd.DataFrame(rows, columns=["publication_types", "authors", "urls", "pmcid", "provider_retracted"])
