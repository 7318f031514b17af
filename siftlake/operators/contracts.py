"""Closed contracts for JSON documents: what a document must hold, with every breach named.

A contract lists fields and their kinds.  Documents stay JSON text in a column and are parsed once each, in Arrow batches: column functions would parse them
again for every field, and tell ``true`` from ``"true"`` and a missing field from a null one by as many variants.  A document that is no object breaks the
contract as a whole.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from datetime import datetime
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ZONED = re.compile(r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})\Z")
SHA256 = re.compile(r"[0-9a-f]{64}\Z")


@dataclass(frozen=True)
class Field:
    """One field: its kind (``text``, ``flag``, ``count``, ``list``, ``sha256``, ``instant`` or ``word``) and what its value must be."""

    name: str
    kind: str = "text"
    #: Whether null is allowed (text only).
    optional: bool = False
    #: Longest text; least count or list.
    most: int = 100_000
    least: int = 0
    #: The allowed words; the only allowed flag.
    words: tuple[str, ...] = ()
    only: bool | None = None

    def holds(self, value: Any) -> bool:
        match self.kind:
            case "flag":
                return isinstance(value, bool) and self.only in (None, value)
            case "count":
                return isinstance(value, int) and not isinstance(value, bool) and value >= self.least
            case "list":
                return isinstance(value, list) and len(value) >= self.least
        if value is None:
            return self.optional
        if not _said(value) or len(text := value.strip()) > self.most:
            return False
        match self.kind:
            case "word":
                return text in self.words
            case "sha256":
                return bool(SHA256.match(text))
            case "instant":
                return _instant(text)
        return True


@dataclass(frozen=True)
class Contract:
    """Fields of a document, all of them required, and rules ``(name of the breach, flag field, field that it then needs)``."""

    version: str
    fields: tuple[Field, ...]
    needs: tuple[tuple[str, str, str], ...] = ()

    def breaches(self, payload: Column) -> Column:
        """Sorted names of what a document breaks: ``field`` for a bad value, ``missing:field``, ``extra:field``, ``not_an_object``; empty if it holds."""

        @F.pandas_udf("array<string>")
        def told(texts: pd.Series) -> pd.Series:
            return texts.map(self.breaches_of)

        return told(payload)

    def breaches_of(self, text: str | None) -> list[str]:
        try:
            doc = json.loads(text) if text else None
        except (ValueError, RecursionError):
            doc = None
        if not isinstance(doc, dict):
            return ["not_an_object"]
        names = {"schema_version", *(f.name for f in self.fields)}
        found = [f"missing:{n}" for n in names - set(doc)] + [f"extra:{n}" for n in set(doc) - names]
        found += [f.name for f in self.fields if f.name in doc and not f.holds(doc[f.name])]
        if doc.get("schema_version", self.version) != self.version:
            found.append("schema_version")
        found += [breach for breach, flag, field in self.needs if doc.get(flag) is True and not _said(doc.get(field))]
        return sorted(found)


def _said(value: Any) -> bool:
    return isinstance(value, str) and bool(value.strip())


def _instant(text: str) -> bool:
    try:
        return bool(ZONED.match(text)) and datetime.fromisoformat(text) is not None
    except ValueError:
        return False


# The words of appraisals and extractions.
DESIGNS = (
    "clinical_guideline", "systematic_review", "meta_analysis", "randomized_controlled_trial", "nonrandomized_controlled", "longitudinal", "cohort", "case_control",
    "cross_sectional", "case_series", "mechanistic_human", "animal", "in_vitro", "expert_opinion", "other",
)
RISKS = ("low", "some_concerns", "high", "critical", "unclear")
APPLICABILITY = ("direct", "partial", "indirect", "unknown")
RETRACTION = ("clear", "corrected", "retracted", "unknown")
DIRECTIONS = ("beneficial", "neutral", "harmful", "mixed", "unknown")


def appraisal_contract(version: str) -> Contract:
    """An appraisal of one source: nineteen fields, among them the schema's version."""
    return Contract(
        version,
        (
            Field("source_record_id", "sha256"), Field("study_identity", most=2000), Field("study_design", "word", words=DESIGNS), Field("human_verified", "flag"), Field("full_text_verified", "flag"),
            Field("risk_of_bias", "word", words=RISKS), Field("population_applicability", "word", words=APPLICABILITY), Field("harms_assessed", "flag"), Field("conflicts_assessed", "flag"),
            Field("retraction_status", "word", words=RETRACTION), Field("effect_estimate", optional=True), Field("confidence_interval", optional=True), Field("outcome_direction", "word", words=DIRECTIONS),
            Field("supporting_quote", optional=True), Field("source_locator", optional=True), Field("assessed_by", most=500), Field("assessed_at", "instant"), Field("notes", "list"),
        ),
        (("verified_without_quote", "human_verified", "supporting_quote"), ("full_text_without_locator", "full_text_verified", "source_locator")),
    )


def extraction_contract(version: str) -> Contract:
    """What was extracted from one study's full text: twenty-three fields, among them the schema's version."""
    told = ("study_design", "population", "condition", "intervention_protocol", "comparator", "follow_up", "adverse_events", "withdrawals", "funding", "conflicts", "extracted_by")
    return Contract(
        version,
        (
            Field("group_id", "sha256"), Field("full_text_sha256", "sha256"), Field("full_text_verified", "flag", only=True), *(Field(name) for name in told), Field("sample_size", "count", least=1),
            Field("outcomes", "list", least=1), Field("effect_estimates", "list"), Field("source_locators", "list", least=1), Field("notes", "list"),
            Field("risk_of_bias", "word", words=RISKS), Field("population_applicability", "word", words=APPLICABILITY), Field("extracted_at", "instant"),
        ),
    )
