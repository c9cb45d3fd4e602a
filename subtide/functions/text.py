"""Text cleaning."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact_lower(value: Column) -> Column:
    """Trim, lower-case and drop inner spaces: ``Data Center`` -> ``datacenter``."""
    return F.replace(F.lower(F.trim(value)), F.lit(" "), F.lit(""))


def license_status(raw: Column) -> Column:
    """Fold the spelling variants; an unknown status stays visible in lower case."""
    spelled = F.upper(F.trim(raw))
    return F.when(spelled.isin("ACTIVE", "ACTV"), F.lit("active")).otherwise(F.lower(F.trim(raw)))


def is_active_status(raw: Column) -> Column:
    """False, never NULL, for a missing status."""
    return F.coalesce(F.upper(F.trim(raw)).isin("ACTIVE", "ACTV"), F.lit(False))


def missing_text(value: Column) -> Column:
    """Blank text and the literal ``None`` become NULL."""
    return F.nullif(F.nullif(F.trim(value), F.lit("")), F.lit("None"))


def country_code(iso_code: Column, raw_country: Column) -> Column:
    """ISO code where known, the cleaned raw name otherwise, in lower case."""
    return F.lower(F.coalesce(iso_code, F.trim(raw_country)))


def suffix_pattern(suffixes: Sequence[str]) -> str:
    """Pattern for one legal suffix at the end, the longest alternative first."""
    ordered = sorted(suffixes, key=lambda suffix: (-len(suffix), suffix))
    return r"(?i)\s+(" + "|".join(re.escape(suffix) for suffix in ordered) + r")\.?\s*$"


def company_key(company: Column, country: Column, suffixes: Sequence[str]) -> Column:
    """``Acme, Inc.`` in ``DE`` -> ``acme|de``.

    Exactly one trailing legal suffix is removed. NULL companies give NULL keys.
    """
    name = F.lower(F.trim(company))
    if suffixes:
        name = F.regexp_replace(name, suffix_pattern(suffixes), "")
    slug = F.btrim(F.regexp_replace(F.trim(name), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.concat(slug, F.lit("|"), F.lower(F.coalesce(country, F.lit(""))))


def product_name(addon_key: Column, prefix: str) -> Column:
    """The product part of an addon key."""
    return F.replace(addon_key, F.lit(prefix), F.lit("")) if prefix else addon_key
