"""Identity functions as column expressions. Every join in the graph goes by these ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip and str.split see it, as a character class for Java and RE2 alike.
SPACE = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def strip(value: Column) -> Column:
    """Without white space of any kind at both ends (``trim`` only knows blanks)."""
    return F.regexp_replace(value, f"^{SPACE}+|{SPACE}+$", "")


def squeeze(value: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(value, f"{SPACE}+", " "))


def slugify(value: Column) -> Column:
    """Lower-case letters and digits joined by single hyphens; ``unknown`` if nothing is left. Null for null."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(strip(value)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(value.isNotNull(), F.coalesce(F.nullif(slug, F.lit("")), F.lit("unknown")))


def stable_hash(*parts: Column) -> Column:
    """16 hex digits of the SHA-1 of the stripped parts joined by ``::``; null and blank parts do not count."""
    return stripped_hash(*(F.nullif(strip(p), F.lit("")) for p in parts))


def stripped_hash(*parts: Column) -> Column:
    """``stable_hash`` of parts that are stripped, those that do not count being null."""
    return F.substring(F.sha1(F.concat_ws("::", *parts)), 1, 16)


def make_id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"{prefix}:"), stable_hash(F.lit(prefix), *parts))


def child_id(parent: Column, *parts: Column) -> Column:
    """An id under another id, which takes the prefix's place."""
    return F.concat(parent, F.lit(":"), stable_hash(parent, *parts))


def doc_id(path: Column) -> Column:
    """Slug of the file's stem without a trailing ``_aggregated``."""
    return slugify(F.regexp_replace(F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1), "_aggregated$", ""))


def gene_id(symbol: Column) -> Column:
    return F.concat(F.lit("gene:"), F.upper(symbol))


def entity_id(label: str, name: Column) -> Column:
    return F.concat(F.lit(f"{label.lower()}:"), stable_hash(F.lit(label), name))


def section_name(path: Column) -> Column:
    return F.when(F.size(path) > 0, F.array_join(path, " > ")).otherwise(F.lit("Document"))


def section_id(guideline_id: Column, path: Column) -> Column:
    return F.concat(F.lit("section:"), guideline_id, F.lit(":"), stable_hash(section_name(path)))


def recommendation_id(guideline_id: Column, text: Column) -> Column:
    return F.concat(F.lit("recommendation:"), stable_hash(guideline_id, F.substring(text, 1, 200)))


def snippet_id(guideline_id: Column, content_index: Column, page: Column, text: Column) -> Column:
    return make_id("snippet", guideline_id, content_index.cast("string"), page, F.substring(text, 1, 200))
