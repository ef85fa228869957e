"""Text predicates and extractors as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.functions.ids import SPACE

#: Letters, digits and underscore of any script: what a word boundary separates from the rest.
WORD = r"[\p{L}\p{N}_]"

#: Fixed patterns and words whose results must agree with existing graphs.
CLASS_PATTERN = r"(?i)(?<![\p{L}\p{N}_])Class(?:\s+of\s+Recommendation)?\s+(I{1,3}|IV|1|2a|2b|3)(?![\p{L}\p{N}_])"
CLASS_PATTERN_EXTENDED = r"(?i)(?<![\p{L}\p{N}_])Class(?:\s+of\s+Recommendation)?[\s:]+(III|IIa|IIb|II|IV|I|1|2a|2b|3)(?![\p{L}\p{N}_])"
LEVEL_PATTERN = r"(?i)(?<![\p{L}\p{N}_])(?:Level\s+of\s+Evidence|LOE)\s+([A-C](?:-[A-Z]+)?)(?![\p{L}\p{N}_])"
HINT_PATTERN = (
    r"(?i)(?<![\p{L}\p{N}_])(?:is recommended|should|is reasonable|may be considered|contraindicated|no benefit|harm)"
    r"(?![\p{L}\p{N}_])"
)
AGAINST = ("contraindicated", "should not", "harm", "no benefit")


def evidence_class(field: Column, text: Column, extended: bool = False) -> Column:
    """Class as written, from the field or else the text. ``extended`` also knows IIa and IIb and a colon."""
    pattern = CLASS_PATTERN_EXTENDED if extended else CLASS_PATTERN
    of = lambda c: F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
    return F.coalesce(of(field), of(text))


def evidence_level(field: Column, text: Column) -> Column:
    """Level in capitals, from the field or else the text; the keyword and white space must precede it."""
    of = lambda c: F.nullif(F.regexp_extract(c, LEVEL_PATTERN, 1), F.lit(""))
    return F.upper(F.coalesce(of(field), of(text)))


def is_recommendation(snippet_type: Column, text: Column) -> Column:
    return F.coalesce(snippet_type == "recommendation", F.lit(False)) | F.coalesce(text.rlike(HINT_PATTERN), F.lit(False))


def is_against(text: Column, whole_words: bool = False) -> Column:
    """Whether a recommendation advises against. By default parts of words count, so ``pharmacy`` holds ``harm``."""
    low = F.lower(text)
    test = (lambda w: low.rlike(f"(?<!{WORD}){w}(?!{WORD})")) if whole_words else (lambda w: low.contains(w))
    found = test(AGAINST[0])
    for w in AGAINST[1:]:
        found = found | test(w)
    return found


def tokens(text: Column) -> Column:
    """Distinct runs of ``[a-z0-9]`` longer than one sign in the lower-cased text."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)), lambda t: F.length(t) > 1))


def split_sentences(text: Column) -> Column:
    """Parts between white space that follows ``.``, ``!`` or ``?``."""
    return F.split(text, rf"(?<=[.!?]){SPACE}+")


def quote_pattern(term: Column) -> Column:
    """The term as a regular expression that matches it by the letter."""
    return F.regexp_replace(term, r"([^\p{L}\p{N}\s])", r"\\$1")


def is_word(term: Column) -> Column:
    """Whether a term is matched as a whole word; others are matched anywhere."""
    return term.rlike("^[A-Za-z0-9_-]+$")


def term_found(text: Column, term: Column) -> Column:
    """Whether the term occurs in the text, whatever the case: words as whole words, others anywhere."""
    whole = F.rlike(text, F.concat(F.lit(f"(?i)(?<!{WORD})"), quote_pattern(term), F.lit(f"(?!{WORD})")))
    return F.lower(text).contains(F.lower(term)) & (~is_word(term) | whole)


def json_value(column: Column) -> Column:
    """A value as JSON text; null stays null."""
    text = F.to_json(F.struct(column.alias("v")))
    return F.when(column.isNotNull(), F.substring(text, F.lit(6), F.length(text) - 6))
