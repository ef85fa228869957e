"""Finding the terms of dictionaries in texts: one join by equality, whatever the length of the lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.text import WORD, is_word, term_found
from loomgraph.session import cut

#: Each term for all guidelines, or for one with at least 1/HEAVY_SHARE of all texts, is repeated for this many parts of
#: the texts, so that a word of a third of all texts is no single task.
SALTS, HEAVY_SHARE = 8, 64
_OTHER = r"[^\p{L}\p{N}_]"
#: Parts by which terms are looked up that are no words, best first: where two words meet, with five or two signs of
#: either; the first signs of a word with the sign before it, and the last with the sign after it.
SHAPES = {"long": f"{WORD}{{5}}{_OTHER}+{WORD}{{5}}", "seam": f"{WORD}{{2}}{_OTHER}+{WORD}{{2}}", "head": f"{_OTHER}{WORD}{{3}}", "tail": f"{WORD}{{3}}{_OTHER}"}
#: Longest part by which terms without any of these are looked up.
GRAM = 3
#: Up to so many parts of one family are looked for one by one, which is quicker than listing all those of a text.
FEW = 32
#: Parts of texts are first looked up among this many numbers, which bounds that broadcast; a number that a part and
#: another anchor share lets the part through to the join.
BUCKETS = 2**17


def _anchored(terms: DataFrame) -> DataFrame:
    """Terms with ``family`` and ``anchor``: the part by which a text is looked up, and where such parts come from.

    ``word``: a term that is one token and matched as a whole word; one of ``SHAPES``: its first place in another
    term; ``1`` to ``3``: the first signs of a term without these, which may begin inside a word.
    """
    low = F.lower("term")
    token = F.regexp_extract(low, f"{WORD}+", 0)
    whole = is_word(F.col("term")) & (token == low)
    family, anchor = F.when(whole, "word"), F.when(whole, token)
    for name, pattern in SHAPES.items():
        part = F.regexp_extract(low, pattern, 0)
        family, anchor = family.when(part != "", name), anchor.when(part != "", part)
    family, anchor = family.otherwise(F.least(F.length(low), F.lit(GRAM)).cast("string")), anchor.otherwise(F.substring(low, 1, GRAM))
    return terms.select("scope", "kind", "term", family.alias("family"), anchor.alias("anchor"))


def _parts(text: Column, family: str) -> Column:
    """The distinct parts of a text that anchors of a family can equal."""
    inner = SHAPES.get(family) or f"(?s:.{{{family}}})"
    pattern = f"({WORD}+)" if family == "word" else f"(?=({inner}))"
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1)))


def _heavy(texts: DataFrame) -> list[str]:
    """Guidelines with at least 1/HEAVY_SHARE of the texts."""
    sizes = texts.groupBy("guideline_id").agg(F.count(F.lit(1)).alias("n"))
    total = F.broadcast(sizes.agg(F.sum("n").alias("total")))
    found = sizes.crossJoin(total).where(F.col("guideline_id").isNotNull() & (F.col("n") * HEAVY_SHARE >= F.col("total")))
    return [r.guideline_id for r in found.collect()]


def match_terms(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(snippet_id, kind, term) of every term in every text, once each.

    ``texts``: snippet_id, guideline_id, text. ``terms``: guideline_id (null: for all), kind, term. A term of a
    guideline is looked for in that guideline's texts only. Null and empty terms and texts, and texts without
    snippet_id, match nothing. Texts that share a snippet_id count as one; other columns are ignored.

    A term joins texts by a part that any text holding it must have, together with its guideline if it has one, so
    the rows of the join grow with the places that can match; parts that no term has are left out before. Texts are not
    carried along: only where the part does not decide are they fetched for the pairs found, and the term is checked in
    place.
    """
    texts = texts.select("snippet_id", "guideline_id", "text").where((F.col("text") != "") & F.col("snippet_id").isNotNull())
    terms = terms.select(F.col("guideline_id").alias("scope"), "kind", "term").where(F.col("term") != "").distinct()
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(BUCKETS)).alias("bucket")
    anchored = cut(_anchored(terms).withColumn("bucket", bucket))
    present = anchored.groupBy("family").agg(F.countDistinct("anchor").alias("n")).collect()  # eight rows at most

    large = _heavy(texts)  # HEAVY_SHARE at most
    heavy = lambda c: F.coalesce(F.col(c).isin(large), F.lit(False))
    schema = "snippet_id string, guideline_id string, kind string, term string, sure boolean"
    pairs = texts.sparkSession.createDataFrame([], schema)
    for family, n in sorted(present):
        own = anchored.where(F.col("family") == family)
        marks = own.groupBy("bucket").agg(F.max(F.col("scope").isNull()).alias("for_all"), F.max(F.col("scope").isNotNull()).alias("for_one"))
        if family != "word" and n <= FEW:
            each = [F.when(F.col("low").contains(r.anchor), r.anchor) for r in own.select("anchor").distinct().collect()]
            parts = texts.select("snippet_id", "guideline_id", F.lower("text").alias("low")).select("snippet_id", "guideline_id", F.explode(F.array(*each)).alias("anchor")).where(F.col("anchor").isNotNull())
        else:
            parts = texts.select("snippet_id", "guideline_id", F.explode(_parts(F.col("text"), family)).alias("anchor"))
        parts = parts.withColumn("bucket", bucket).join(F.broadcast(marks), "bucket")
        uses = F.explode(F.array(F.when(F.col("for_all"), True), F.when(F.col("for_one") & F.col("guideline_id").isNotNull(), False))).alias("everywhere")
        parts = parts.select("snippet_id", "guideline_id", "anchor", uses).where(F.col("everywhere").isNotNull())
        salt = F.pmod(F.xxhash64("snippet_id"), F.lit(SALTS)).cast("int")
        parts = parts.withColumn("salt", F.when(F.col("everywhere") | heavy("guideline_id"), salt).otherwise(0))
        salts = F.when(F.col("scope").isNull() | heavy("scope"), F.lit(SALTS)).otherwise(1)
        salted = own.select("scope", "anchor", "kind", "term", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
        here = (F.col("everywhere") == F.col("scope").isNull()) & (F.when(F.col("everywhere"), "").otherwise(F.col("guideline_id")) == F.coalesce("scope", F.lit("")))
        same = (F.col("p.anchor") == F.col("t.anchor")) & (F.col("p.salt") == F.col("t.salt"))
        sure = F.lit(family == "word").alias("sure")
        pairs = pairs.unionByName(parts.alias("p").join(salted.alias("t"), same & here).select("snippet_id", "guideline_id", "kind", "term", sure))
    pairs = cut(pairs)
    open_ = pairs.where(~F.col("sure")).drop("sure")
    at = (F.col("o.snippet_id") == F.col("t.snippet_id")) & F.col("o.guideline_id").eqNullSafe(F.col("t.guideline_id"))
    checked = open_.alias("o").join(texts.alias("t"), at).where(term_found(F.col("text"), F.col("term")))
    return pairs.where("sure").select("snippet_id", "kind", "term").unionByName(checked.select("o.snippet_id", "kind", "term")).distinct()
