"""Collapsing records that differ only in formatting (problem 6).

Dictionary encoding: each value of a record is brought to its canonical form (once per distinct value of a batch),
distinct canonical values get integer ids, a record becomes a sorted tuple of the ids of its (field, value) pairs, and
equal tuples are grouped. Between stages a canonical value travels as a 16-byte digest, so texts are never shuffled.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.skew import HEAVY_PARTS, lookup_join
from loomgraph.session import cut


class _Kept(dict):
    """For str.translate: drops separators, controls and punctuation (categories Z, C, P); fills itself on demand."""

    def __missing__(self, code: int) -> int | None:
        kept = None if unicodedata.category(chr(code))[0] in "ZCP" else code
        self[code] = kept
        return kept


#: A lone surrogate cannot occur in a text; it stands for a point between digits while other points are dropped.
_KEPT = _Kept({0xDC2E: "."})
_POINT = re.compile(r"(?<=[0-9])\.(?=[0-9])")
_PART = re.compile(r"[;|\n]")


def canonical(text: str) -> str:
    """Lower case without white space, control and format characters and punctuation, save points between digits."""
    return _POINT.sub("\udc2e", text.lower()).translate(_KEPT)


def canonical_parts(text: str) -> list[str]:
    """The non-empty canonical parts of a record text, in order."""
    return [c for c in map(canonical, _PART.split(text)) if c]


def _digest(field: str, value: str) -> bytes:
    return hashlib.md5(f"{field}\x00{value}".encode(), usedforsecurity=False).digest()


def value_digests(field: str, values: Column, parts: Column | None = None) -> Column:
    """Digests of the canonical value(s) of a text column as array<binary>; null for null.

    An empty canonical value gives an empty array. Where ``parts`` is true the text is a list of parts.
    """

    @F.pandas_udf("array<binary>")
    def encode(texts: pd.Series, listed: pd.Series) -> pd.Series:
        known: dict = {}
        out = []
        for text, is_list in zip(texts, listed):
            if text is None:
                out.append(None)
                continue
            key = (text, is_list)
            if (got := known.get(key)) is None:
                forms = canonical_parts(text) if is_list else [c] if (c := canonical(text)) else []
                got = known[key] = [_digest(field + ("/part" if is_list else ""), f) for f in forms]
            out.append(got)
        return pd.Series(out, dtype=object)

    return encode(values, F.lit(False) if parts is None else parts)


def exact_digest(field: str, value: Column) -> Column:
    """Digest of a value that is compared as it is."""
    return F.unhex(F.md5(F.concat(F.lit(f"{field}\x00="), value)))


def encode_tuples(values: DataFrame, parts: int = HEAVY_PARTS) -> DataFrame:
    """(row_id, dg) rows -> (row_id, ids): the sorted integer ids of the record's values.

    ``values`` is read three times and should be cut. Values in more than 1/``parts`` of the rows, at most ``parts``
    of them, are looked up by broadcast, the others by a shuffle join.
    """
    counted = values.groupBy("dg").agg(F.count(F.lit(1)).alias("n"))
    entries = cut(counted.withColumn("id", F.monotonically_increasing_id()))
    total = entries.agg(F.sum("n")).first()[0] or 0
    heavy = entries.where(F.col("n") >= max(2, -(-total // parts))).select("dg")
    coded = lookup_join(values, entries.select("dg", "id"), "dg", heavy)
    return coded.groupBy("row_id").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def snippet_values(snippets: DataFrame) -> DataFrame:
    """(row_id, dg) of the rows with comparable text; a row of type ``record`` has one value per part."""
    record = F.coalesce(F.col("snippet_type") == "record", F.lit(False))
    return snippets.select("row_id", F.explode(value_digests("text", F.col("text"), record)).alias("dg"))


def mention_values(mentions: DataFrame) -> DataFrame:
    """(row_id, dg) of the mentions with a symbol: its symbol, conditions, context, numbers and guideline.

    A symbol of signs that do not count, such as ``-`` or ``?``, is neither null nor blank: all such are alike. Null and empty are different values: a null array from an empty one, a null element from a blank one, a null
    context from a blank one. The order of the conditions does not count, their number does.
    """
    symbol = value_digests("symbol", F.col("gene_symbol"))
    context = value_digests("context", F.col("context"))
    mark = lambda name: F.unhex(F.md5(F.lit(f"{name}\x00-")))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    where = F.concat_ws("/", number("occurrences"), number("content_index"))
    base = mentions.select(
        "row_id",
        symbol.alias("symbol"),
        context.alias("context"),
        "associated_conditions",
        F.col("gene_symbol").rlike(r"(?U)[^\s\p{Z}\p{C}]").alias("shown"),
        exact_digest("where", F.concat(where, F.lit("/"), F.coalesce(F.concat(F.lit("="), F.col("guideline_id")), F.lit("null")))).alias("place"),
    ).where(F.col("shown"))
    fixed = base.select(
        "row_id",
        F.explode(
            F.concat(
                F.when(F.size("symbol") == 0, F.array(mark("no sign in symbol"))).otherwise(F.col("symbol")),
                F.when(F.col("context").isNull(), F.array(mark("no context"))).otherwise(F.col("context")),
                F.array("place"),
                F.when(F.col("associated_conditions").isNull(), F.array(mark("no conditions"))).otherwise(F.array().cast("array<binary>")),
            )
        ).alias("dg"),
    )
    listed = base.select("row_id", F.explode("associated_conditions").alias("condition"))
    form = value_digests("condition", F.col("condition"))
    conditions = listed.select("row_id", form.alias("f")).select(
        "row_id",
        F.when(F.col("f").isNull(), mark("null condition")).when(F.size("f") == 0, mark("blank condition")).otherwise(F.col("f")[0]).alias("dg"),
    )
    return fixed.unionByName(conditions)


def keyed_records(snippets: DataFrame, mentions: DataFrame) -> DataFrame:
    """(tbl, row_id, ids) of every row that can have copies."""
    out = None
    for name, values in (("snippets", snippet_values(snippets)), ("gene_mentions", mention_values(mentions))):
        coded = encode_tuples(cut(values)).select(F.lit(name).alias("tbl"), "row_id", "ids")
        out = coded if out is None else out.unionByName(coded)
    return cut(out)


def collapse_copies(keyed: DataFrame) -> DataFrame:
    """One row per distinct record: tbl, ids, first_row_id (the smallest), n_copies."""
    return keyed.groupBy("tbl", "ids").agg(F.min("row_id").alias("first_row_id"), F.count(F.lit(1)).alias("n_copies"))


def copies_found(keyed: DataFrame, parts: int = HEAVY_PARTS) -> DataFrame:
    """Every row but the first of each group of equal records: tbl, first_row_id, row_id.

    Groups are made by aggregation, so no task ever holds a whole group; members get their group's first row by a
    lookup in which groups beyond 1/``parts`` of all rows are broadcast.
    """
    groups = cut(
        collapse_copies(keyed).where(F.col("n_copies") > 1).select(F.concat(F.array(F.when(F.col("tbl") == "snippets", -1).otherwise(-2).cast("bigint")), "ids").alias("key"), "first_row_id", "n_copies")
    )
    rows = keyed.select("tbl", "row_id", F.concat(F.array(F.when(F.col("tbl") == "snippets", -1).otherwise(-2).cast("bigint")), "ids").alias("key"))
    heavy = groups.where(F.col("n_copies") >= max(2, -(-keyed.count() // parts))).select("key")
    joined = lookup_join(rows, groups.select("key", "first_row_id"), "key", heavy)
    return joined.where(F.col("first_row_id") < F.col("row_id")).select("tbl", "first_row_id", "row_id")


def collapsed(snippets: DataFrame, mentions: DataFrame) -> DataFrame:
    """Each record once with its number of copies: tbl, row_id (the smallest of the group), n_copies.

    Rows without comparable content (null, empty or blank text or one without signs that count, null or blank symbol) stay, each with one copy.
    Empty tables give an empty result; columns that are not compared are ignored.
    """
    keyed = keyed_records(snippets, mentions)
    grouped = collapse_copies(keyed).select("tbl", F.col("first_row_id").alias("row_id"), "n_copies")
    for name, table in (("snippets", snippets), ("gene_mentions", mentions)):
        rest = table.select("row_id").join(keyed.where(F.col("tbl") == name).select("row_id"), "row_id", "left_anti")
        grouped = grouped.unionByName(rest.select(F.lit(name).alias("tbl"), "row_id", F.lit(1).cast("bigint").alias("n_copies")))
    return grouped
