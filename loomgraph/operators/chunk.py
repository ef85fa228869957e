"""Sentence windows with character overlap, as a fold over the sentences of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.ids import child_id
from loomgraph.functions.text import split_sentences


def windows(text: Column, size: int, overlap: int) -> Column:
    """Windows of whole sentences of at most ``size`` characters; each starts with the last ``overlap`` of the one before.

    A sentence that does not fit behind the overlap starts a window without it, so the fold always ends; a sentence
    longer than ``size`` is a window by itself.
    """
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"))

    def step(acc: Column, s: Column) -> Column:
        cur, out = acc["cur"], acc["out"]
        grown = F.concat(cur, F.lit(" "), s)
        carried = F.concat(F.right(cur, F.lit(overlap)), F.lit(" "), s)
        state = lambda o, c: F.struct(o.alias("out"), c.alias("cur"))
        again = F.when(F.lit(overlap > 0) & (F.length(carried) <= size), carried).otherwise(s)
        return (
            F.when(cur == "", state(out, s))
            .when(F.length(grown) <= size, state(out, grown))
            .otherwise(state(F.concat(out, F.array(cur)), again))
        )

    done = F.aggregate(split_sentences(text), start, step, lambda a: F.concat(a["out"], F.array(a["cur"])))
    return F.when((F.lit(size) <= 0) | (F.length(text) <= size), F.array(text)).otherwise(done)


def chunk_snippets(snippets: DataFrame, size: int = 1600, overlap: int = 200) -> DataFrame:
    """Snippets with ``window`` (from 0), text and snippet_id of each window; other columns are kept.

    Short texts pass unchanged. A cut snippet's windows get ids under its own, and raw_fields names the parent. Null
    texts give no window.
    """
    cut = snippets.where(F.col("text").isNotNull()).withColumn("windows", windows(F.col("text"), size, overlap))
    rows = cut.select(*snippets.columns, F.size("windows").alias("n"), F.posexplode("windows").alias("window", "piece"))
    parts = F.col("n") > 1
    fields = F.coalesce(F.col("raw_fields"), F.create_map().cast("map<string,string>"))
    parent = F.create_map(F.lit("parent_snippet_id"), F.concat(F.lit('"'), F.col("snippet_id"), F.lit('"')))
    return (
        rows.withColumn("raw_fields", F.when(parts, F.map_concat(F.map_filter(fields, lambda k, v: k != "parent_snippet_id"), parent)).otherwise(F.col("raw_fields")))
        .withColumn("snippet_id", F.when(parts, child_id(F.col("snippet_id"), F.col("window").cast("string"))).otherwise(F.col("snippet_id")))
        .withColumn("text", F.col("piece"))
        .drop("piece", "n")
    )
