"""Extraction by a pluggable predictor instead of dictionaries: candidate choice, batched calls, graph rows."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import ids
from loomgraph.functions.text import is_against
from loomgraph.operators.extract import _order, edge, named_nodes, node, props
from loomgraph.operators.skew import heavy_keys, lookup_join
from loomgraph.operators.terms import match_terms
from loomgraph.session import cut

LOG = logging.getLogger(__name__)
#: Names of conditions, biomarkers and drugs that are offered to the predictor, at most, of each.
OFFERED = 40
PREDICTED = (
    "guideline_id string, snippet_id string, seq bigint, section_path array<string>, page string, genes array<string>, conditions array<string>, "
    "biomarkers array<string>, drugs array<string>, recommendation_text string, relation string, evidence_class string, evidence_level string, confidence double"
)
LISTS = ("genes", "conditions", "biomarkers", "drugs")


def candidate_snippets(snippets: DataFrame, mentions: DataFrame) -> DataFrame:
    """Snippets worth a call: recommendations, those that name a mentioned gene, those of an item with a mention.

    A guideline of which nothing would be left keeps all its snippets. Guidelines and content items with a large share
    of the snippets are joined by broadcast. ``snippets`` should be cut.
    """
    genes = mentions.select("guideline_id", F.lit("gene").alias("kind"), F.col("gene_symbol").alias("term")).where(F.col("term").isNotNull()).distinct()
    named = match_terms(snippets, genes).select("snippet_id").distinct().withColumn("named", F.lit(True))
    item = F.when(F.col("guideline_id").isNotNull() & F.col("content_index").isNotNull(), F.concat(F.col("content_index").cast("string"), F.lit("/"), "guideline_id")).alias("item")
    linked = mentions.select(item).where(F.col("item").isNotNull()).distinct().withColumn("linked", F.lit(True))
    marked = snippets.join(named, "snippet_id", "left").withColumn("item", item).withColumn("home", F.coalesce(F.concat(F.lit("="), "guideline_id"), F.lit("")))
    total = snippets.count()
    marked = lookup_join(marked, linked, "item", cut(heavy_keys(marked.select("item"), "item", total)))
    chosen = F.coalesce(F.col("snippet_type") == "recommendation", F.lit(False)) | F.col("named").isNotNull() | F.col("linked").isNotNull()
    marked = cut(marked.withColumn("chosen", chosen))
    some = marked.groupBy("home").agg(F.max("chosen").alias("any"))
    kept = lookup_join(marked, some, "home", cut(heavy_keys(marked, "home", total))).where(F.col("chosen") | ~F.col("any"))
    return kept.select(*snippets.columns)


def own_candidates(mentions: DataFrame) -> DataFrame:
    """(guideline_id, own_genes, own_conditions): the distinct genes of a guideline's mentions, all of them, and their
    conditions. Of these only the first OFFERED can be among the first OFFERED of a prompt."""
    genes = mentions.where(F.col("gene_symbol").isNotNull()).groupBy("guideline_id").agg(F.collect_set("gene_symbol").alias("own_genes"))
    named = mentions.select("guideline_id", F.explode("associated_conditions").alias("x")).where(F.col("x").isNotNull())
    conditions = named.groupBy("guideline_id").agg(F.slice(F.array_sort(F.collect_set("x")), 1, OFFERED).alias("own_conditions"))
    return genes.join(conditions, "guideline_id", "full").where(F.col("guideline_id").isNotNull())


def predict(snippets: DataFrame, make: Callable[[], Callable[[dict], dict]], names: dict[str, list[str]], mentions: DataFrame) -> DataFrame:
    """Call the predictor on every snippet (cut). ``make`` runs once per worker; a call that fails gives an empty result.

    A call gets text, section_path, page, guideline_title (null where the column is missing) and the candidates. Offered are the genes that the snippet's own guideline mentions, and of conditions (``names`` and the guideline's
    own), biomarkers and drugs the first OFFERED each.
    """
    heavy = cut(heavy_keys(snippets, "guideline_id", snippets.count()))
    columns = ("guideline_id", "snippet_id", "seq", "section_path", "page", "text", "guideline_title")
    if "guideline_title" not in snippets.columns:
        snippets = snippets.withColumn("guideline_title", F.lit(None).cast("string"))
    rows = lookup_join(snippets.select(*columns), own_candidates(mentions), "guideline_id", heavy)
    offered = {k: sorted(v)[:OFFERED] for k, v in names.items()}
    of = lambda x: [] if x is None else list(x)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = make()
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                own = {"genes": sorted(of(r["own_genes"])), "conditions": sorted({*names["conditions"], *of(r["own_conditions"])})[:OFFERED]}
                try:
                    got = ask({"text": r["text"], "section_path": r["section_path"], "page": r["page"], "guideline_title": r["guideline_title"], "candidates": offered | own}) or {}
                except Exception as e:  # noqa: BLE001
                    LOG.warning("prediction failed for %s: %s", r["snippet_id"], e)
                    got = {}
                rows.append({k: r[k] for k in ("guideline_id", "snippet_id", "seq", "section_path", "page")} | {k: list(got.get(k) or []) for k in LISTS} | {k: got.get(k) for k in ("recommendation_text", "relation", "evidence_class", "evidence_level", "confidence")})
            if rows:
                yield pd.DataFrame(rows)

    return rows.select(*columns, "own_genes", "own_conditions").mapInPandas(run, PREDICTED)


def prediction_edges(predicted: DataFrame, source: str = "predictor") -> DataFrame:
    """Edges of predictions; a relation other than the two known ones is decided by the words of the recommendation."""
    clean = lambda c: F.array_distinct(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), ids.strip), lambda x: F.coalesce(x != "", F.lit(False))))
    base = predicted.withColumn("genes", F.transform(clean(F.col("genes")), F.upper)).withColumn("rec_text", F.nullif(ids.strip(F.col("recommendation_text")), F.lit("")))
    for c in LISTS[1:]:
        base = base.withColumn(c, clean(F.col(c)))
    relation = F.when(F.col("relation").isin("RECOMMENDS", "CONTRAINDICATED_FOR"), F.col("relation")).when(is_against(F.col("rec_text")), F.lit("CONTRAINDICATED_FOR")).otherwise(F.lit("RECOMMENDS"))
    base = base.withColumn("relation", relation).withColumn("rec", ids.recommendation_id(F.col("guideline_id"), F.col("rec_text")))
    by, tag, own = F.col("snippet_id"), props(source=F.lit(source)), props(snippet_id=F.col("snippet_id"), source=F.lit(source))
    genes = base.select("*", F.explode("genes").alias("gene"))
    gene = ids.gene_id(F.col("gene"))
    out = genes.select("guideline_id", _order(3, by, gene), *edge(gene, "GENE_MENTIONED_IN", by, tag))
    for column, label, rel in (("conditions", "Condition", "ASSOCIATED_WITH_CONDITION"), ("biomarkers", "Biomarker", "CO_MENTIONED_WITH")):
        at = ids.entity_id(label, F.col("x"))
        out = out.unionByName(genes.select("*", F.explode(column).alias("x")).select("guideline_id", _order(3, by, gene, at), *edge(gene, rel, at, own, by)))
    recs, rec = base.where(F.col("rec_text").isNotNull()), F.col("rec")
    out = out.unionByName(recs.select("guideline_id", _order(3, by), *edge(rec, "SUPPORTED_BY_SNIPPET", by, own)))
    for column, label, rel in (("evidence_class", "EvidenceClass", "HAS_EVIDENCE_CLASS"), ("evidence_level", "EvidenceLevel", "HAS_EVIDENCE_LEVEL")):
        known = recs.where(F.coalesce(F.col(column) != "", F.lit(False)))
        out = out.unionByName(known.select("guideline_id", _order(3, by), *edge(rec, rel, ids.entity_id(label, F.col(column)), tag)))
    out = out.unionByName(recs.select("*", F.explode("genes").alias("gene")).select("guideline_id", _order(3, by, gene), *edge(gene, "REFERENCED_IN_RECOMMENDATION", rec, own)))
    drug = ids.entity_id("Drug", F.col("x"))
    return out.unionByName(recs.select("*", F.explode("drugs").alias("x")).select("guideline_id", _order(3, by, drug), *edge(rec, F.col("relation"), drug, own)))


def prediction_nodes(predicted: DataFrame, source: str = "predictor") -> DataFrame:
    """Entity, evidence and recommendation nodes of predictions; a recommendation carries its confidence."""
    out = None
    for column, label in (("genes", "Gene"), ("conditions", "Condition"), ("biomarkers", "Biomarker"), ("drugs", "Drug")):
        named = predicted.select("guideline_id", F.explode(column).alias("x")).select("guideline_id", ids.strip(F.col("x")).alias("x")).where(F.col("x") != "").distinct()
        name = F.upper("x") if label == "Gene" else F.col("x")
        key = ids.gene_id(F.col("x")) if label == "Gene" else ids.entity_id(label, F.col("x"))
        own = props(gene_symbol=name) if label == "Gene" else props(canonical_name=name)
        rows = named.select("guideline_id", _order(3, name), *node(label, key, name, own))
        out = rows if out is None else out.unionByName(rows)
    text = F.nullif(ids.strip(F.col("recommendation_text")), F.lit(""))
    recs = predicted.withColumn("text", text).where(F.col("text").isNotNull())
    for column, label in (("evidence_class", "EvidenceClass"), ("evidence_level", "EvidenceLevel")):
        out = out.unionByName(named_nodes(label, recs.select("guideline_id", F.col(column).alias("term")).where(F.col("term") != "")))
    values = {n: F.col(n) for n in ("text", "guideline_id", "section_path", "page", "evidence_class", "evidence_level")}
    own = props(**values, source=F.lit(source), confidence=F.col("confidence"))
    return out.unionByName(recs.select("guideline_id", _order(3, F.col("snippet_id")), *node("Recommendation", ids.recommendation_id(F.col("guideline_id"), F.col("text")), F.substring("text", 1, 80), own)))
