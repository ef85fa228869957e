"""Edges made without merging beside those that are merged, and terms beside a plain comparison with every text."""

import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
from loomgraph.functions.text import term_found
from loomgraph.operators import extract
from loomgraph.operators.terms import _anchored, match_terms
from loomgraph.plans import graph_queries

SNIPPETS = "row_id bigint, snippet_id string, guideline_id string, seq bigint, text string, snippet_type string, section_path array<string>, page string, json_pointer string, content_index int, raw_fields map<string,string>"
MENTIONS = "row_id bigint, guideline_id string, gene_symbol string, associated_conditions array<string>, occurrences bigint, context string, content_index int"
TERMS = "guideline_id string, kind string, term string"
GUIDELINES = "row_id bigint, guideline_id string, title string, family string, organization string, publication_date string, journal string, pages string, source_json_path string, source_pdf_path string, loaded_at string"


def snippet(i, sid, guideline, text, item=None, kind="text", section=None):
    return (i, sid, guideline, i, text, kind, section, str(i), "/content", item, {"Class of Recommendation": '"Class I"'})


def tables(spark):
    """An item with many genes and snippets, and ids and contexts that are shared or differ by white space only."""
    rows = [snippet(i, f"s{i}", "g1", f"ABCD{i} in heart failure, LDL-C and statin {i}", 0) for i in range(30)]
    rows += [
        snippet(40, "both", "g1", "ABCD1 with heart failure is recommended", 1), snippet(41, "both", "g2", "ABCD1 with heart failure should get statin", 1),
        snippet(42, "blank ", "g1", "ABCD2 and angina", 1), snippet(43, "blank", "g1", "ABCD2 and angina", 2), snippet(44, " ", "g1", "ABCD2", 1),
        snippet(45, "told", "g2", "abcd3 with angina, abcd3  or", 1), snippet(46, "rec1", "g2", "Statin is recommended in ABCD4", 3, "recommendation", ["A"]),
        snippet(47, "rec2", "g2", "Statin is recommended in ABCD4", 3, "recommendation", ["A"]), snippet(48, "none", None, "ABCD4 angina", 3), snippet(49, "far", "g3", "ABCD1", None),
    ]
    names = [(i, "g1", f"ABCD{i}", ["angina", "heart failure"], 1, f"c{i}", 0) for i in range(30)]
    names += [(40, "g2", "ABCD3", ["angina", None], 1, "told", 1), (41, "g2", "ABCD3", ["angina"], 1, " ", 1), (42, "g2", "ABCD3 ", None, 1, None, 3), (43, "g2", "ABCD3", ["angina"], 1, None, 3), (44, "g3", "ABCD1", None, 1, "x", None)]
    terms = [(None, "condition", "heart failure"), (None, "condition", "angina"), (None, "condition", "angina "), (None, "biomarker", "LDL-C"), (None, "drug", "statin"), ("g2", "gene", "abcd3 "), ("g2", "gene", "abcd3"), (None, "gene", "ABCD4")]
    guidelines = [(i, f"g{i}", f"G {i}", None, None, None, None, None, None, None, "1") for i in (1, 2, 3)]
    return {"snippets": spark.createDataFrame(rows, SNIPPETS), "gene_mentions": spark.createDataFrame(names, MENTIONS), "terms": spark.createDataFrame(terms, TERMS), "guidelines": spark.createDataFrame(guidelines, GUIDELINES)}


def shown(edges):
    return sorted((e.edge_id, e.source_id, e.target_id, e.relation, tuple(sorted(e.properties.items()))) for e in edges.collect())


def test_edges_of_snippets_are_not_merged(spark, monkeypatch):
    t = tables(spark)
    found = extract.Found.of(t["guidelines"], t["snippets"], t["gene_mentions"], t["terms"])
    want, merged = extract.assemble_edges(found.edge_rows()), []
    usual = extract.assemble_edges
    monkeypatch.setattr(extract, "assemble_edges", lambda rows: usual(merged.append(rows) or rows))
    got = found.edges()
    assert shown(got) == shown(want) and got.select("edge_id").count() > 1_000
    odd = {r.snippet_id for r in extract.shared_ids(t["snippets"].where("guideline_id IS NOT NULL"), t["gene_mentions"]).collect()}
    assert odd == {"both", "blank ", "blank", " ", "told"}
    assert {r.target_id for r in merged[0].where("relation = 'GENE_MENTIONED_IN'").select("target_id").collect()} == odd


def test_large_items_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(extract, "ITEM_PAIRS", 100)
    monkeypatch.setattr(extract, "TASK_PAIRS", 100)
    named = spark.range(30).select(F.lit("g").alias("guideline_id"), (F.col("id") % 2).cast("int").alias("content_index"), F.format_string("gene:%d", "id").alias("key")).withColumn("gene", F.col("key"))
    places = spark.range(60).select(F.lit("g").alias("guideline_id"), (F.col("id") % 2).cast("int").alias("content_index"), F.format_string("s%d", "id").alias("snippet_id"))
    got = extract._item_pairs(named, places)
    assert got.count() == got.distinct().count() == 900
    assert max(r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()) <= 450


def test_terms_beside_every_text(spark):
    deal = random.Random(3)
    words = ["ab", "ABC", "abcde", "Abcdefg", "ß", "x_y", "-", "é", "高血圧", "İx", "a", "abcdef1"]
    join = lambda n: "".join(deal.choice(words) + deal.choice([" ", "-", ", ", "", "\n", "*"]) for _ in range(n))
    texts = spark.createDataFrame([(str(i), f"g{i % 3}" if i % 5 else None, join(deal.randint(1, 9))) for i in range(150)], "snippet_id string, guideline_id string, text string")
    terms = spark.createDataFrame([(deal.choice([None, "g0", "g1"]), "k", join(deal.randint(1, 3))) for _ in range(250)], TERMS).distinct()
    near = F.col("t.guideline_id").isNull() | (F.col("t.guideline_id") == F.col("s.guideline_id"))
    want = texts.alias("s").join(terms.alias("t"), near & term_found(F.col("text"), F.col("term"))).select("snippet_id", "kind", "term").distinct()
    got = match_terms(texts, terms)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 400


def test_edges_of_a_gene_only(spark, tmp_path, monkeypatch):
    for name, rows in tables(spark).items():
        if name == "gene_mentions":
            rows = rows.withColumn("gene_symbol", F.regexp_replace("gene_symbol", "^ABCD1$", graph_queries.GENE))
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    kept, usual = [], graph_queries.cut
    monkeypatch.setattr(graph_queries, "cut", lambda d: kept.append(usual(d)) or kept[-1])
    entry.queries()["built_recommendations"](spark, str(tmp_path)).collect()
    genes = [e.select("source_id").where("source_id LIKE 'gene:%'").distinct().collect() for e in kept if "relation" in e.columns]
    assert genes and all([r.source_id for r in g] == [f"gene:{graph_queries.GENE}"] for g in genes)


def test_terms_are_looked_up_by_what_few_texts_hold(spark):
    terms = spark.createDataFrame([(None, "k", t) for t in ("venous", "venous-spasm", "septal dilation", "HT GGUP2", " ALSI", "FWH2.", "-", "高血圧")], "scope string, kind string, term string")
    got = {r.term: (r.family, r.anchor) for r in _anchored(terms).collect()}
    assert got == {
        "venous": ("word", "venous"), "venous-spasm": ("long", "enous-spasm"), "septal dilation": ("long", "eptal dilat"), "HT GGUP2": ("seam", "ht gg"),
        " ALSI": ("head", " als"), "FWH2.": ("tail", "wh2."), "-": ("1", "-"), "高血圧": ("3", "高血圧"),
    }
