"""Questions about genes: resolving a name, the context of a gene in the graph, and the sections of an answer."""

from __future__ import annotations

from dataclasses import dataclass
from difflib import SequenceMatcher, get_close_matches

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.ids import strip
from loomgraph.functions.text import tokens
from loomgraph.operators.graph import EDGE, GraphStore

GENE_RELATIONS = ("GENE_MENTIONED_IN", "ASSOCIATED_WITH_CONDITION", "REFERENCED_IN_RECOMMENDATION", "CO_MENTIONED_WITH")
SNIPPET_RELATIONS = ("FROM_GUIDELINE", "LOCATED_IN_SECTION")
RECOMMENDATION_RELATIONS = ("SUPPORTED_BY_SNIPPET", "HAS_EVIDENCE_CLASS", "HAS_EVIDENCE_LEVEL", "RECOMMENDS", "CONTRAINDICATED_FOR")


#: Order of the rows in an answer's sections.
ORDERS = {"supporting_snippets": ("guideline_title", "page", "snippet_id"), "guidelines": ("title", "guideline_id"), "related": ("name", "node_id"), "recommendations": ("recommendation_id",)}


def text_of(key: str) -> Column:
    """A text property; a JSON null is null."""
    raw = F.nullif(F.col("properties")[key], F.lit("null"))
    return F.when(raw.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), raw, F.lit("}")), "$.v")).otherwise(raw)


def resolve_exact(nodes: DataFrame, query: str) -> DataFrame:
    """gene_symbol, node_id, score, match_type of the gene with that name, whatever the case."""
    hit = nodes.where((F.col("label") == "Gene") & (F.upper("name") == strip(F.upper(F.lit(query)))))
    return hit.select(F.col("name").alias("gene_symbol"), "node_id", F.lit(1.0).alias("score"), F.lit("exact").alias("match_type")).orderBy("node_id").limit(1)


def resolve_fuzzy(nodes: DataFrame, query: str, n: int = 5, cutoff: float = 0.6) -> DataFrame:
    """The ``n`` closest gene names by Ratcliff-Obershelp ratio of at least ``cutoff``, best first.

    The cutoff is tested with the name as first argument and the score is given with the query as first: the ratio is
    not symmetric, and both must be as they are to get the same answers. The names are compared in the workers.
    """
    wanted = query.strip().upper()

    @F.pandas_udf("struct<near:double,score:double>")
    def ratios(names: pd.Series) -> pd.DataFrame:
        near = [SequenceMatcher(None, x, wanted).ratio() if get_close_matches(wanted, [x], 1, cutoff) else None for x in names]
        score = [None if r is None else SequenceMatcher(None, wanted, x.upper()).ratio() for r, x in zip(near, names)]
        return pd.DataFrame({"near": pd.Series(near, dtype="float64"), "score": pd.Series(score, dtype="float64")})

    genes = nodes.where((F.col("label") == "Gene") & F.col("name").isNotNull()).select("node_id", F.col("name").alias("gene_symbol"), ratios("name").alias("r"))
    best = genes.where(F.col("r.near").isNotNull()).orderBy(F.desc("r.near"), F.desc("gene_symbol")).limit(n)
    return best.select("gene_symbol", "node_id", F.col("r.score").alias("score"), F.lit("fuzzy").alias("match_type")).orderBy(F.desc("score"), "node_id")


def context_edges(edges: DataFrame, genes: DataFrame) -> DataFrame:
    """(gene_id, edge) of the typed neighbourhood of each gene in ``genes`` (gene_id), for any number of genes at once.

    From a gene to its snippets, conditions, recommendations and co-mentions; from a snippet to its guideline and
    section; from a recommendation to its evidence, drugs and snippets, and on from those. Never through a
    condition, biomarker or drug.
    """
    rel = F.col("relation")
    own = edges.where(rel.isin(*GENE_RELATIONS)).join(genes.select(F.col("gene_id"), F.col("gene_id").alias("source_id")), "source_id")
    recs = own.where(rel == "REFERENCED_IN_RECOMMENDATION").select("gene_id", F.col("target_id").alias("source_id")).distinct()
    of_recs = edges.where(rel.isin(*RECOMMENDATION_RELATIONS)).join(recs, "source_id")
    first = own.where(rel == "GENE_MENTIONED_IN").select("gene_id", F.col("target_id").alias("source_id"))
    second = of_recs.where(rel == "SUPPORTED_BY_SNIPPET").select("gene_id", F.col("target_id").alias("source_id"))
    of_snippets = edges.where(rel.isin(*SNIPPET_RELATIONS)).join(first.unionByName(second).distinct(), "source_id")
    cols = ["gene_id", *EDGE]
    return own.select(*cols).unionByName(of_recs.select(*cols)).unionByName(of_snippets.select(*cols)).dropDuplicates(["gene_id", "edge_id"])


def context_nodes(nodes: DataFrame, found: DataFrame, genes: DataFrame) -> DataFrame:
    """(gene_id, node) of the ends of the edges found, and the genes themselves; ends without a node are left out."""
    ends = found.select("gene_id", F.explode(F.array("source_id", "target_id")).alias("node_id"))
    ends = ends.unionByName(genes.select("gene_id", F.col("gene_id").alias("node_id"))).distinct()
    return ends.join(nodes, "node_id").select("gene_id", "node_id", "label", "name", "properties")


@dataclass(frozen=True)
class GeneContext:
    """The context of one or more genes, with the sections of an answer. Each section has gene_id in its rows, which
    come in the order of ``ORDERS``, or with ``ordered=False`` in none: for the sections of many genes at once."""

    nodes: DataFrame
    edges: DataFrame

    @classmethod
    def of(cls, store: GraphStore, genes: DataFrame) -> GeneContext:
        found = context_edges(store.edges, genes)
        return cls(context_nodes(store.nodes, found, genes), found)

    @staticmethod
    def _shown(rows: DataFrame, section: str, ordered: bool) -> DataFrame:
        return rows.orderBy("gene_id", *(F.coalesce(c, F.lit("")) for c in ORDERS[section])) if ordered else rows

    def supporting_snippets(self, ordered: bool = True) -> DataFrame:
        rows = self.nodes.where(F.col("label") == "Snippet")
        found = rows.select(
            "gene_id", F.col("node_id").alias("snippet_id"), F.coalesce(text_of("text"), F.lit("")).alias("text"), text_of("guideline_title").alias("guideline_title"), text_of("page").alias("page"),
            F.col("properties")["section_path"].alias("section_path"), text_of("source_json_path").alias("source_json_path"), text_of("source_pdf_path").alias("source_pdf_path"),
        )
        return self._shown(found, "supporting_snippets", ordered)

    def guidelines(self, ordered: bool = True) -> DataFrame:
        rows = self.nodes.where(F.col("label") == "Guideline")
        found = rows.select("gene_id", F.coalesce(text_of("guideline_id"), F.col("node_id")).alias("guideline_id"), F.col("name").alias("title"))
        return self._shown(found, "guidelines", ordered)

    def related(self, label: str, ordered: bool = True) -> DataFrame:
        """Nodes of a label with the sorted ids of the snippets that link them (of edges that name one)."""
        named = self.edges.select("gene_id", text_of("snippet_id").alias("snippet_id"), F.explode(F.array("source_id", "target_id")).alias("node_id")).where(F.col("snippet_id").isNotNull())
        lists = named.groupBy("gene_id", "node_id").agg(F.array_sort(F.collect_set("snippet_id")).alias("snippet_ids"))
        rows = self.nodes.where(F.col("label") == label).join(lists, ["gene_id", "node_id"], "left")
        found = rows.select("gene_id", "name", "node_id", F.coalesce("snippet_ids", F.array().cast("array<string>")).alias("snippet_ids"))
        return self._shown(found, "related", ordered)

    def recommendations(self, fill: bool = False, ordered: bool = True) -> DataFrame:
        """Recommendations with drugs, conditions, biomarkers and supporting snippets.

        Conditions and biomarkers are those that a recommendation has edges to, and there are none as graphs are
        built; with ``fill`` they are those that share a snippet with it.
        """
        e, names = self.edges, self.nodes.select("gene_id", F.col("node_id").alias("target_id"), F.col("name").alias("target_name"), F.col("label").alias("target_label"))
        aimed = e.join(names, ["gene_id", "target_id"], "left")
        pick = lambda test, value: F.array_sort(F.collect_set(F.when(test, F.col(value))))
        lists = aimed.groupBy("gene_id", F.col("source_id").alias("node_id")).agg(
            pick(F.col("relation").isin("RECOMMENDS", "CONTRAINDICATED_FOR"), "target_name").alias("drugs"),
            pick(F.col("target_label") == "Condition", "target_name").alias("conditions"),
            pick(F.col("target_label") == "Biomarker", "target_name").alias("biomarkers"),
            pick(F.col("relation") == "SUPPORTED_BY_SNIPPET", "target_id").alias("supporting_snippet_ids"),
        )
        if fill:
            named = aimed.where(F.col("target_label").isin("Condition", "Biomarker")).select("gene_id", text_of("snippet_id").alias("s"), "target_label", "target_name")
            of_rec = e.where(F.col("relation") == "SUPPORTED_BY_SNIPPET").select("gene_id", F.col("source_id").alias("node_id"), F.col("target_id").alias("s"))
            more = of_rec.join(named, ["gene_id", "s"]).groupBy("gene_id", "node_id").agg(
                pick(F.col("target_label") == "Condition", "target_name").alias("conditions"), pick(F.col("target_label") == "Biomarker", "target_name").alias("biomarkers")
            )
            lists = lists.drop("conditions", "biomarkers").join(more, ["gene_id", "node_id"], "left")
        rows = self.nodes.where(F.col("label") == "Recommendation").join(lists, ["gene_id", "node_id"], "left")
        none = F.array().cast("array<string>")
        found = rows.select(
            "gene_id", F.col("node_id").alias("recommendation_id"), F.coalesce(text_of("text"), F.col("name")).alias("text"), text_of("evidence_class").alias("evidence_class"), text_of("evidence_level").alias("evidence_level"),
            *(F.coalesce(c, none).alias(c) for c in ("drugs", "conditions", "biomarkers", "supporting_snippet_ids")),
        )
        return self._shown(found, "recommendations", ordered)

    def summary(self) -> DataFrame:
        """gene_id, summary: number of guidelines, the first five conditions by name, and evidence classes."""
        n = self.nodes
        classes = n.where((F.col("label") == "Recommendation") & F.coalesce(text_of("evidence_class") != "", F.lit(False)))
        conditions = n.where(F.col("label") == "Condition").select("gene_id", F.struct(F.coalesce("name", F.lit("")).alias("name"), "node_id").alias("c"))
        genes = n.where(F.col("node_id") == F.col("gene_id")).select("gene_id", F.col("name").alias("gene"))
        joined = (
            genes.join(n.where(F.col("label") == "Guideline").groupBy("gene_id").agg(F.count(F.lit(1)).alias("n")), "gene_id", "left")
            .join(conditions.groupBy("gene_id").agg(F.slice(F.array_sort(F.collect_list("c")), 1, 5).alias("cs")), "gene_id", "left")
            .join(classes.groupBy("gene_id").agg(F.array_sort(F.collect_set(text_of("evidence_class"))).alias("es")), "gene_id", "left")
        )
        named = F.coalesce(F.array_join("cs.name", ", "), F.lit("no linked conditions yet"))
        evidence = F.coalesce(F.array_join("es", ", "), F.lit("no explicit evidence classes extracted"))
        text = F.concat("gene", F.lit(" appears in "), F.coalesce("n", F.lit(0)).cast("string"), F.lit(" guideline(s). Top linked conditions: "), named, F.lit(". Extracted recommendation evidence classes: "), evidence, F.lit("."))
        return joined.select("gene_id", text.alias("summary"))


def rerank(snippets: DataFrame, question: str, top_k: int = 5) -> DataFrame:
    """The ``top_k`` snippets by (question contained, shared tokens, id), all descending.

    A question without tokens leaves the snippets as they are, all of them.
    """
    import re

    asked = sorted({t for t in re.findall("[a-z0-9]+", question.lower()) if len(t) > 1})
    if not asked:
        return snippets
    phrase = F.lower("text").contains(question.lower()).cast("int")
    shared = F.size(F.array_intersect(tokens(F.col("text")), F.array(*map(F.lit, asked))))
    scored = snippets.withColumn("phrase", phrase).withColumn("overlap", shared)
    return scored.orderBy(F.desc("phrase"), F.desc("overlap"), F.desc("snippet_id")).limit(top_k)
