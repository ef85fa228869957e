"""From normalized tables to a property graph: dictionary and pattern matching as set-oriented plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import ids
from loomgraph.functions.text import evidence_class, evidence_level, is_against, is_recommendation, json_value
from loomgraph.operators.graph import EDGE, GraphStore, first_wins, merge_edges, merge_properties
from loomgraph.operators.skew import heavy_keys, lookup_join
from loomgraph.operators.terms import match_terms
from loomgraph.session import cut

GUIDELINE_PROPERTIES = ("guideline_id", "family", "organization", "publication_date", "journal", "pages", "source_json_path", "source_pdf_path")


def props(**values: Column) -> Column:
    """A property map; null values keep their key."""
    pairs = [x for k, v in values.items() for x in (F.lit(k), json_value(v))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def node(label: str, node_id: Column, name: Column, properties: Column) -> list[Column]:
    return [node_id.alias("node_id"), F.lit(label).alias("label"), name.alias("name"), properties.alias("properties")]


def edge(source: Column, relation: Column | str, target: Column, properties: Column, apart: Column | None = None) -> list[Column]:
    """Columns of an edge; ``apart`` tells edges apart that have the same ends and relation."""
    rel = F.lit(relation) if isinstance(relation, str) else relation
    key = ids.make_id("edge", source, rel, target, *([] if apart is None else [apart]))
    return [key.alias("edge_id"), source.alias("source_id"), target.alias("target_id"), rel.alias("relation"), properties.alias("properties")]


def _order(phase: int, *by: Column) -> Column:
    filled = [*by, *[F.lit("")] * (3 - len(by))]
    return F.struct(F.lit(phase).alias("phase"), *(c.cast("string").alias(f"by{i}") for i, c in enumerate(filled))).alias("ord")


def _padded(seq: Column) -> Column:
    return F.lpad(seq.cast("string"), 20, "0")


SOURCE_COLUMNS = ("guideline_title", "source_json_path", "source_pdf_path")


def with_sources(snippets: DataFrame, guidelines: DataFrame) -> DataFrame:
    """Snippets (cut) with their guideline's title and paths; a guideline with many snippets is joined by broadcast."""
    about = guidelines.select("guideline_id", F.col("title").alias("guideline_title"), "source_json_path", "source_pdf_path")
    heavy = cut(heavy_keys(snippets, "guideline_id", snippets.count()))
    return lookup_join(snippets.drop(*SOURCE_COLUMNS), about, "guideline_id", heavy)


def snippet_nodes(snippets: DataFrame) -> DataFrame:
    """Nodes of snippets that went through ``with_sources``."""
    c = F.col
    values = {n: c(n) for n in ("text", "snippet_type", "guideline_id", "section_path", "page", "json_pointer", *SOURCE_COLUMNS)}
    return snippets.select("guideline_id", _order(1, _padded(c("seq"))), *node("Snippet", c("snippet_id"), F.substring("text", 1, 80), props(**values)))


def section_nodes(snippets: DataFrame) -> DataFrame:
    path = F.coalesce("section_path", F.array().cast("array<string>"))
    at = ids.section_id(F.col("guideline_id"), path)
    return snippets.select(
        "guideline_id", _order(1, _padded(F.col("seq"))), *node("Section", at, ids.section_name(path), props(guideline_id=F.col("guideline_id"), section_path=path))
    )


def section_edges(snippets: DataFrame) -> DataFrame:
    path = F.coalesce("section_path", F.array().cast("array<string>"))
    at = ids.section_id(F.col("guideline_id"), path)
    return snippets.select("guideline_id", _order(1, _padded(F.col("seq"))), *edge(F.col("snippet_id"), "LOCATED_IN_SECTION", at, props(page=F.col("page"))))


def guideline_edges(snippets: DataFrame) -> DataFrame:
    at = F.concat(F.lit("guideline:"), F.col("guideline_id"))
    return snippets.select(
        "guideline_id", _order(1, _padded(F.col("seq"))), *edge(F.col("snippet_id"), "FROM_GUIDELINE", at, props(guideline_id=F.col("guideline_id")))
    )


def mention_edges(mentions: DataFrame, snippets: DataFrame) -> DataFrame:
    """Gene to each snippet of its mention's content item; mentions without an item join nothing."""
    left = mentions.select("guideline_id", "gene_symbol", "content_index").where(F.col("content_index").isNotNull()).distinct()
    both = left.join(snippets.select("guideline_id", "content_index", "snippet_id").distinct(), ["guideline_id", "content_index"])
    gene = ids.gene_id(F.col("gene_symbol"))
    return both.select("guideline_id", _order(2, gene, F.col("snippet_id")), *edge(gene, "GENE_MENTIONED_IN", F.col("snippet_id"), props(source=F.lit("raw_gene_mentions"))))


def mention_condition_edges(mentions: DataFrame) -> DataFrame:
    """Gene to each condition that a mention names; mentions with other contexts give other edges."""
    rows = mentions.select("guideline_id", "gene_symbol", "context", F.explode("associated_conditions").alias("condition")).where(F.col("condition").isNotNull())
    gene, at = ids.gene_id(F.col("gene_symbol")), ids.entity_id("Condition", F.col("condition"))
    return rows.select("guideline_id", _order(2, gene, at), *edge(gene, "ASSOCIATED_WITH_CONDITION", at, props(context=F.col("context")), F.col("context")))


def document_terms(mentions: DataFrame, terms: DataFrame) -> DataFrame:
    """Dictionary terms for all documents, and each document's own mentioned genes and conditions."""
    own = mentions.select("guideline_id", F.lit("gene").alias("kind"), F.col("gene_symbol").alias("term")).unionByName(
        mentions.select("guideline_id", F.lit("condition").alias("kind"), F.explode("associated_conditions").alias("term"))
    )
    wanted = terms.where(F.col("kind").isin("gene", "condition", "biomarker", "drug")).select("guideline_id", "kind", "term")
    return wanted.unionByName(own).where(F.col("term").isNotNull() & (F.col("term") != "")).distinct()


def co_occurrence_edges(matches: DataFrame, kind: str, label: str, relation: str) -> DataFrame:
    """Gene to each term of ``kind`` that is found in the same snippet."""
    genes = matches.where(F.col("kind") == "gene").select("snippet_id", "guideline_id", ids.gene_id(F.col("term")).alias("gene")).distinct()
    others = matches.where(F.col("kind") == kind).select("snippet_id", ids.entity_id(label, F.col("term")).alias("other")).distinct()
    both = genes.join(others, "snippet_id")
    return both.select(
        "guideline_id", _order(3, F.col("snippet_id"), F.col("gene"), F.col("other")), *edge(F.col("gene"), relation, F.col("other"), props(snippet_id=F.col("snippet_id")), F.col("snippet_id"))
    )


def match_gene_edges(matches: DataFrame) -> DataFrame:
    genes = matches.where(F.col("kind") == "gene").select("snippet_id", "guideline_id", ids.gene_id(F.col("term")).alias("gene")).distinct()
    return genes.select("guideline_id", _order(3, F.col("snippet_id"), F.col("gene")), *edge(F.col("gene"), "GENE_MENTIONED_IN", F.col("snippet_id"), props(source=F.lit("snippet_match"))))


def _field(name: str) -> Column:
    raw = F.col("raw_fields")[name]
    return F.when(raw.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), raw, F.lit("}")), "$.v"))


def recommendations(snippets: DataFrame, extended: bool = False) -> DataFrame:
    """Snippets that recommend: recommendation_id, evidence_class, evidence_level, relation to drugs, and their source."""
    text = F.col("text")
    return snippets.where(is_recommendation(F.col("snippet_type"), text) & text.isNotNull()).select(
        "guideline_id",
        "snippet_id",
        "seq",
        "section_path",
        "page",
        "text",
        ids.recommendation_id(F.col("guideline_id"), text).alias("recommendation_id"),
        evidence_class(_field("Class of Recommendation"), text, extended).alias("evidence_class"),
        evidence_level(_field("Level of Evidence"), text).alias("evidence_level"),
        F.when(is_against(text), F.lit("CONTRAINDICATED_FOR")).otherwise(F.lit("RECOMMENDS")).alias("relation"),
    )


def recommendation_nodes(recs: DataFrame) -> DataFrame:
    values = {n: F.col(n) for n in ("text", "guideline_id", "section_path", "page", "evidence_class", "evidence_level")}
    return recs.select("guideline_id", _order(3, _padded(F.col("seq"))), *node("Recommendation", F.col("recommendation_id"), F.substring("text", 1, 80), props(**values)))


def support_edges(recs: DataFrame) -> DataFrame:
    own = props(snippet_id=F.col("snippet_id"))
    return recs.select("guideline_id", _order(3, _padded(F.col("seq"))), *edge(F.col("recommendation_id"), "SUPPORTED_BY_SNIPPET", F.col("snippet_id"), own))


def evidence_edges(recs: DataFrame, column: str, label: str, relation: str) -> DataFrame:
    rows = recs.where(F.col(column).isNotNull())
    return rows.select("guideline_id", _order(3, _padded(F.col("seq"))), *edge(F.col("recommendation_id"), relation, ids.entity_id(label, F.col(column)), props()))


def recommendation_term_edges(recs: DataFrame, matches: DataFrame) -> DataFrame:
    """Genes found in a recommendation's text, and drugs with the recommendation's attitude to them."""
    found = recs.drop("guideline_id", "text").join(matches, "snippet_id")
    own, rec = props(snippet_id=F.col("snippet_id")), F.col("recommendation_id")
    gene, drug = ids.gene_id(F.col("term")), ids.entity_id("Drug", F.col("term"))
    genes = found.where(F.col("kind") == "gene").select("guideline_id", _order(3, _padded(F.col("seq")), gene), *edge(gene, "REFERENCED_IN_RECOMMENDATION", rec, own))
    drugs = found.where(F.col("kind") == "drug").select("guideline_id", _order(3, _padded(F.col("seq")), drug), *edge(rec, F.col("relation"), drug, own))
    return genes.unionByName(drugs)


def gene_nodes(rows: DataFrame) -> DataFrame:
    """Gene nodes of (guideline_id, term)."""
    symbol = F.upper("term")
    return rows.distinct().select("guideline_id", _order(2, symbol), *node("Gene", ids.gene_id(F.col("term")), symbol, props(gene_symbol=symbol)))


def named_nodes(label: str, rows: DataFrame) -> DataFrame:
    """Nodes of the entities of one label, of (guideline_id, term)."""
    name = ids.strip(F.col("term"))
    return rows.distinct().select("guideline_id", _order(3, name), *node(label, ids.entity_id(label, name), name, props(canonical_name=name)))


def mentioned_conditions(mentions: DataFrame) -> DataFrame:
    return mentions.select("guideline_id", F.explode("associated_conditions").alias("term")).where(F.col("term").isNotNull())


def mention_nodes(mentions: DataFrame) -> DataFrame:
    """Gene and condition nodes of mentions: the ends of ``mention_edges`` and ``mention_condition_edges``."""
    genes = mentions.select("guideline_id", F.col("gene_symbol").alias("term"))
    return gene_nodes(genes).unionByName(named_nodes("Condition", mentioned_conditions(mentions)))


def entity_nodes(matches: DataFrame, mentions: DataFrame, recs: DataFrame) -> DataFrame:
    """Gene, condition, biomarker, drug and evidence nodes. Of matches only those that an edge can lead to."""
    with_gene = matches.where(F.col("kind") == "gene").select("snippet_id")
    usable = matches.join(with_gene.distinct(), "snippet_id", "left_semi").where(F.col("kind").isin("condition", "biomarker"))
    drugs = matches.where(F.col("kind") == "drug").join(recs.select("snippet_id").distinct(), "snippet_id", "left_semi")
    genes = mentions.select("guideline_id", F.col("gene_symbol").alias("term")).unionByName(matches.where(F.col("kind") == "gene").select("guideline_id", "term"))
    out = gene_nodes(genes)
    for label, rows in (
        ("Condition", mentioned_conditions(mentions).unionByName(usable.where(F.col("kind") == "condition").select("guideline_id", "term"))),
        ("Biomarker", usable.where(F.col("kind") == "biomarker").select("guideline_id", "term")),
        ("Drug", drugs.select("guideline_id", "term")),
        ("EvidenceClass", recs.select("guideline_id", F.col("evidence_class").alias("term")).where(F.col("term").isNotNull())),
        ("EvidenceLevel", recs.select("guideline_id", F.col("evidence_level").alias("term")).where(F.col("term").isNotNull())),
    ):
        out = out.unionByName(named_nodes(label, rows))
    return out


def guideline_nodes(guidelines: DataFrame) -> DataFrame:
    values = {n: F.col(n) for n in GUIDELINE_PROPERTIES}
    return guidelines.select("guideline_id", _order(0), *node("Guideline", F.concat(F.lit("guideline:"), F.col("guideline_id")), F.col("title"), props(**values)))


def assemble_nodes(node_rows: DataFrame) -> DataFrame:
    firsts = first_wins(node_rows.select("guideline_id", "node_id", "ord", F.struct("label", "name").alias("v")), ["guideline_id", "node_id"], "ord")
    named = firsts.groupBy("node_id").agg(F.max_by("v", "guideline_id").alias("v"))
    laid = merge_properties(node_rows.withColumn("o", F.struct("guideline_id", "ord")), ["node_id"], "o")
    return named.join(laid, "node_id").select("node_id", "v.label", "v.name", "properties")


def assemble_edges(edge_rows: DataFrame) -> DataFrame:
    return merge_edges(first_wins(edge_rows, ["guideline_id", "edge_id"], "ord"), "guideline_id")


def assemble(node_rows: DataFrame, edge_rows: DataFrame) -> GraphStore:
    """Merge rows to a graph: within a document the first name and edge count and the last value of each property;
    between documents, in order of guideline_id, the last of all three."""
    return GraphStore(assemble_nodes(node_rows), assemble_edges(edge_rows))


@dataclass(frozen=True)
class Found:
    """What is found in documents, the ground of node and edge rows. Snippets and mentions should be cut."""

    guidelines: DataFrame
    snippets: DataFrame
    mentions: DataFrame
    matches: DataFrame

    @classmethod
    def of(cls, guidelines: DataFrame, snippets: DataFrame, mentions: DataFrame, terms: DataFrame) -> Found:
        """Expects one row per guideline, chunked snippets with ids, and merged mentions with upper-case symbols; rows
        without guideline_id are left out. All three are read several times and should be cut."""
        guidelines, snippets, mentions = (d.where(F.col("guideline_id").isNotNull()) for d in (guidelines, snippets, mentions))
        snippets = snippets.where(F.col("text").isNotNull() & F.col("snippet_id").isNotNull())
        mentions = mentions.where(F.col("gene_symbol").isNotNull())
        found = match_terms(snippets, document_terms(mentions, terms))
        return cls(guidelines, snippets, mentions, cut(found.join(snippets.select("snippet_id", "guideline_id").distinct(), "snippet_id")))

    def node_rows(self) -> DataFrame:
        snippets = cut(with_sources(self.snippets, self.guidelines))
        recs = cut(recommendations(snippets))
        nodes = guideline_nodes(self.guidelines)
        for part in (snippet_nodes(snippets), section_nodes(snippets), entity_nodes(self.matches, self.mentions, recs), recommendation_nodes(recs)):
            nodes = nodes.unionByName(part)
        return nodes

    def _recs(self) -> DataFrame:
        return cut(recommendations(self.snippets).drop("text", "section_path", "page"))

    def edge_rows(self) -> DataFrame:
        recs = self._recs()
        edges = _snippet_edges(self.snippets, self.mentions, self.matches, recs)
        for part in _shared_edges(self.mentions, self.matches, recs):
            edges = edges.unionByName(part)
        return edges

    def edges(self) -> DataFrame:
        """The edges that ``assemble`` makes of ``edge_rows``, most of them without merging.

        The id of an edge that names a snippet holds the snippet's id, so where that is the id of one row only, such
        edges meet no others but those of the same snippet: they are made as they are. Edges of other snippets, and
        those between entities, are merged.
        """
        recs = self._recs()
        odd = cut(shared_ids(self.snippets, self.mentions))
        edges = None
        for part in _shared_edges(self.mentions, self.matches, recs):
            edges = part if edges is None else edges.unionByName(part)
        snippets, matches, own_recs = self.snippets, self.matches, recs
        if not odd.isEmpty():
            some = lambda d: d.join(odd, "snippet_id", "left_semi")
            edges = edges.unionByName(_snippet_edges(some(snippets), self.mentions, some(matches), some(recs)))
            snippets, matches, own_recs = (d.join(odd, "snippet_id", "left_anti") for d in (snippets, matches, recs))
        edges = assemble_edges(edges)
        for part in (guideline_edges(snippets), section_edges(snippets), support_edges(own_recs), *_settled_edges(snippets, self.mentions, matches)):
            edges = edges.unionByName(part.select(*EDGE))
        return edges


def _snippet_edges(snippets: DataFrame, mentions: DataFrame, matches: DataFrame, recs: DataFrame) -> DataFrame:
    """Rows of the edges that name a snippet."""
    edges = guideline_edges(snippets)
    for part in (
        section_edges(snippets),
        mention_edges(mentions, snippets),
        match_gene_edges(matches),
        co_occurrence_edges(matches, "condition", "Condition", "ASSOCIATED_WITH_CONDITION"),
        co_occurrence_edges(matches, "biomarker", "Biomarker", "CO_MENTIONED_WITH"),
        support_edges(recs),
    ):
        edges = edges.unionByName(part)
    return edges


def _shared_edges(mentions: DataFrame, matches: DataFrame, recs: DataFrame) -> list[DataFrame]:
    """Rows of the edges that several snippets can give."""
    return [
        mention_condition_edges(mentions),
        evidence_edges(recs, "evidence_class", "EvidenceClass", "HAS_EVIDENCE_CLASS"),
        evidence_edges(recs, "evidence_level", "EvidenceLevel", "HAS_EVIDENCE_LEVEL"),
        recommendation_term_edges(recs, matches),
    ]


def shared_ids(snippets: DataFrame, mentions: DataFrame) -> DataFrame:
    """snippet_id of the snippets whose id counts, in the ids of edges, as that of another row or as a mention's context."""
    keyed = snippets.select("snippet_id", ids.strip(F.col("snippet_id")).alias("at"))
    several = keyed.groupBy("at").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | (F.col("at") == "")).select("at")
    contexts = mentions.select(ids.strip(F.col("context")).alias("at")).where(F.col("at").isNotNull()).distinct()
    return keyed.join(several.unionByName(contexts), "at", "left_semi").select("snippet_id").distinct()


def _settled_edges(snippets: DataFrame, mentions: DataFrame, matches: DataFrame) -> list[DataFrame]:
    """``mention_edges``, ``match_gene_edges`` and ``co_occurrence_edges`` as they are once merged, of snippets whose ids
    are not shared. Of genes that count as one in an edge's id the first stays; a mention goes before a match."""
    key, first = ids.strip(F.col("gene")).alias("key"), F.min("gene").alias("gene")
    named = mentions.where(F.col("content_index").isNotNull()).select("guideline_id", "content_index", ids.gene_id(F.col("gene_symbol")).alias("gene"))
    named = cut(named.groupBy("guideline_id", "content_index", key).agg(first))
    places = snippets.select("guideline_id", "content_index", "snippet_id")
    genes = matches.where(F.col("kind") == "gene").select("snippet_id", ids.gene_id(F.col("term")).alias("gene")).groupBy("snippet_id", key).agg(first)
    more = genes.join(places, "snippet_id").join(named.select("guideline_id", "content_index", "key"), ["guideline_id", "content_index", "key"], "left_anti")
    at = ids.strip(F.col("snippet_id"))

    def linked(rows: DataFrame, relation: str, target: str, properties: Column, apart: bool) -> DataFrame:
        end = at if target == "snippet_id" else F.col(target)
        edge_id = F.concat(F.lit("edge:"), ids.stripped_hash(F.lit("edge"), F.col("key"), F.lit(relation), end, *([at] if apart else [])))
        return rows.select(edge_id.alias("edge_id"), F.col("gene").alias("source_id"), F.col(target).alias("target_id"), F.lit(relation).alias("relation"), properties.alias("properties"))

    out = [linked(_item_pairs(named, places), "GENE_MENTIONED_IN", "snippet_id", props(source=F.lit("raw_gene_mentions")), False)]
    out.append(linked(more, "GENE_MENTIONED_IN", "snippet_id", props(source=F.lit("snippet_match")), False))
    for kind, label, relation in (("condition", "Condition", "ASSOCIATED_WITH_CONDITION"), ("biomarker", "Biomarker", "CO_MENTIONED_WITH")):
        others = matches.where(F.col("kind") == kind).select("snippet_id", ids.entity_id(label, F.col("term")).alias("other")).distinct()
        out.append(linked(genes.join(others, "snippet_id"), relation, "other", props(snippet_id=F.col("snippet_id")), True))
    return out


#: Pairs of genes and snippets that a part of a content item gives, about; and that a task gives.
ITEM_PAIRS, TASK_PAIRS = 20_000, 400_000


def _item_pairs(named: DataFrame, places: DataFrame) -> DataFrame:
    """Each gene of a content item with each of its snippets. Their number is the product of both, so the snippets of a
    large item are dealt out to parts, and there are as many tasks as the pairs need, not the rows."""
    item = ["guideline_id", "content_index"]
    n = F.count(F.lit(1))
    pairs = named.groupBy(*item).agg(n.alias("g")).join(places.groupBy(*item).agg(n.alias("s")), item).withColumn("n", F.col("g") * F.col("s"))
    sizes = cut(pairs.select(*item, "n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    large = sizes.where(F.col("n") > ITEM_PAIRS).select(*item, F.ceil(F.col("n") / ITEM_PAIRS).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    dealt = places.join(large, item, "left").select(*item, "snippet_id", F.pmod(F.xxhash64("snippet_id"), parts).cast("int").alias("part"))
    copied = named.join(large, item, "left").select(*item, "key", "gene", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    tasks = max(total // TASK_PAIRS + 1, places.sparkSession.sparkContext.defaultParallelism)
    by = [*item, "part"]
    return dealt.repartition(tasks, *by).join(copied.repartition(tasks, *by), by).select("key", "gene", "snippet_id")


def extract_graph(guidelines: DataFrame, snippets: DataFrame, mentions: DataFrame, terms: DataFrame) -> GraphStore:
    """The graph of all documents in one plan, see ``Found``."""
    found = Found.of(guidelines, snippets, mentions, terms)
    return GraphStore(assemble_nodes(found.node_rows()), found.edges())


def extract_rows(guidelines: DataFrame, snippets: DataFrame, mentions: DataFrame, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node and edge rows of all documents, to be merged by ``assemble``, see ``Found``."""
    found = Found.of(guidelines, snippets, mentions, terms)
    return found.node_rows(), found.edge_rows()
