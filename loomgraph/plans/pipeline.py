"""The pipeline from JSON files to a graph and an index, and the answers from them."""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import ids
from loomgraph.operators.chunk import chunk_snippets
from loomgraph.operators.extract import (
    assemble,
    extract_rows,
    guideline_edges,
    guideline_nodes,
    mention_condition_edges,
    mention_edges,
    mention_nodes,
    section_edges,
    section_nodes,
    snippet_nodes,
    with_sources,
)
from loomgraph.operators.graph import GraphStore, first_wins
from loomgraph.operators.normalize import normalize
from loomgraph.operators.retrieval import GeneContext, rerank, resolve_exact, resolve_fuzzy
from loomgraph.operators.structured import candidate_snippets, predict, prediction_edges, prediction_nodes
from loomgraph.operators.tfidf import TfidfIndex
from loomgraph.session import cut, scratch, ship_package
from loomgraph.settings import Settings
from loomgraph.sources import manifest
from loomgraph.sources.database import read_database, write_database
from loomgraph.sources.documents import document_shape, read_documents, read_lexicon, with_sidecars
from loomgraph.sources.sinks import read_graph, write_graph, write_normalized

TABLES = ("documents", "snippets", "gene_mentions", "rejected")
Connect = Callable[[], Callable[[str, dict], list[dict]]]


def chosen_predictor(extractor: str) -> Callable[[], Callable[[dict], dict]] | None:
    """What settings.extractor names: ``heuristic`` (the dictionaries, None) or ``module:function``, a predictor's maker."""
    if extractor == "heuristic":
        return None
    module, _, name = extractor.partition(":")
    if not module or not name:
        raise ValueError(f"unknown extractor {extractor!r}")
    return getattr(importlib.import_module(module), name)


class Pipeline:
    """One method per command. Stages hand over through tables in ``settings.work_folder``, so a run can be resumed.

    A predictor that is given goes before the one that ``settings.extractor`` names. With ``settings.backend`` =
    ``database`` the graph is kept in a graph database that ``connect`` reaches (see sources/database), else in files.
    """

    def __init__(self, spark: SparkSession, settings: Settings, predictor: Callable[[], Callable[[dict], dict]] | None = None, connect: Connect | None = None) -> None:
        self.spark, self.settings = spark, settings
        self.predictor = predictor or chosen_predictor(settings.extractor)
        if settings.backend not in ("files", "database"):
            raise ValueError(f"unknown backend {settings.backend!r}")
        if settings.backend == "database" and connect is None:
            raise ValueError("the database backend needs connect")
        self.connect = connect
        ship_package(spark)

    def _graph(self) -> GraphStore:
        return read_database(self.spark, self.connect) if self.settings.backend == "database" else read_graph(self.spark, self.settings.at("graph"))

    def _state(self) -> DataFrame:
        return manifest.load(self.spark, self.settings.at("manifest"))

    def _read(self, table: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.settings.at("normalized", table))
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise

    @scratch()
    def ingest(self, glob: str | None = None, limit: int | None = None, force: bool = False) -> int:
        """Register files that are not yet known; with ``force`` all of them, from the start. The number registered."""
        s = self.settings
        try:
            read = read_documents(self.spark, glob or s.input_glob, limit)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return 0
        found = with_sidecars(read, s.pdf_folder)
        rows = found.groupBy(F.col("guideline_id").alias("doc_id")).agg(F.min(F.struct("path", "source_pdf_path")).alias("f"))
        none = F.array().cast("array<string>")
        rows = rows.select(
            "doc_id", F.col("f.path").alias("source_json_path"), F.col("f.source_pdf_path").alias("source_pdf_path"), F.lit(s.family).alias("family"),
            F.create_map(F.lit("ingest"), F.lit("completed")).alias("stages"), none.alias("notes"),
        )
        state = self._state()
        new = cut(rows if force else rows.join(state.select("doc_id"), "doc_id", "left_anti"))
        manifest.save(manifest.upsert(state, new), s.at("manifest"))
        return new.count()

    @scratch()
    def normalize(self, glob: str | None = None, limit: int | None = None, force: bool = False) -> int:
        """Normalize the files that match and are pending; only their partitions are replaced. Their number."""
        s = self.settings
        if self.ingest(glob, limit, False) == 0 and self._state().isEmpty():
            return 0
        raw = read_documents(self.spark, glob or s.input_glob, limit).withColumn("doc_id", F.col("guideline_id"))
        todo = cut(manifest.pending(raw, self._state(), "normalize", force))
        n = todo.count()
        if n:
            tables = normalize(todo, s.family)
            for name in TABLES:
                write_normalized(tables[name], s.at("normalized", name))
            manifest.save(manifest.mark(self._state(), todo, "normalize"), s.at("manifest"))
        return n

    def terms(self) -> DataFrame:
        """The settings' dictionaries: guideline_id (null), kind, term."""
        s = self.settings
        rows = [(k, t) for k, ts in (("condition", s.conditions), ("biomarker", s.biomarkers), ("drug", s.drugs)) for t in ts]
        fixed = self.spark.createDataFrame(rows, "kind string, term string")
        both = fixed.unionByName(read_lexicon(self.spark, s.gene_lexicon).select(F.lit("gene").alias("kind"), "term"))
        return both.select(F.lit(None).cast("string").alias("guideline_id"), "kind", "term")

    def _rows(self) -> tuple[DataFrame, DataFrame] | None:
        """Node and edge rows of all normalized documents, by dictionaries or by the predictor; None without documents."""
        s = self.settings
        docs = self._read("documents")
        if docs is None:
            return None
        snippets = cut(chunk_snippets(self._read("snippets"), s.chunk_size, s.chunk_overlap))
        mentions = cut(self._read("gene_mentions"))
        pdfs = self._state().select(F.col("doc_id").alias("guideline_id"), "source_pdf_path")
        docs = cut(first_wins(docs, ["guideline_id"], "source_json_path").join(pdfs, "guideline_id", "left"))
        if self.predictor is None:
            return extract_rows(docs, snippets, mentions, self.terms())
        names = {k: list(getattr(s, k)) for k in ("conditions", "biomarkers", "drugs")}
        titled = cut(with_sources(snippets, docs))
        predicted = cut(predict(cut(candidate_snippets(titled, mentions)), self.predictor, names, mentions))
        nodes, edges = guideline_nodes(docs), guideline_edges(titled)
        for part in (snippet_nodes(titled), section_nodes(titled), mention_nodes(mentions), prediction_nodes(predicted)):
            nodes = nodes.unionByName(part)
        for part in (section_edges(titled), mention_edges(mentions, titled), mention_condition_edges(mentions), prediction_edges(predicted)):
            edges = edges.unionByName(part)
        return nodes, edges

    def extract(self) -> GraphStore:
        """The graph of all normalized documents."""
        rows = self._rows()
        return read_graph(self.spark, self.settings.at("no graph")) if rows is None else assemble(*rows)

    def build_graph(self, mode: str = "overwrite") -> dict[str, int]:
        """Build and write the graph; ``mode`` overwrite starts anew, upsert lays it over the graph that is there. A
        database is always laid over.

        Reported are the nodes and edges of the graph, and the sums of those of each document (``document_nodes``,
        ``document_edges``), in which what documents share counts once for each.
        """
        if mode not in ("overwrite", "upsert"):
            raise ValueError(f"unknown mode {mode!r}")
        with scratch():
            rows = self._rows()
            sums = {"document_nodes": 0, "document_edges": 0}
            if rows is None:
                built = read_graph(self.spark, self.settings.at("no graph"))
            else:
                node_rows, edge_rows = cut(rows[0]), cut(rows[1])
                sums = {f"document_{n}": d.select("guideline_id", k).distinct().count() for n, d, k in (("nodes", node_rows, "node_id"), ("edges", edge_rows, "edge_id"))}
                built = assemble(node_rows, edge_rows)
            if mode == "upsert" and self.settings.backend == "files":
                built = read_graph(self.spark, self.settings.at("graph")).upsert(built.nodes, built.edges)
            built = GraphStore(cut(built.nodes), cut(built.edges))
            if self.settings.backend == "database":
                write_database(built, self.connect)
            else:
                write_graph(built, self.settings.at("graph"))
            state = self._state()
            manifest.save(manifest.mark(state, state, "graph"), self.settings.at("manifest"))
            docs = self._read("documents")
            return {"documents": 0 if docs is None else docs.count(), "nodes": built.nodes.count(), "edges": built.edges.count(), **sums}

    def build_index(self) -> int:
        """Index the snippets as they were before chunking. Their number."""
        snippets = self._read("snippets")
        if snippets is None:
            return 0
        with scratch():
            return self._index(snippets)

    def _index(self, snippets: DataFrame) -> int:
        # texts that begin alike share a snippet_id, so the index goes by row
        texts = cut(snippets.select(F.concat_ws("#", "snippet_id", F.col("file_id").cast("string"), F.col("seq").cast("string")).alias("snippet_id"), "text"))
        TfidfIndex.fit(texts).save(self.settings.at("index"))
        return texts.count()

    def run(self, glob: str | None = None, limit: int | None = None, force: bool = False) -> dict[str, int]:
        report = {"normalized": self.normalize(glob, limit, force), **self.build_graph()}
        if self.settings.build_index:
            report["indexed"] = self.build_index()
        return report

    def resume(self, glob: str | None = None, limit: int | None = None) -> dict[str, int]:
        return self.run(glob, limit)

    @scratch()
    def validate(self, glob: str | None = None, limit: int = 2) -> dict:
        """Normalize the first ``limit`` files without writing; of each its title, numbers of rows and frequent keys.

        Invalid is an input without files, and one of which a file is no document; the reasons are given.
        """
        try:
            raw = read_documents(self.spark, glob or self.settings.input_glob, limit)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return {"valid": False, "error": "No input files found"}
        tables = normalize(raw, self.settings.family)
        docs = tables["documents"].select("file_id", F.col("guideline_id").alias("doc_id"), "title", F.slice("schema_hints", 1, 10).alias("schema_hints"))
        for name in ("snippets", "gene_mentions"):
            docs = docs.join(tables[name].groupBy("file_id").agg(F.count(F.lit(1)).alias(name)), "file_id", "left").fillna(0, [name])
        rows = [r.asDict() for r in docs.drop("file_id").orderBy("doc_id").collect()]  # at most ``limit`` rows
        bad = [r.asDict() for r in tables["rejected"].select("path", "reason").orderBy("path").collect()]
        if not rows and not bad:
            return {"valid": False, "error": "No input files found"}
        return {"valid": not bad, "documents": rows} | ({"rejected": bad} if bad else {})

    def search(self, question: str) -> DataFrame | None:
        """The best snippets for a question; None without an index."""
        index = TfidfIndex.load(self.spark, self.settings.at("index"))
        return None if index is None else index.search(question, self.settings.top_k).withColumn("snippet_id", F.substring_index("snippet_id", "#", 1))

    @scratch()
    def query_gene(self, gene: str, question: str | None = None) -> dict:
        """The answer about a gene: matches and the sections of its context, as small lists of rows."""
        store = self._graph()
        genes = cut(store.list_nodes("Gene"))
        answer: dict = {"query": gene, "resolved_gene": None, "match_type": None, "matches": []}
        if genes.isEmpty():
            return answer | {"summary": "No graph has been built yet."}
        matches = resolve_exact(genes, gene).collect() or resolve_fuzzy(genes, gene).collect()
        answer["matches"] = [r.asDict() for r in matches]
        if not matches:
            found = self.search(question) if question else None
            answer["supporting_snippets"] = [] if found is None else [r.asDict() for r in found.collect()]
            return answer | {"summary": "No matching gene found in the graph."}
        best = matches[0]
        c = GeneContext.of(store, self.spark.createDataFrame([(best["node_id"],)], "gene_id string"))
        context = GeneContext(cut(c.nodes), cut(c.edges))
        rows = lambda d: [r.asDict() for r in d.drop("gene_id").collect()]  # noqa: E731  one gene's context
        shown = {
            "guidelines": context.guidelines(), "conditions": context.related("Condition"), "biomarkers": context.related("Biomarker"), "drugs": context.related("Drug"),
            "recommendations": context.recommendations(), "supporting_snippets": context.supporting_snippets(),
        }
        if question:
            shown["supporting_snippets"] = rerank(shown["supporting_snippets"], question, self.settings.top_k)
        found = {name: rows(d) for name, d in shown.items()}
        return answer | {"resolved_gene": best["gene_symbol"], "match_type": best["match_type"], **found, "summary": rows(context.summary())[0]["summary"]}

    def subgraph(self, gene: str) -> GraphStore:
        """The context of a gene as a graph; empty if there is no such gene."""
        store = self._graph()
        genes = store.list_nodes("Gene")
        best = resolve_exact(genes, gene).collect() or resolve_fuzzy(genes, gene).collect()
        wanted = self.spark.createDataFrame([(r["node_id"],) for r in best[:1]], "gene_id string")
        c = GeneContext.of(store, wanted)
        return GraphStore(c.nodes.drop("gene_id"), c.edges.drop("gene_id"))

    @scratch()
    def inspect(self, path: str) -> dict:
        """What a document file holds: a normalized one as it is, another one normalized."""
        raw = read_documents(self.spark, path, 1)
        first = raw.select("body", F.expr(document_shape("body")).alias("shape")).first()
        if first is not None and first["shape"] == "normalized":
            return json.loads(first["body"])
        tables = normalize(raw, self.settings.family)
        rows = lambda name, *by: [r.asDict(recursive=True) for r in tables[name].drop("file_id").orderBy(*by).collect()]  # noqa: E731  one document
        about = rows("documents", "guideline_id")
        found = {"doc_id": self.spark.range(1).select(ids.doc_id(F.lit(path))).first()[0], "metadata": about[0] if about else None}
        return found | {"snippets": rows("snippets", "seq"), "gene_mentions": rows("gene_mentions", "seq"), "rejected": rows("rejected", "path")}
