import difflib

from pyspark.sql import functions as F

from loomgraph.operators.graph import EDGE_SCHEMA, NODE_SCHEMA, GraphStore, merge_edges, merge_nodes
from loomgraph.operators.normalize import merge_mentions
from loomgraph.operators.retrieval import GeneContext, rerank, resolve_exact, resolve_fuzzy
from loomgraph.operators.terms import match_terms
from loomgraph.operators.tfidf import TfidfIndex


def store(spark, nodes, edges):
    n = spark.createDataFrame([(i, lab, name, p) for i, lab, name, p in nodes], NODE_SCHEMA)
    return GraphStore(n, spark.createDataFrame(edges, EDGE_SCHEMA))


def chain(spark):
    nodes = [(x, "N", x.upper(), {}) for x in "abcdeq"]
    edges = [("1", "a", "b", "R", {}), ("2", "b", "c", "R", {}), ("3", "c", "a", "S", {}), ("4", "c", "d", "R", {}), ("5", "d", "e", "R", {}), ("6", "b", "b", "R", {})]
    return store(spark, nodes, edges)


def test_merge_last_wins_with_nulls(spark):
    rows = spark.createDataFrame(
        [("n", "A", "x", {"p": "1", "q": "1"}, 1), ("n", "B", "y", {"p": None, "name": "no"}, 2), ("n", "B", "y", {"p": None, "name": "no"}, 0), ("m", None, None, None, 1), (None, "A", "x", {}, 9)],
        NODE_SCHEMA + ", o int",
    )
    got = {r.node_id: r for r in merge_nodes(rows, "o").collect()}
    assert set(got) == {"n", "m"} and (got["n"].label, got["n"].name, got["n"].properties) == ("B", "y", {"p": None, "q": "1"}) and got["m"].properties == {}
    edges = spark.createDataFrame([("e", "a", "b", "R", {"k": "1"}, 1), ("e", "a", "b", "S", {"l": "2"}, 2), ("e", None, "b", "S", {}, 3)], EDGE_SCHEMA + ", o int")
    got = merge_edges(edges, "o").collect()
    assert [(r.relation, r.properties) for r in got] == [("S", {"k": "1", "l": "2"})]


def test_lookup_and_neighbourhood(spark):
    g = chain(spark)
    assert {r.edge_id for r in g.get_edges("b").collect()} == {"1", "2", "6"}
    assert {r.edge_id for r in g.get_edges("b", direction="in").collect()} == {"1", "6"}
    assert {r.edge_id for r in g.get_edges("c", "S", "out").collect()} == {"3"}
    try:
        g.get_edges("b", direction="up")
        raise AssertionError
    except ValueError:
        pass
    k = g.k_hop("a", 1)
    assert {r.node_id for r in k.nodes.collect()} == {"a", "b", "c"} and {r.edge_id for r in k.edges.collect()} == {"1", "2", "3", "6"}
    p = g.k_hop_paths("a", 1)
    assert {r.edge_id for r in p.edges.collect()} == {"1", "3"}
    assert g.k_hop("zz").nodes.count() == 0 and g.k_hop("q").nodes.count() == 1 and g.k_hop_paths("q").nodes.count() == 0


def test_upsert_modes(spark):
    g = chain(spark)
    more = store(spark, [("a", "N", "new", {"k": None})], [("9", "a", "ghost", "R", {})])
    file_like = g.upsert(more.nodes, more.edges)
    assert {r.name for r in file_like.get_node("a").collect()} == {"new"} and file_like.get_node("ghost").count() == 1 and file_like.edges.count() == 7
    strict = g.upsert(more.nodes, more.edges, require_endpoints=True)
    assert strict.edges.count() == 6 and strict.get_node("a").first().properties == {}


def gene_graph(spark):
    j = lambda s: f'"{s}"'
    nodes = [
        ("gene:G", "Gene", "G", {}), ("gene:H", "Gene", "H", {}), ("s1", "Snippet", "t", {"text": j("statin helps"), "page": j("9")}), ("s2", "Snippet", "t", {"text": j("other"), "page": "null"}),
        ("s3", "Snippet", "t", {"text": j("of H only")}), ("c", "Condition", "cond", {}), ("r", "Recommendation", "rec", {"text": j("take"), "evidence_class": j("I")}), ("d", "Drug", "statin", {}), ("gl", "Guideline", "Title", {}),
    ]
    edges = [
        ("1", "gene:G", "s1", "GENE_MENTIONED_IN", {}), ("2", "gene:G", "c", "ASSOCIATED_WITH_CONDITION", {"snippet_id": j("s1")}), ("3", "gene:H", "c", "ASSOCIATED_WITH_CONDITION", {}),
        ("4", "gene:H", "s3", "GENE_MENTIONED_IN", {}), ("5", "gene:G", "r", "REFERENCED_IN_RECOMMENDATION", {}), ("6", "r", "s2", "SUPPORTED_BY_SNIPPET", {}), ("7", "r", "d", "RECOMMENDS", {}),
        ("8", "s2", "gl", "FROM_GUIDELINE", {}), ("9", "s1", "s2", "OTHER", {}),
    ]
    return store(spark, nodes, edges)


def test_context_does_not_leak_through_conditions(spark):
    g = gene_graph(spark)
    c = GeneContext.of(g, spark.createDataFrame([("gene:G",)], "gene_id string"))
    assert {r.edge_id for r in c.edges.collect()} == {"1", "2", "5", "6", "7", "8"}
    assert [(r.snippet_id, r.page) for r in c.supporting_snippets().collect()] == [("s2", None), ("s1", "9")]
    rec = c.recommendations().collect()[0]
    assert (rec.drugs, rec.conditions, rec.supporting_snippet_ids, rec.evidence_class) == (["statin"], [], ["s2"], "I")
    assert [r.snippet_ids for r in c.related("Condition").collect()] == [["s1"]]
    assert c.summary().first().summary == "G appears in 1 guideline(s). Top linked conditions: cond. Extracted recommendation evidence classes: I."
    both = GeneContext.of(g, g.list_nodes("Gene").select(F.col("node_id").alias("gene_id")))
    assert {(r.gene_id, r.edge_id) for r in both.edges.where("gene_id = 'gene:H'").collect()} == {("gene:H", "3"), ("gene:H", "4")}


def test_resolve(spark):
    names = ["LDLR", "LDLRAP1", "APOE", "APOB", "PCSK9", "ldlr2"]
    g = store(spark, [(f"gene:{n}", "Gene", n, {}) for n in names], [])
    assert resolve_exact(g.nodes, " apoe ").first().gene_symbol == "APOE"
    for q in ("LDRL", "APO", "PCKS9", "zzz"):
        close = difflib.get_close_matches(q.upper(), names, 5, 0.6)
        want = sorted(((difflib.SequenceMatcher(None, q.upper(), n.upper()).ratio(), n) for n in close), reverse=True)
        got = [(r.score, r.gene_symbol) for r in resolve_fuzzy(g.nodes, q).collect()]
        assert sorted(got, reverse=True) == want and [s for s, _ in got] == [s for s, _ in want]


def test_rerank(spark):
    s = spark.createDataFrame([("a", "the big statin question"), ("b", "statin"), ("c", "statin"), ("d", "x")], "snippet_id string, text string")
    assert [r.snippet_id for r in rerank(s, "Statin question", 3).collect()] == ["a", "c", "b"]
    assert rerank(s, "?", 1).count() == 4


def test_terms_of_every_shape(spark):
    texts = spark.createDataFrame([("1", "g", "LDL-C and éstatin, Lipoprotein(a)x; heart failures"), ("2", "h", "STATIN. gene-x"), ("3", None, None), ("4", "g", "")], "snippet_id string, guideline_id string, text string")
    terms = spark.createDataFrame(
        [(None, "b", "ldl-c"), (None, "d", "statin"), (None, "b", "lipoprotein(a)"), (None, "c", "heart failure"), ("h", "g", "gene-x"), ("g", "g", "gene-x"), (None, "x", None), (None, "x", ""), (None, "x", "t f")],
        "guideline_id string, kind string, term string",
    )
    want = {("1", "ldl-c"), ("1", "lipoprotein(a)"), ("1", "heart failure"), ("1", "t f"), ("2", "statin"), ("2", "gene-x")}
    assert {(r.snippet_id, r.term) for r in match_terms(texts, terms).collect()} == want


def test_terms_stay_in_their_guideline(spark):
    """One gene that all guidelines mention, in all of their texts, and terms of one, two and many signs."""
    texts = spark.createDataFrame([(f"{g}/{i}", f"g{g}", f"Carriers of ABCD1 in cohort {i}, 高血圧 and type-{g}") for g in range(20) for i in range(5)] + [(None, "g1", "ABCD1"), ("n", None, "ABCD1")], "snippet_id string, guideline_id string, text string")
    terms = spark.createDataFrame(
        [(f"g{g}", "gene", "abcd1") for g in range(20)] + [("g3", "x", "血"), ("g4", "x", "血圧"), (None, "x", "高血圧"), ("g5", "x", "cohort 1"), ("g6", "x", "type-6"), ("g7", "x", "type-6")],
        "guideline_id string, kind string, term string",
    )
    want = {(f"{g}/{i}", t) for g in range(20) for i in range(5) for t in ("abcd1", "高血圧")} | {(f"3/{i}", "血") for i in range(5)} | {(f"4/{i}", "血圧") for i in range(5)}
    want |= {("5/1", "cohort 1")} | {(f"6/{i}", "type-6") for i in range(5)}
    got = [(r.snippet_id, r.term) for r in match_terms(texts, terms).collect()]
    assert set(got) == want and len(got) == len(want)
    assert match_terms(texts, terms.limit(0)).count() == 0 and match_terms(texts.limit(0), terms).count() == 0


def test_mentions_merge(spark):
    rows = spark.createDataFrame(
        [(1, "g", "A", ["z", "a"], 0, None, None), (2, "g", "A", ["b", None], 3, None, None), (3, "g", "A", None, 0, "c", 1), (4, "g", "A", None, 0, "c", 1), (5, "g", "B", ["q", "q"], 0, None, None)],
        "row_id int, guideline_id string, gene_symbol string, associated_conditions array<string>, occurrences int, context string, content_index int",
    )
    got = {r.row_id: (r.associated_conditions, r.occurrences) for r in merge_mentions(rows, ["guideline_id"], "row_id").collect()}
    assert got == {1: (["a", "b", "z"], 3), 3: ([], None), 5: (["q", "q"], 0)}


def test_tfidf(spark, tmp_path):
    texts = spark.createDataFrame([("1", "heart failure drug"), ("2", "heart heart"), ("3", "é"), ("4", None)], "snippet_id string, text string")
    index = TfidfIndex.fit(texts)
    assert abs(index.idf.where("term = 'heart'").first().idf - 1.5108256) < 1e-6
    assert [r.snippet_id for r in index.search("failure drug").collect()] == ["1"]
    assert index.search("nothing known").count() == 0
    norms = index.postings.groupBy("snippet_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-9 for r in norms) and {r.snippet_id for r in norms} == {"1", "2"}
    index.save(str(tmp_path / "i"))
    assert TfidfIndex.load(spark, str(tmp_path / "i")).search("heart", 1).first().snippet_id == "2"
    assert TfidfIndex.load(spark, str(tmp_path / "none")) is None
