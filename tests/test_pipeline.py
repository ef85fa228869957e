import json
import re

import pytest

from loomgraph import cli
from loomgraph.operators.graph import NODE_SCHEMA, GraphStore
from loomgraph.operators.normalize import normalize, walk_body
from loomgraph.plans.pipeline import Pipeline
from loomgraph.settings import Settings, deep_merge, find_root, load_settings
from loomgraph.sources import manifest
from loomgraph.sources.database import read_database, write_database
from loomgraph.sources.sinks import read_node_link, write_subgraph, write_to_database
from loomgraph.streaming.ingest import follow

DOC = {
    "content": [
        {"content": {"title": "Sample guideline on lipid care", "organization": "A panel of invented experts on lipids", "Date": "2031"}},
        {
            "content": {
                "Sections": [
                    {
                        "Section": "Markers and genomics",
                        "Page": 145,
                        "Recommendations": [{"Recommendation": "Statin therapy is recommended for carriers of TESTA1.", "Class of Recommendation": "Class I", "Level of Evidence": "LOE B-R"}],
                    }
                ]
            },
            "genes": [{"Gene": "testa1", "Associated Conditions": ["familial hypercholesterolemia"], "Occurrences": 2, "context": "carriers"}],
        },
        {"title": "Other", "summary": "TESTB2 raises LDL cholesterol in hypertension, says this sentence."},
        "not an object",
    ],
    "genes": [{"Gene": "TESTB2", "Associated Conditions": "hypertension"}],
}


@pytest.fixture
def pipe(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "one_aggregated.json").write_text(json.dumps(DOC))
    (raw / "two.json").write_text('{"content": null}')
    (raw / "three.json").write_text("[1]")
    (tmp_path / "pdf").mkdir()
    (tmp_path / "pdf" / "one.pdf").write_bytes(b"x")
    return Pipeline(spark, Settings(input_glob=str(raw / "*.json"), pdf_folder=str(tmp_path / "pdf"), work_folder=str(tmp_path / "work")))


def test_whole_run(pipe, spark, tmp_path):
    report = pipe.run()
    assert report["normalized"] == 3 and report["nodes"] > 10 and report["indexed"] == 3
    state = {r.doc_id: r for r in manifest.load(spark, pipe.settings.at("manifest")).collect()}
    assert set(state) == {"one", "two", "three"} and state["one"].stages["graph"] == "completed" and state["one"].source_pdf_path.endswith("/one.pdf")
    again = pipe.resume()
    assert again["normalized"] == 0 and again["nodes"] == report["nodes"]
    answer = pipe.query_gene("testa1", "statin therapy")
    assert answer["resolved_gene"] == "TESTA1" and answer["match_type"] == "exact"
    assert {c["name"] for c in answer["conditions"]} == {"familial hypercholesterolemia"}
    assert answer["recommendations"] and {d["name"] for d in answer["drugs"]} == {"statin"}
    assert {s["page"] for s in answer["supporting_snippets"]} == {"145"} and not any("TESTB2" in s["text"] for s in answer["supporting_snippets"])
    assert pipe.query_gene("TESTX1")["match_type"] == "fuzzy"
    lost = pipe.query_gene("zzzzzz", "which gene raises LDL cholesterol")
    assert lost["summary"].startswith("No matching gene") and lost["supporting_snippets"]
    sub = pipe.subgraph("TESTB2")
    write_subgraph(sub, str(tmp_path / "sub"))
    written = json.loads(next((tmp_path / "sub").glob("part*")).read_text())
    assert {n["label"] for n in written["nodes"]} >= {"Gene", "Condition", "Biomarker"}
    pipe.build_graph("upsert")
    assert pipe.query_gene("TESTA1")["resolved_gene"] == "TESTA1"


def test_no_graph(pipe):
    assert pipe.query_gene("A")["summary"] == "No graph has been built yet."
    assert pipe.search("x") is None and pipe.subgraph("A").nodes.count() == 0


def test_predictor(pipe):
    def make():
        def ask(p):
            if "TESTB2" in p["text"]:
                raise RuntimeError("no answer")
            return {"genes": [" testq9 "], "conditions": ["gout", " "], "drugs": ["aspirin"], "recommendation_text": "Do no harm.", "relation": "NONE", "confidence": 0.5}

        return ask

    pipe.normalize()
    pipe.predictor = make
    g = pipe.extract()
    assert {r.name for r in g.list_nodes("Gene").collect()} == {"TESTA1", "TESTB2", "TESTQ9"}  # those mentioned, too
    assert "CONTRAINDICATED_FOR" in {r.relation for r in g.edges.collect()}


def test_predictor_graph_is_whole(pipe):
    def make():
        return lambda p: {"genes": ["testq9"], "conditions": ["gout"], "drugs": ["aspirin"], "recommendation_text": "Take it.", "evidence_class": "I", "evidence_level": " B-R "}

    pipe.predictor = make
    pipe.run()
    g = pipe.extract()
    known = {r.node_id: r for r in g.nodes.collect()}
    assert [r for r in g.edges.collect() if r.source_id not in known or r.target_id not in known] == []
    names = {(n.label, n.name) for n in known.values()}
    assert names >= {("Gene", "TESTA1"), ("Gene", "TESTB2"), ("Gene", "TESTQ9"), ("Condition", "hypertension"), ("Condition", "gout"), ("EvidenceClass", "I"), ("EvidenceLevel", "B-R")}
    assert pipe.query_gene("testa1")["match_type"] == "exact" and pipe.subgraph("TESTB2").nodes.count() > 1


def test_predictor_is_offered_its_own_document(pipe, tmp_path):
    def make():
        return lambda p: {"recommendation_text": json.dumps([len(p["candidates"]["genes"]), p["candidates"]["genes"][:2], p["candidates"]["conditions"]])}

    many = [{"Gene": f"X{i:05}", "Associated Conditions": ["a rare ailment"] if i == 7 else []} for i in range(10_001)]
    (tmp_path / "raw" / "four.json").write_text(json.dumps({"content": [{"content": {"text": "An invented text without any symbol in it."}}], "genes": many}))
    pipe.settings = Settings(input_glob=pipe.settings.input_glob, work_folder=pipe.settings.work_folder, conditions=("gout",))
    pipe.normalize()
    pipe.predictor = make
    seen = {(json.loads(r.properties["guideline_id"]), json.loads(r.properties["text"])) for r in pipe.extract().list_nodes("Recommendation").collect()}
    assert seen == {
        ("one", json.dumps([2, ["TESTA1", "TESTB2"], ["familial hypercholesterolemia", "gout", "hypertension"]])),
        ("four", json.dumps([10_001, ["X00000", "X00001"], ["a rare ailment", "gout"]])),
    }


def test_texts_that_begin_alike_are_all_indexed(pipe, tmp_path):
    start = "carriers of the variant " * 10
    (tmp_path / "raw" / "four.json").write_text(json.dumps({"content": [{"content": {"a": start + "avoid alcohol", "b": start + "take zetimibe"}}]}))
    pipe.settings = Settings(input_glob=str(tmp_path / "raw" / "four.json"), work_folder=pipe.settings.work_folder)
    pipe.normalize()
    assert pipe.build_index() == 2
    found = [pipe.search(q).first().snippet_id for q in ("alcohol", "zetimibe")]
    assert found[0] == found[1] == pipe._read("snippets").first().snippet_id


def _mention(gene, conditions, context, n=1):
    return {"Gene": gene, "Associated Conditions": conditions, "Occurrences": n, "context": context}


def test_golden_counts(spark, tmp_path):
    """Numbers worked out by hand for a document of this shape under the default term lists."""
    high, chronic = "Familial hypercholesterolemia", "Chronic coronary disease"
    advice = "High-intensity statin therapy is recommended for carriers of LDLA1 variants with chronic coronary disease to bring down LDL-C. Class I Level of Evidence A."
    doc = {
        "content": [
            {"content": {"title": "2031 Invented Guideline on Coronary Care", "organization": "Invented Council of Heart Care and College of Rhythms", "Date": "August 2031"}, "genes": []},
            {
                "content": {
                    "Title": "Lipids",
                    "Sections": [
                        {
                            "Section": "7.3 Lipids",
                            "Page": "145",
                            "Recommendations": [{"Recommendation": advice, "Class of Recommendation": "Class I", "Level of Evidence": "Level of Evidence A"}],
                            "Recommendation-Specific Supportive Text": "Familial hypercholesterolemia due to LDLA1, APOX2, or PCSK9 variants asks for early LDL-C lowering and repeated tests.",
                        }
                    ],
                },
                "genes": [_mention("LDLA1", [high, chronic], "in the section", 2), _mention("APOX2", [high], "with lipid advice")],
            },
            {
                "content": {
                    "Title": "Risk",
                    "sections": [
                        {
                            "section": "8.1 Markers",
                            "page": "171",
                            "summary": "APOE9 carriers with chronic coronary disease may keep a residual risk. Lipoprotein(a) and LDL-C refine it.",
                            "recommendations": "It is reasonable to measure lipoprotein(a) once in patients with a family history. Class 2a Level of Evidence B-NR.",
                        }
                    ],
                },
                "genes": [_mention("APOE9", [chronic], "in risk")],
            },
            {
                "content": {
                    "Overview": "Adjunctive pharmacotherapies",
                    "recommendation": "PCSK9 inhibitor therapy may be considered when LDL-C stays above its goal despite tolerated statin and ezetimibe doses. Level of Evidence B-R.",
                    "page": "172",
                    "section": "8.2 Adjuncts",
                },
                "genes": [_mention("PCSK9", [high], "in adjuncts")],
            },
        ],
        "genes": [_mention("LDLA1", [high, chronic], "all of LDLA1", 2), _mention("APOE9", [chronic], "all of APOE9"), _mention("PCSK9", [high], "all of PCSK9")],
    }
    (tmp_path / "g.json").write_text(json.dumps(doc))
    pipe = Pipeline(spark, Settings(input_glob=str(tmp_path / "*.json"), work_folder=str(tmp_path / "work"), build_index=False))
    (about,) = pipe.validate()["documents"]
    assert (about["snippets"], about["gene_mentions"]) == (8, 7)
    report = pipe.run()
    assert report == {"normalized": 1, "documents": 1, "nodes": 36, "edges": 94, "document_nodes": 36, "document_edges": 94}
    g = pipe._graph()
    labels = {r.label: r["count"] for r in g.nodes.groupBy("label").count().collect()}
    assert labels == {"Guideline": 1, "Snippet": 8, "Section": 4, "Gene": 4, "Condition": 4, "Biomarker": 2, "Drug": 3, "Recommendation": 5, "EvidenceClass": 2, "EvidenceLevel": 3}
    relations = {r.relation: r["count"] for r in g.edges.groupBy("relation").count().collect()}
    assert relations == {
        "FROM_GUIDELINE": 8, "LOCATED_IN_SECTION": 8, "GENE_MENTIONED_IN": 12, "ASSOCIATED_WITH_CONDITION": 31, "CO_MENTIONED_WITH": 10, "SUPPORTED_BY_SNIPPET": 5, "HAS_EVIDENCE_CLASS": 3,
        "HAS_EVIDENCE_LEVEL": 4, "REFERENCED_IN_RECOMMENDATION": 8, "RECOMMENDS": 5,
    }


def test_two_documents_share_nodes(pipe, tmp_path):
    (tmp_path / "raw" / "two.json").write_text(json.dumps(DOC))
    report = pipe.run()
    assert report["documents"] == 2 and report["document_nodes"] > report["nodes"] and report["document_edges"] > report["edges"]


def test_validate_tells_what_is_wrong(pipe, tmp_path):
    assert pipe.validate(str(tmp_path / "none" / "*.json")) == {"valid": False, "error": "No input files found"}
    assert pipe.ingest(str(tmp_path / "none" / "*.json")) == 0 and pipe.normalize(str(tmp_path / "none" / "*.json")) == 0
    got = pipe.validate(limit=5)
    assert got["valid"] is False and [r["reason"] for r in got["rejected"]] == ["no JSON object", "content is no list"]
    assert [(d["doc_id"], d["snippets"], d["gene_mentions"]) for d in got["documents"]] == [("one", 3, 2)]
    assert pipe.resume(pipe.settings.input_glob.replace("*", "one*"), 1)["normalized"] == 1


def test_inspect_takes_both_kinds(pipe, tmp_path):
    raw = pipe.inspect(str(tmp_path / "raw" / "one_aggregated.json"))
    assert raw["doc_id"] == "one" and raw["metadata"]["organization"] and len(raw["snippets"]) == 3 and len(raw["gene_mentions"]) == 2
    done = {"metadata": {"title": "t"}, "snippets": [], "more": 1}
    (tmp_path / "done.json").write_text(json.dumps(done))
    assert pipe.inspect(str(tmp_path / "done.json")) == done


def make_nothing():
    return lambda p: {}


def test_extractor_and_backend_are_chosen_by_settings(spark):
    assert Pipeline(spark, Settings()).predictor is None
    assert Pipeline(spark, Settings(extractor=f"{__name__}:make_nothing")).predictor.__name__ == "make_nothing"
    for bad in ({"extractor": "nonsense"}, {"backend": "nonsense"}, {"backend": "database"}):
        with pytest.raises(ValueError):
            Pipeline(spark, Settings(**bad))


def test_large_numbers_are_kept(spark):
    body = json.dumps({"genes": [{"Gene": "A", "Occurrences": 2**31}, {"Gene": "B", "Occurrences": 2**70}]})
    raw = spark.createDataFrame([(1, "g", "p/x.json", body)], "file_id bigint, guideline_id string, path string, body string")
    assert {r.gene_symbol: r.occurrences for r in normalize(raw)["gene_mentions"].collect()} == {"A": 2**31, "B": None}


def test_database_backend(pipe, tmp_path, spark):
    log = tmp_path / "statements"

    def connect():
        def run(statement, parameters):
            with open(log, "a") as f:
                f.write(json.dumps([statement, parameters.get("rows", [])]) + "\n")
            if "RETURN DISTINCT n.label" in statement:
                return [{"name": "Gene"}]
            if "RETURN DISTINCT type(e)" in statement:
                return [{"name": "KNOWS"}]
            if statement.startswith("MATCH (n:Entity:Gene)"):
                return [{"p": {"node_id": "gene:A", "label": "Gene", "name": "A", "n": 1}}]
            return [{"p": {"edge_id": "e", "x": "y"}, "s": "gene:A", "t": "gene:A"}] if "RETURN properties(e)" in statement else []

        return run

    made = Pipeline(spark, Settings(input_glob=pipe.settings.input_glob, work_folder=pipe.settings.work_folder, backend="database", build_index=False), connect=connect)
    report = made.run()
    sent = [json.loads(x) for x in log.read_text().splitlines()]
    assert sent[0][0].startswith("CREATE CONSTRAINT")
    merged = [(s, rows) for s, rows in sent if "MERGE (n" in s]
    assert sum(len(rows) for _, rows in merged) == report["nodes"] and all(f"n:{r['label']}" in s for s, rows in merged for r in rows)
    assert sum(len(rows) for s, rows in sent if "MERGE (s)" in s) == report["edges"]
    assert made.query_gene("a")["resolved_gene"] == "A"
    g = read_database(spark, connect)
    assert g.nodes.first().properties == {"n": "1"} and tuple(g.edges.first()) == ("e", "gene:A", "gene:A", "KNOWS", {"x": '"y"'})
    for bad in ("A) DETACH DELETE (n", None, ""):
        with pytest.raises(ValueError):
            write_database(GraphStore(spark.createDataFrame([("a", bad, "A", {})], NODE_SCHEMA), g.edges), connect)


def test_walk_rules():
    rows = list(walk_body(json.dumps(DOC)))
    snippets = [r for r in rows if r["kind"] == "snippet"]
    assert [r["snippet_type"] for r in snippets] == ["text", "recommendation", "recommendation", "recommendation", "text"]
    assert any(r["page"] == "145" and r["section_path"] == ["Markers and genomics"] for r in snippets)
    assert [r["field_name"] for r in rows if r["kind"] == "mention"] == ["TESTB2", "TESTA1"]
    doc = rows[0]
    assert doc["fields"]["title"] == "Sample guideline on lipid care" and "Gene" in doc["list"]
    for body, reason in ((None, "no body"), ("[1]", "no JSON object"), ("{", "no JSON"), ('{"content": null}', "content is no list")):
        assert [(r["kind"], r["text"]) for r in walk_body(body)] == [("rejected", reason)]


def test_first_of_equal_texts_stays(spark):
    text = "the same sentence in two places of one section"
    body = json.dumps({"content": [{"content": {"Section": "s", "a": text, "b": text + "  ", "c": "x" * 24, "d": "y" * 25, "title": "t" * 119}}]})
    raw = spark.createDataFrame([(1, "g", "p/x.json", body)], "file_id bigint, guideline_id string, path string, body string")
    got = [(r.field_name, r.json_pointer) for r in normalize(raw)["snippets"].orderBy("seq").collect()]
    assert got == [("a", "/content/0/content/a"), ("d", "/content/0/content/d")]


def test_streaming(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "one.json").write_text(json.dumps(DOC))
    for _ in range(2):
        follow(spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
        (src / "two.json").write_text(json.dumps(DOC))
    assert {r.guideline_id for r in spark.read.parquet(str(tmp_path / "out" / "documents")).collect()} == {"one", "two"}


def test_settings(tmp_path, monkeypatch):
    assert deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    (tmp_path / "profiles").mkdir()
    (tmp_path / "profiles" / "base.json").write_text('{"chunk_size": 10, "drugs": ["x"]}')
    (tmp_path / "profiles" / "big.json").write_text('{"top_k": 10}')
    s = load_settings("big", tmp_path, {"LOOMGRAPH_CHUNK_OVERLAP": "3"}, family="f")
    assert (s.chunk_size, s.top_k, s.chunk_overlap, s.family, s.drugs) == (10, 10, 3, "f", ("x",))
    with pytest.raises(ValueError):
        load_settings(root=tmp_path, env={}, nonsense=1)
    below = tmp_path / "a" / "b"
    below.mkdir(parents=True)
    assert find_root(below, {}) == tmp_path.resolve() and find_root(None, {"LOOMGRAPH_ROOT": str(below)}) == tmp_path.resolve()


def test_cli(pipe, monkeypatch, spark):
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    s = pipe.settings
    common = ["--input-glob", s.input_glob.replace("*", "one*"), "--work-folder", s.work_folder]
    assert json.loads(cli.main(["validate", *common]))["valid"] is True
    assert json.loads(cli.main(["run-pipeline", *common, "--plain"]))["normalized"] == 1
    assert re.search("TESTA1 appears", cli.main(["query", "--gene", "TESTA1", *common]))
    assert json.loads(cli.main(["export-subgraph", "--gene", "TESTA1", *common]))["written"].endswith("subgraph")
    with pytest.raises(SystemExit):
        cli.main(["query", *common])


def test_connectors(spark, tmp_path):
    path = tmp_path / "g.json"
    path.write_text(json.dumps({"nodes": [{"id": "a", "label": "L", "name": "A", "k": "1"}], "links": [{"source": "a", "target": "b", "key": "e", "relation": "R"}]}))
    g = read_node_link(spark, str(path))
    assert g.nodes.first().properties == {"k": "1"} and g.edges.first().edge_id == "e"
    out = str(tmp_path / "sent")

    def connect():
        return lambda kind, rows: open(out, "a").write(f"{kind} {len(rows)}\n")

    write_to_database(g, connect)
    assert sorted(open(out).read().split("\n")[:2]) == ["edges 1", "nodes 1"]
