"""Queries beside their SQL on the smallest test data, where it is there."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry

FOLDER = Path("/root/testdata/sf0.001")
NAMES = [
    "hash_ids", "schema_hints", "snippet_first_wins", "mention_merge", "term_matches", "recommendation_scan", "node_upsert", "edge_upsert", "k_hop_edges", "gene_context_edges",
    "recommendation_rollup", "tfidf_search", "p2_found",
]


def norm(v):
    if isinstance(v, float):
        return "~" if math.isnan(v) else f"{v:.6g}"
    return "~" if v is None else str(v)


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.skipif(not FOLDER.exists(), reason="no test data")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sql, name):
    df = entry.queries()[name](spark, str(FOLDER))
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    rel = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert got == sorted(tuple(norm(r[i]) for i in order) for r in rel.fetchall())


def test_documents_are_searched_for_every_kind(spark, tmp_path):
    docs = [(1, "g", "Statin for TESTA1 carriers with heart failure and high LDL-C"), (2, "h", "testa1, statins"), (3, None, None)]
    terms = [(None, "drug", "statin"), (None, "gene", "TESTA1"), ("g", "condition", "heart failure"), ("h", "biomarker", "LDL-C"), (None, "biomarker", "LDL-C"), (None, "gene", None)]
    spark.createDataFrame(docs, "doc_id bigint, guideline_id string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(terms, "guideline_id string, kind string, term string").write.parquet(str(tmp_path / "terms.parquet"))
    got = sorted(map(tuple, entry.queries()["document_all_term_matches"](spark, str(tmp_path)).collect()))
    assert got == [("1", "biomarker", "LDL-C"), ("1", "condition", "heart failure"), ("1", "drug", "statin"), ("1", "gene", "TESTA1"), ("2", "gene", "TESTA1")]
