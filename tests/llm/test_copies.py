from collections import defaultdict

from loomgraph.llm.copies import canonical, canonical_parts, collapsed, copies_found, keyed_records

SNIPPETS = "row_id bigint, text string, snippet_type string, dg string"
MENTIONS = "row_id bigint, guideline_id string, gene_symbol string, associated_conditions array<string>, occurrences int, context string, content_index int, ids string"


def test_canonical():
    assert canonical("A  b​,C -d") == "abcd"
    assert canonical("dose 2.5 mg.") == "dose2.5mg" and canonical("v.2 .5 2. 5") == "v2525"
    assert canonical("<1 µg") != canonical(">1 µg") and canonical("?!") == ""
    assert canonical_parts("• B: 1; a|\n;A") == ["b1", "a", "a"]


def found(spark, s, m, parts=10_000):
    keyed = keyed_records(spark.createDataFrame(s, SNIPPETS), spark.createDataFrame(m, MENTIONS))
    return sorted(tuple(r) for r in copies_found(keyed, parts).collect())


def test_groups(spark):
    s = [
        (5, "Hello, world", "text", "clash"), (2, "hello world", "recommendation", None), (9, "HELLO WORLD!", None, None), (3, "a: 1; b: 2", "record", None),
        (4, "B: 2\nA: 1", "record", None), (6, "a1b2", "text", None), (7, None, "text", None), (8, "  ", "text", None), (10, "...", "text", None), (11, "a: 1; b: 2; b: 2", "record", None),
    ]
    m = [
        (1, "g", "ABC1", ["x", "Y"], 1, "c", 0, "clash"), (2, "g", "abc-1", ["y", "X "], 1, "C.", 0, None), (3, "g", "ABC1", ["x"], 1, "c", 0, None), (4, "G", "ABC1", ["x", "y"], 1, "c", 0, None),
        (5, "g", " ", None, None, None, None, None), (6, "g", None, None, None, None, None, None), (7, None, "Z", None, None, None, None, None), (8, None, "z", None, None, None, None, None),
        (9, None, "z", [], None, None, None, None), (10, None, "z", [None], None, None, None, None), (11, None, "z", [" "], None, None, None, None),
    ]
    want = [("gene_mentions", 1, 2), ("gene_mentions", 7, 8), ("snippets", 2, 5), ("snippets", 2, 9), ("snippets", 3, 4)]
    assert found(spark, s, m) == want and found(spark, s, m, parts=1) == want
    both = collapsed(spark.createDataFrame(s, SNIPPETS), spark.createDataFrame(m, MENTIONS)).collect()
    per = defaultdict(int)
    for r in both:
        per[r.tbl] += r.n_copies
    assert per == {"snippets": len(s), "gene_mentions": len(m)}
    assert {(r.tbl, r.row_id): r.n_copies for r in both}["snippets", 2] == 3


def test_symbols_without_signs_that_count(spark):
    m = [(i, "g", x, None, 1, None, 0, None) for i, x in enumerate(["?", "-", " - ", "", "  ", "\u200b", None, "A"])]
    assert found(spark, [], m) == [("gene_mentions", 0, 1), ("gene_mentions", 0, 2)]


def test_a_hot_group_and_empty_tables(spark):
    s = [(i, "Same. Text" if i % 3 == 0 else f"other {i}", "text", None) for i in range(300)]
    got = found(spark, s, [], parts=50)
    assert got == [("snippets", 0, i) for i in range(3, 300, 3)]
    assert found(spark, [], []) == []
