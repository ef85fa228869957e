import datetime as dt

from loomgraph.operators.references import count_orphans, orphan_references, orphan_report
from loomgraph.operators.skew import heavy_keys, lookup_join

NODES = "row_id bigint, node_id string, label string, deleted boolean, updated_at timestamp_ntz, relation string"
EDGES = "row_id bigint, edge_id string, source_id string, target_id string, relation string, created_at timestamp_ntz, ref string"


def day(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def test_statuses_and_report(spark):
    nodes = spark.createDataFrame(
        [
            (1, "a", "x", False, day(0), "clash"),
            (2, "b", "x", False, day(0), "clash"),
            (3, "b", "x", True, day(5), None),
            (4, "c", "x", True, day(1), None),
            (5, "c", "x", False, day(9), None),
            (6, "d", "x", None, day(50), None),
            (7, None, "x", False, day(0), None),
            (8, "t", "x", False, day(1), None),
            (9, "t", "x", True, day(1), None),
        ],
        NODES,
    )
    edges = spark.createDataFrame(
        [
            (1, "e1", "a", "b", "R", day(2), "clash"),
            (2, "e2", "c", "zz", "R", day(40), None),
            (3, "e3", "d", "", "S", day(40), None),
            (4, "e4", None, "A", "S", day(40), None),
            (5, "e5", "d", "t", "S", None, None),
            (5, "e5", "d", "t", "S", None, None),
        ],
        EDGES,
    )
    for parts in (1, 2, 10_000):  # all, some and no key heavy
        got = sorted(tuple(r) for r in orphan_references(edges, nodes, parts).select("row_id", "side", "status").collect())
        assert got == [
            (1, "target", "deleted"),
            (2, "target", "missing"),
            (3, "source", "late"),
            (4, "target", "missing"),
            (5, "target", "deleted"),
            (5, "target", "deleted"),
        ]
    report = {(r.relation, r.period, r.status): r.n_refs for r in orphan_report(orphan_references(edges, nodes)).collect()}
    assert report["R", "2020-02", "missing"] == 1 and report["S", None, "deleted"] == 2
    whole = sorted(map(str, orphan_report(orphan_references(edges, nodes)).collect()))
    for parts in (1, 2, 10_000):
        assert sorted(map(str, count_orphans(edges, nodes, parts).collect())) == whole


def test_empty_tables(spark):
    no_nodes, no_edges = spark.createDataFrame([], NODES), spark.createDataFrame([], EDGES)
    edges = spark.createDataFrame([(1, "e", "a", "b", "R", day(0), None)], EDGES)
    assert orphan_references(no_edges, no_nodes).count() == 0
    assert {r.status for r in orphan_references(edges, no_nodes).collect()} == {"missing"}
    assert count_orphans(no_edges, no_nodes).count() == 0 and [r.n_refs for r in count_orphans(edges, no_nodes).collect()] == [1, 1]


def test_counts_of_late_references_within_a_month(spark):
    nodes = spark.createDataFrame([(1, "a", "x", False, day(10), None), (2, "b", "x", False, day(40), None)], NODES)
    rows = [(i, f"e{i}", "a", "b", "R", day(i) if i < 60 else None, None) for i in range(70)]
    edges = spark.createDataFrame(rows, EDGES)
    want = sorted(map(str, orphan_report(orphan_references(edges, nodes)).collect()))
    for parts in (1, 100_000):
        assert sorted(map(str, count_orphans(edges, nodes, parts).collect())) == want


def test_lookup_join_keeps_null_and_hot_keys(spark):
    rows = spark.createDataFrame([(i, "hot" if i < 60 else None if i < 70 else f"k{i}") for i in range(100)], "id int, key string")
    table = spark.createDataFrame([("hot", 1), ("k80", 2)], "key string, v int")
    heavy = heavy_keys(rows, "key", 100, 5)
    assert [r[0] for r in heavy.collect()] == ["hot"]
    got = {r.id: r.v for r in lookup_join(rows, table, "key", heavy).collect()}
    assert len(got) == 100 and got[0] == 1 and got[80] == 2 and got[65] is None and got[99] is None
