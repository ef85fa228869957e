import datetime as dt
import json
import random

from loomgraph.operators.schema_drift import SchemaGraph, consistent_heads, correspondences, drift_events, flood, head_fields

RAW = "file_id bigint, feed string, exported_at timestamp_ntz, body string, field_path string"


def table(spark, rows):
    return spark.createDataFrame([(i, f, t, json.dumps({"content": [{"content": h}]}) if isinstance(h, dict) else h, "clash") for i, f, t, h in rows], RAW)


def at(h):
    return dt.datetime(2021, 1, 1) + dt.timedelta(hours=h)


def events(spark, rows):
    return sorted(tuple(r) for r in drift_events(table(spark, rows)).collect())


def test_every_change(spark):
    got = events(
        spark,
        [
            (1, "f", at(0), {"Title": "a", "n": 1, "gone": [], "authors": [{"name": "x"}]}),
            (2, "f", at(1), {"guideline_title": "a", "N": "1", "new": True}),
            (3, "f", at(2), "{broken"),
            (4, "f", at(60), {"guideline title": ["a"], "authors": [{"Name": "y", "role": None}]}),
            (5, "g", at(0), {"x": 1}),
            (6, None, None, {"x": 1}),
            (7, None, None, {"x": {"y": 1}}),
        ],
    )
    assert got == sorted(
        [
            (2, "guideline_title", "renamed"),
            (2, "N", "renamed"),
            (2, "N", "retyped"),
            (2, "new", "added"),
            (4, "guideline title", "renamed"),
            (4, "guideline title", "retyped"),
            (4, "N", "removed"),
            (4, "new", "removed"),
            (4, "authors.Name", "renamed"),
            (7, "x", "retyped"),
            (7, "x.y", "added"),
        ]
    )


def test_against_a_plain_walk(spark):
    rng = random.Random(5)
    names = {"title": ["title", "Title", "guideline_title"], "key": ["key words", "KeyWords", "key_words"], "date": ["date"]}
    values = ["s", 3, True, ["s"], [{"a": 1}], {"a": "x"}, {"A": "x"}, None, []]
    rows = []
    for i in range(120):
        head = {rng.choice(v): rng.choice(values) for v in names.values() if rng.random() < 0.7}
        rows.append((i, rng.choice("pq"), at(rng.randrange(400)), head))
    norm = lambda p: ".".join("title" if (q := x.lower().replace(" ", "").replace("_", "")) == "guidelinetitle" else q for x in p.split("."))
    want = []
    for feed in "pq":
        files = sorted((r for r in rows if r[1] == feed), key=lambda r: (r[2], r[0]))
        last, where = {}, {}
        for n, r in enumerate(files):
            for p, t, _ in head_fields(json.dumps({"content": [{"content": r[3]}]})):
                k = norm(p)
                if k not in last:
                    want += [(r[0], p, "added")] if n else []
                else:
                    want += [(r[0], p, "renamed")] if last[k][0] != p else []
                    want += [(r[0], p, "retyped")] if last[k][1] != t else []
                last[k], where[k] = (p, t), n
        want += [(files[n + 1][0], last[k][0], "removed") for k, n in where.items() if n + 1 < len(files)]
    assert events(spark, rows) == sorted(want)


def test_flooding_settles_and_prefers_like_surroundings():
    paths = ["author", "author.name", "writer", "writer.name", "year"]
    types = [{"array of objects"}, {"string"}, {"array of objects"}, {"string"}, {"number"}]
    s = flood(paths, types)
    assert s.max() == 1.0
    assert s[0, 2] > s[0, 4]  # the like-built field beats the other one, though no name agrees
    loose = correspondences([(p, list(t)) for p, t in zip(paths, types)], least=0.3, exact=False)
    assert loose["author.name"].split(".")[-1] == "name"
    assert correspondences([]) == {}


def test_one_table(spark):
    rows = [
        (1, "f", at(0), {"Title": {"main": "M"}, "Authors": [{"name": "A"}, {"name": "B"}], "Year": 2001, "odd": 1}),
        (2, "f", at(1), {"title": ["x", "y"], "authors": "C", "year": "2002"}),
        (3, "g", at(1), None),
    ]
    got = {r.file_id: r for r in consistent_heads(table(spark, rows)).collect()}
    assert (got[1].title, got[1].authors, got[1].year, got[1].other) == ("M", ["A", "B"], "2001", {"odd": "1"})
    assert (got[2].title, got[2].authors, got[2].year) == ("x; y", ["C"], "2002")
    assert set(got) == {1, 2}
    assert drift_events(table(spark, [])).count() == 0


def test_flooding_joins_fields_without_a_common_name(spark):
    person = lambda n: [{"name": n, "role": "chair", "city": "X"}]
    rows = [
        (1, "f", at(0), {"title": "t", "contributors": person("A"), "version": "1", "panel": person("P")}),
        (2, "f", at(1), {"title": "t", "authors": person("B"), "versions": [{"number": "2", "day": 3}], "panel": person("P")}),
        (3, "f", at(2), {"title": "t", "contributors": person("C"), "panel": person("P")}),
        (4, "g", at(2), {"title": "t", "contributors": person("D"), "authors": person("E")}),
    ]
    got = {r.file_id: r for r in consistent_heads(table(spark, rows)).collect()}
    assert [got[i].authors for i in (1, 2, 3)] == [["A"], ["B"], ["C"]]  # one field by what it is made of
    assert got[1].version == "1" and got[2].version is None and "versions" in got[2].other  # like names, unlike structure
    assert all("panel" in got[i].other for i in (1, 2, 3))  # as alike, but beside them in the same files
    assert got[4].authors == ["E"] and set(got[4].other) == {"contributors"}
    changes = events(spark, rows)  # by the fixed rule these are other fields
    assert (2, "authors", "added") in changes and (2, "contributors", "removed") not in changes and (3, "authors", "removed") in changes


def test_pairs_grow_with_the_paths():
    keys = [(f"key {i:05}", ["string"]) for i in range(3000)] + [("Key_00007", ["number"])]
    graph = SchemaGraph(keys)
    assert len(graph.pairs) < 40 * len(keys)
    names = correspondences(keys)
    assert names["Key_00007"] == names["key 00007"] and len(set(names.values())) == 3000


def test_many_files_of_one_moment(spark):
    rows = [(i, "f", at(0), {"a" if i % 2 else "A": 1, **({"b": 1} if i == 50 else {})}) for i in range(200)]
    got = events(spark, rows)
    assert len([e for e in got if e[2] == "renamed"]) == 199 and [e for e in got if e[2] != "renamed"] == [(50, "b", "added"), (51, "b", "removed")]
