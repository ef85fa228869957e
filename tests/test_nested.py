import json

from hypothesis import given, settings
from hypothesis import strategies as st

from loomgraph.operators.nested import flatten_bodies, flatten_body, nested_tables, pivot_kind, triples

json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**9), 10**9) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=8),
    lambda c: st.lists(c, max_size=4) | st.dictionaries(st.text(max_size=5), c, max_size=4),
    max_leaves=20,
)


def leaves(value, path=()):
    yield path, dict if isinstance(value, dict) else list if isinstance(value, list) else value
    for k, v in value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ():
        yield from leaves(v, (*path, k))


@given(json_values, st.sampled_from([None, 2]))
@settings(max_examples=150, deadline=None)
def test_stream_gives_what_a_parser_gives(value, indent):
    text = json.dumps(value, indent=indent)
    got = list(triples(text))
    assert {p: v for p, v, _ in got} == dict(leaves(json.loads(text)))
    assert [o for _, _, o in got] == list(range(len(got)))


@given(json_values, st.integers(0, 200))
@settings(max_examples=100, deadline=None)
def test_cut_texts_give_nothing(value, at):
    text = json.dumps({"content": [{"x": value}]})
    cut = text[: at % len(text)]
    assert flatten_body(cut) == []


def rows(body):
    return [r[:3] for r in flatten_body(json.dumps(body)) if r[0] in ("item", "section", "gene")]


def test_kinds_and_parents():
    body = {
        "genes": [{"Gene": "A"}, {"Gene": " "}, {"Gene": 7}, "x"],
        "content": [
            {"content": {"Sections": [{"Section": "s", "Parts": [{"sections": {"page": 1, "genes": {"Gene": "B"}}}]}, "text"]}},
            "no item",
            {"genes": [{"Gene": "C", "Sections": [{"a": 1}]}], "Sections": None},
        ],
    }
    assert rows(body) == [
        ("gene", "/genes/0", ""),
        ("item", "/content/0", ""),
        ("section", "/content/0/content/Sections/0", "/content/0"),
        ("section", "/content/0/content/Sections/0/Parts/0/sections", "/content/0/content/Sections/0"),
        ("gene", "/content/0/content/Sections/0/Parts/0/sections/genes", "/content/0/content/Sections/0/Parts/0/sections"),
        ("item", "/content/2", ""),
        ("gene", "/content/2/genes/0", "/content/2"),
    ]
    assert rows({"content": {"a": 1}}) == [("item", "/content", "")]
    for other in (None, [], "x", 3):
        assert rows(other) == []
    assert flatten_body(None) == [] and flatten_body("") == []


def test_repeated_key_counts_once():
    assert [r[:3] for r in flatten_body('{"content":[{"a":1}],"content":[{"b":2}]}')] == [("document", "", None), ("item", "/content/0", "")]
    assert flatten_body('{"content":[{"a":{"x":1},"a":{"y":2}}]}')[1][4] == {"/a/y": "2"}


def test_deep_nesting_does_not_overflow():
    deep = '{"content":' + "[" * 5000 + "]" * 5000 + "}"
    assert [r[:2] + r[4:] for r in flatten_body(deep)] == [("document", "", {})]


@given(st.dictionaries(st.sampled_from(["content", "genes", "Sections", "authors", "x"]), json_values, max_size=4), st.booleans())
@settings(max_examples=200, deadline=None)
def test_no_scalar_is_lost(value, wrapped):
    body = {"content": [value, 3, "text"], "title": None} if wrapped else value
    back = {}
    for _, at, _, _, fields in flatten_body(json.dumps(body)):
        assert not set(back) & {at + k for k in fields}
        back |= {at + k for k in fields} and {at + k: v for k, v in fields.items()}
    plain = lambda v: None if v is None else str(v).lower() if isinstance(v, bool) else str(v)
    assert back == {"".join(f"/{p}" for p in path): plain(v) for path, v in leaves(json.loads(json.dumps(body))) if v not in (dict, list)}


def test_repeated_objects_are_found():
    body = {"title": "T", "content": [{"authors": [{"name": "A"}, "B"], "Recommendations": [{"text": "r", "n": [{"x": 1}]}]}, "loose"], "genes": [{"Gene": ""}]}
    assert [r[:3] + r[4:] for r in flatten_body(json.dumps(body))] == [
        ("document", "", None, {"/title": "T", "/content/1": "loose"}),
        ("item", "/content/0", "", {"/authors/1": "B"}),
        ("/authors", "/content/0/authors/0", "/content/0", {"/name": "A"}),
        ("/Recommendations", "/content/0/Recommendations/0", "/content/0", {"/text": "r"}),
        ("/n", "/content/0/Recommendations/0/n/0", "/content/0/Recommendations/0", {"/x": "1"}),
        ("/genes", "/genes/0", "", {"/Gene": ""}),
    ]
    digits = "9" * 5000
    assert flatten_body('{"n": %s}' % digits)[0][4] == {"/n": digits}


def test_any_kind_becomes_a_table(spark):
    body = json.dumps({"content": [{"authors": [{"name": "A", "Name": "a", "at": {"city": "X"}, "kind": "k", "tags": ["t"]}, {"name": None}]}]})
    raw = spark.createDataFrame([(1, body)], "file_id bigint, body string")
    t = nested_tables(raw)
    assert {r.kind for r in t["repeated"].collect()} == {"/authors"} and t["documents"].count() == 1
    got = pivot_kind(flatten_bodies(raw), "/authors").orderBy("ordinal").collect()
    assert got[0]["at.city"] == "X" and {**got[0].other, "name": got[0]["name"]} in ({"/Name": "a", "/kind": "k", "/tags/0": "t", "name": "A"},)
    assert got[1]["name"] is None and got[1].parent_pointer == "/content/0"


def test_tables(spark):
    body = json.dumps({"content": [{"Title": "T", "Sections": [{"Section": "s", "Page": 4, "n": True, "genes": [{"Gene": "G", "Occurrences": 2}]}]}]})
    raw = spark.createDataFrame([(1, body, "clash"), (2, None, None), (3, "{", None), (4, "", None)], "file_id bigint, body string, kind string")
    t = nested_tables(raw)
    assert [r.title for r in t["items"].collect()] == ["T"]
    s = t["sections"].collect()[0]
    assert (s.section, s.page, s.parent_pointer, s.other) == ("s", "4", "/content/0", {"/n": "true"})
    g = t["genes"].collect()[0]
    assert (g.gene, g.occurrences, g.parent_pointer) == ("G", "2", "/content/0/Sections/0")
    assert flatten_bodies(raw.limit(0)).count() == 0
