import random

from hypothesis import given, settings
from hypothesis import strategies as st

from loomgraph.llm.split import split_snippets, split_text

ALPHABET = "ab .!?\n。é́漢"


@given(st.text(ALPHABET, max_size=400), st.integers(5, 60), st.integers(0, 4))
@settings(max_examples=300, deadline=None)
def test_pieces_give_back_the_text(text, limit, overlap):
    pieces = split_text(text, limit, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    back = text[: pieces[0][1]]
    for (a, b, _), (c, d, _) in zip(pieces, pieces[1:]):
        assert c == b - overlap
        back += text[b:d]
    assert back == text and all(b - a <= limit for a, b, _ in pieces)
    assert (len(pieces) == 1) == (len(text) <= limit)


def test_cuts_where_the_topic_changes():
    rng = random.Random(1)
    heart = "heart valve pulse aorta ventricle rhythm".split()
    bread = "flour yeast oven dough crust kneading".split()
    say = lambda words, n: " ".join(" ".join(rng.sample(words, 5)).capitalize() + "." for _ in range(n)) + " "
    first = say(heart, 22)
    text = first + say(bread, 25)
    (a, b, kind), *_ = split_text(text, 1200, 100)
    assert kind == "topic" and abs(b - len(first)) <= 120


def test_overlap_is_exact_and_boundaries_natural():
    text = " ".join(f"Sentence number {i} speaks of subject {i % 7}." for i in range(400))
    pieces = split_text(text)
    assert all(c == b - 200 for (_, b, _), (c, _, _) in zip(pieces, pieces[1:]))
    assert all(text[:b].rstrip().endswith(".") for _, b, kind in pieces if kind == "topic")


@given(st.text(ALPHABET, max_size=400), st.integers(5, 60), st.integers(0, 4))
@settings(max_examples=300, deadline=None)
def test_overlap_is_never_dropped(text, limit, overlap):
    pieces = split_text(text, limit, overlap)
    assert all(c == b - overlap for (_, b, _), (c, _, _) in zip(pieces, pieces[1:]))


def test_overlap_stays_after_a_short_heading():
    text = "A short heading.\n" + "words without any stop " * 150
    pieces = split_text(text)
    assert all(c == b - 200 for (_, b, _), (c, _, _) in zip(pieces, pieces[1:])) and pieces[0][2] == "space"
    assert all(b - a <= 1600 for a, b, _ in pieces) and pieces[0][0] == 0 and pieces[-1][1] == len(text)


def test_boundaries_are_named_for_what_they_are():
    same = "The same words stand here again. " * 200
    assert {kind for *_, kind in split_text(same)} == {"sentence", "end"}
    accents = "e\u0301" * 3000
    pieces = split_text(accents, 1601, 201)
    assert all(b - a <= 1601 for a, b, _ in pieces) and all(c == b - 201 for (_, b, _), (c, _, _) in zip(pieces, pieces[1:]))
    even = split_text(accents, 1600, 200)
    assert all(accents[a] == "e" and (b == len(accents) or accents[b] == "e") for a, b, _ in even)


def test_a_giant_text_without_boundaries():
    pieces = split_text("x" * 1_000_000)
    assert all(kind in ("none", "end") for _, _, kind in pieces) and pieces[-1][1] == 1_000_000


def test_table(spark):
    schema = "row_id bigint, guideline_id string, snippet_id string, section_path array<string>, text string, piece string"
    rows = [(1, "g", "s", ["a"], "w. " * 1000, "clash"), (2, None, None, None, None, None), (3, "g", "s", [], "", None), (1, "g", "s", ["a"], "w. " * 1000, None)]
    got = split_snippets(spark.createDataFrame(rows, schema)).collect()
    assert sum(r.row_id == 1 for r in got) % 2 == 0 and all(len(r.text or "") <= 1600 for r in got)
    assert [(r.text, r.n_pieces, r.end_at) for r in got if r.row_id == 2] == [(None, 1, 0)]
    assert all(r.section_path == ["a"] for r in got if r.row_id == 1)
    assert split_snippets(spark.createDataFrame([], schema)).count() == 0
