import datetime as dt
import json
import random

import numpy as np

from loomgraph.operators.schema_drift import SchemaGraph, WholeGraph, candidates, consistent_heads, correspondences, normal_path


def test_a_partner_is_found_behind_many_other_fields(spark):
    person = lambda n: [{"name": n, "role": "chair", "city": "X"}]
    boxes = {f"box {k:02} kas": person("P") for k in range(12)}  # between the two names in order of letters, from either end
    rows = [
        (1, "f", dt.datetime(2021, 1, 1), {"main author": person("A"), **boxes}),
        (2, "f", dt.datetime(2021, 1, 2), {"authors": person("B"), **boxes}),
    ]
    raw = spark.createDataFrame([(i, f, t, json.dumps({"content": [{"content": h}]})) for i, f, t, h in rows], "file_id bigint, feed string, exported_at timestamp_ntz, body string")
    got = {r.file_id: r for r in consistent_heads(raw).collect()}
    assert [got[i].authors for i in (1, 2)] == [["A"], ["B"]]
    assert all(len(got[i].other) == 12 for i in (1, 2))


def feed(rng):
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 5)))
    tops = {rng.choice(["", "A", "b_"]) + word() for _ in range(rng.choice([1, 3, 12, 30]))}
    paths = tops | {f"{t}.{word()}" for t in sorted(tops) if rng.random() < 0.5 for _ in range(rng.randint(1, 4))}
    paths |= {f"{word()}.{word()}" for _ in range(3)} | {f"{p}.{word()}" for p in sorted(paths)[:3]}  # keys with points
    return [(p, rng.sample(["string", "number", "object", "array of objects", "array of strings"], rng.randint(1, 2))) for p in sorted(paths)]


def test_scores_are_those_of_all_pairs_one_by_one():
    rng = random.Random(4)
    for _ in range(25):
        elements = feed(rng)
        whole, plain = WholeGraph(elements), SchemaGraph(elements)
        whole.settle()
        plain.pairs = [(i, j) for i in range(len(plain.paths)) for j in range(i, len(plain.paths)) if plain.nested[i] == plain.nested[j]]
        want = plain.flood(tolerance=1e-9)
        assert all(abs(s - whole.scores(i, np.array([j]))[0]) < 1e-5 for (i, j), s in want.items())
        other = {p: s for p, s in want.items() if plain.last[p[0]] != plain.last[p[1]]}
        best = [max((s for p, s in other.items() if i in p), default=0) for i in range(len(plain.paths))]
        clear = {(plain.paths[i], plain.paths[j]) for (i, j), s in other.items() if s > 0.8 + 1e-5 and s > max(best[i], best[j]) - 1e-9}
        assert clear <= {(a, b) for a, b, _ in candidates(elements)}


def test_by_the_fixed_rule_every_spelling_meets():
    rng = random.Random(5)
    for _ in range(25):
        elements = feed(rng) + [(f"ex{a}pert{b}panel{c}", ["string"]) for a in " _-" for b in " _-" for c in " _-"]
        assert correspondences(elements) == {p: normal_path(p) for p, _ in elements}
    assert len(candidates(elements, exact=True)) >= 26 and candidates([]) == [] and correspondences([], exact=False) == {}
