import math
import random
from collections import Counter

from loomgraph.llm.canonical import MARGIN, THRESHOLD, likeness, map_values, match_values, normal_forms

TERMS = [
    (1, None, "gene", "KIQPC3", ["DBAZ4"]), (2, None, "gene", "KIQPC5", []), (3, None, "condition", "venous spasm", ["VSP"]), (4, None, "condition", "acquired venous overload", None),
    (5, None, "drug", "wozuclepril", ["Bakekeex"]), (6, None, "biomarker", "serum vexin", []), (7, None, "drug", None, []),
]
SCHEMA = "term_id bigint, guideline_id string, kind string, term string, aliases array<string>"
MENTIONS = "row_id bigint, gene_symbol string, associated_conditions array<string>, value string"


def run(spark, genes, conditions, drugs, terms=TERMS, parts=10_000):
    m = spark.createDataFrame([(i, g, c, "clash") for i, (g, c) in enumerate(zip(genes, conditions))], MENTIONS)
    x = spark.createDataFrame([(i, d) for i, d in enumerate(drugs)], "row_id bigint, drugs array<string>")
    got = map_values(m, x, spark.createDataFrame(terms, SCHEMA), parts).collect()
    return {(r.src_field, r.value): r.term_id for r in got}, got


def test_values_find_their_entry(spark):
    genes = ["KIQPC3", "kiqpc-3", "K1QPC3", "KIQPPC3", "gene KIQPC3", "variant in KIQPC5.", "va riant in KIQPC5", "KIQPC5 (pathogenic)", "KIQPC7", "dbaz4", "see table", None, " ", "KQIPC3"]
    conditions = [["venous spasm", "Venous_spasm.", "spasm, venous", "ven. spasm"], ["vsp", "venous spams", "venous overload", "pt. with venous spasm (severe)"], [None, " ", "venous insufficiency"], None, []] + [None] * 9
    drugs = [["Wozuclepril 10 mg b.i.d.", "woz-uclepril", "wozucleprile", "inj. wozucleprl", "BAKEKEEX", "wozuclepril", "placebo 10 mg"], None]
    for parts in (10_000, 1):
        got, rows = run(spark, genes, conditions, drugs, parts=parts)
        gene = {v: i for (f, v), i in got.items() if f == "gene_symbol"}
        assert gene == {
            "KIQPC3": 1, "kiqpc-3": 1, "K1QPC3": 1, "KIQPPC3": 1, "gene KIQPC3": 1, "variant in KIQPC5.": 2, "va riant in KIQPC5": 2, "KIQPC5 (pathogenic)": 2, "KIQPC7": -1, "dbaz4": 1, "see table": -1, "KQIPC3": 1,
        }
        cond = {v: i for (f, v), i in got.items() if f == "associated_conditions"}
        assert cond == {
            "venous spasm": 3, "Venous_spasm.": 3, "spasm, venous": 3, "ven. spasm": 3, "vsp": 3, "venous spams": 3, "venous overload": -1, "pt. with venous spasm (severe)": 3, "venous insufficiency": -1,
        }
        drug = {v: i for (f, v), i in got.items() if f == "drugs"}
        assert {v for v, i in drug.items() if i == 5} == set(drugs[0][:6]) and drug["placebo 10 mg"] == -1
        assert sorted(r.pos for r in rows if r.src_field == "drugs") == list(range(7))
        assert {r.value for r in rows if r.exact} == {"KIQPC3", "venous spasm", "wozuclepril"}


def test_no_terms_no_values_and_repeats(spark):
    got, rows = run(spark, ["A1", "A1"], [None, None], [], terms=[])
    assert set(got.values()) == {-1} and len(rows) == 2
    assert run(spark, [], [], [])[1] == []
    tie, _ = run(spark, ["ABXD1"], [None], [], terms=[(1, None, "gene", "ABCD1", []), (2, None, "gene", "ABYD1", [])])
    assert tie == {("gene_symbol", "ABXD1"): -1}  # as close to one as to the other


def test_likeness():
    assert likeness("ABCD2", "ABCD1", "gene", False) == 0 and likeness("ABC5D1", "ABCSD1", "gene", False) == 2
    assert likeness("venous spasm", "aortic spasm", "condition", False) == 0
    assert normal_forms("", "gene") == [] and normal_forms("x" * 10_000, "drug")[0] == "x" * 10_000


def test_a_long_list_against_brute_force(spark):
    """30,000 entries; every value against every entry by the formula, without the index and its bound."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("aeioubdklmnrst") for _ in range(n))
    names = sorted({f"{word(5)} {word(rng.randrange(5, 9))}" for _ in range(30_000)})
    terms = spark.createDataFrame([(i, None, "condition", n, []) for i, n in enumerate(names)], SCHEMA)
    asked = []
    for n in rng.sample(names, 12):
        k = rng.randrange(1, len(n) - 1)
        asked += [n.upper(), n[:k] + n[k + 1 :], n[:k] + "z" + n[k + 1 :], n.split(" ")[0]]
    asked = sorted(set(asked))

    def bag(t):
        t = f"^{t}$"
        return {t[i : i + 2] for i in range(len(t) - 1)} | {t[i : i + 3] for i in range(len(t) - 2)}

    bags = [bag(n) for n in names]
    df = Counter(g for b in bags for g in b)
    w2 = {g: math.log(1 + len(names) / n) ** 2 for g, n in df.items()}
    norms = [sum(w2[g] for g in b) for b in bags]
    rare = math.log(1 + len(names)) ** 2
    want = {}
    for v in asked:
        scores = []
        for form in normal_forms(v, "condition"):
            own = bag(form)
            for i, b in enumerate(bags):
                both = own & b
                dot = sum(w2[g] for g in both)
                cosine = dot / math.sqrt(norms[i] * (dot + (len(own) - len(both)) * rare / 2))
                if cosine >= THRESHOLD and (like := likeness(form, names[i], "condition", False)):
                    scores.append((like + cosine, -i))
        scores.sort(reverse=True)
        if scores and (len(scores) == 1 or scores[0][0] - scores[1][0] >= MARGIN):
            want[v] = (-scores[0][1], round(scores[0][0], 6))
    values = spark.createDataFrame([("condition", v) for v in asked], "kind string, value string")
    got = {r.value: (r.term_id, round(r.score, 6)) for r in match_values(values, terms).collect()}
    assert got == want and len(want) >= 30
