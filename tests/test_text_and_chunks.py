import hashlib
import random
import re

from pyspark.sql import functions as F

from loomgraph.functions import ids
from loomgraph.functions.text import evidence_class, evidence_level, is_against, tokens
from loomgraph.operators.chunk import chunk_snippets


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_ids(spark):
    h = lambda *p: hashlib.sha1("::".join(x.strip() for x in p if x.strip()).encode()).hexdigest()[:16]
    assert one(spark, ids.make_id("edge", F.lit(" a "), F.lit(""), F.lit(None).cast("string"), F.lit("b"))) == "edge:" + h("edge", "a", "b")
    assert one(spark, ids.slugify(F.lit("  Ünder--the Line! "))) == "nder-the-line"
    assert one(spark, ids.slugify(F.lit("???"))) == "unknown"
    assert one(spark, ids.doc_id(F.lit("raw/x/Some-File 2014_aggregated.json"))) == "some-file-2014"
    assert one(spark, ids.squeeze(F.lit(" a\t\n b\x1c"))) == "a b"
    assert one(spark, ids.section_id(F.lit("g"), F.array().cast("array<string>"))) == "section:g:" + h("Document")


def test_patterns(spark):
    none = F.lit(None).cast("string")
    assert one(spark, evidence_class(none, F.lit("see Class of Recommendation 2a here"))) == "2a"
    assert one(spark, evidence_class(none, F.lit("Class IIa"))) is None
    assert one(spark, evidence_class(none, F.lit("Class IIa"), extended=True)) == "IIa"
    assert one(spark, evidence_level(F.lit("LOE b-nr"), F.lit("LOE A"))) == "B-NR"
    assert one(spark, evidence_level(none, F.lit("Level of Evidence: A"))) is None
    assert one(spark, is_against(F.lit("pharmacotherapy"))) and not one(spark, is_against(F.lit("pharmacotherapy"), whole_words=True))
    assert one(spark, tokens(F.lit("A bb-BB c3!"))) == ["bb", "c3"]


def model(text, size, overlap):
    if size <= 0 or len(text) <= size:
        return [text]
    out, cur = [], ""
    for s in re.split(r"(?<=[.!?])\s+", text):
        if not cur:
            cur = s
        elif len(cur) + 1 + len(s) <= size:
            cur += " " + s
        else:
            out.append(cur)
            cur = cur[-overlap:] + " " + s if overlap and min(overlap, len(cur)) + 1 + len(s) <= size else s
    return [*out, cur]


def test_windows_equal_a_plain_loop(spark):
    rng = random.Random(2)
    texts = [" ".join("w" * rng.randrange(1, 60) + rng.choice(".!? ") for _ in range(rng.randrange(1, 25))) for _ in range(60)] + ["", "x" * 500, None]
    schema = "snippet_id string, text string, raw_fields map<string,string>, window_note string"
    df = spark.createDataFrame([(f"s{i}", t, None, "n") for i, t in enumerate(texts)], schema)
    for size, overlap in ((120, 20), (100, 0), (0, 5)):
        got = {}
        for r in chunk_snippets(df, size, overlap).collect():
            got.setdefault(r.snippet_id.split(":")[0], []).append((r.window, r.text, r.raw_fields))
        for i, t in enumerate(texts):
            if t is None:
                assert f"s{i}" not in got
                continue
            rows = sorted(got[f"s{i}"])
            assert [x[1] for x in rows] == model(t, size, overlap)
            assert (rows[0][2] is None) == (len(rows) == 1)
