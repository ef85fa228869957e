import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomgraph.llm.tokens import PATTERN, count_tokens, encode_corpus, load_merges, replay

FOLDER = "/opt/tokenizers"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{FOLDER}/byte_bpe_50k.json"), reason="no vocabulary files")
TEXTS = ["Hello world, it's 2.5 mg.", "", None, "  \n\t ", "naïve 漢字 \U0001f600 é", "<|endoftext|> a", "aaaa" * 500, "x" * 30_000, "Hello world, it's 2.5 mg."]


def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids if s else []


@given(st.lists(st.text(max_size=30), max_size=5))
@settings(max_examples=150, deadline=None)
def test_replay_equals_the_library(texts):
    import regex

    ask, (byte_ids, merges) = reference(), load_merges(FOLDER, "byte_bpe_50k")
    for t in texts:
        words = regex.findall(PATTERN, t)
        assert [i for w in replay([w.encode() for w in words], byte_ids, merges) for i in w] == ask(t)


def test_corpus(documents):
    ask = reference()
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "s")]
    for size in (1_000_000, 10):
        got = sorted((r.doc_id, list(r.ids)) for r in encode_corpus(documents(rows), FOLDER, block_chars=size).collect())
        assert got == sorted((i, ask(t)) for i, t, _ in rows)
        counts = sorted((r.doc_id, r.n_tokens) for r in count_tokens(documents(rows), FOLDER, block_chars=size).collect())
        assert counts == sorted((i, len(ask(t))) for i, t, _ in rows)
    assert encode_corpus(documents([])).count() == 0
