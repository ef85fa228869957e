"""Encoding a corpus with a public byte-level BPE vocabulary (problem 7).

Corpus-level merge replay: the corpus is reduced to its distinct words; an inverted index from token pair to word
positions then applies every merge in rank order to all words at once, touching only the neighbours of a merged
place. A word is thus encoded once for the corpus and not once per occurrence. Documents are kept as blocks of
integer codes into the block's own word list, so word strings are shuffled once per block and never per token.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.session import cut

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"
#: Characters of text in a block; a longer document is a block by itself.
BLOCK_CHARS = 1_000_000

#: Fixed value of the public vocabulary: how text is cut into words before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: printable Latin-1 bytes stand for themselves."""
    letters, free = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            letters.append(chr(b))
        else:
            letters.append(chr(free))
            free += 1
    return letters


@lru_cache(maxsize=4)
def load_merges(folder: str, name: str) -> tuple[list[int], dict[tuple[int, int], tuple[int, int]]]:
    """Token id of each byte, and (rank, new id) of each pair of ids that merges."""
    with open(f"{folder}/{name}.json", encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
    return [vocab[c] for c in byte_letters()], merges


def replay(words: list[bytes], byte_ids: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[list[int]]:
    """Token ids of each word. All words are laid out in one sequence, and each merge is applied to all its places."""
    token: list[int] = []
    for w in words:
        token.extend(byte_ids[b] for b in w)
        token.append(-1)  # never part of a pair
    n = len(token)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    places: dict[int, list[int]] = {}
    what: dict[int, tuple[int, int, int]] = {}
    get = merges.get
    for i in range(n - 1):
        if (m := get((token[i], token[i + 1]))) is not None:
            if m[0] in places:
                places[m[0]].append(i)
            else:
                places[m[0]] = [i]
                what[m[0]] = (token[i], token[i + 1], m[1])
    ranks = list(places)
    heapq.heapify(ranks)
    while ranks:
        rank = heapq.heappop(ranks)
        left, right, new = what[rank]
        at = places.pop(rank)
        at.sort()
        for i in at:
            if token[i] != left:
                continue
            j = after[i]
            if j >= n or token[j] != right:
                continue
            k = after[j]
            token[i], token[j] = new, -2
            after[i] = k
            if k < n:
                before[k] = i
            h = before[i]
            for p, a, b in ((h, token[h] if h >= 0 else -1, new), (i, new, token[k] if k < n else -1)):
                if a >= 0 and b >= 0 and (m := get((a, b))) is not None:
                    if m[0] in places:
                        places[m[0]].append(p)
                    else:
                        places[m[0]] = [p]
                        what[m[0]] = (a, b, m[1])
                        heapq.heappush(ranks, m[0])
    out, cur = [], []
    for t in token:
        if t >= 0:
            cur.append(t)
        elif t == -1:
            out.append(cur)
            cur = []
    return out


def _blocks(documents: DataFrame, block_chars: int) -> DataFrame:
    """Documents cut into words: block, words (the block's distinct words), docs (doc_id and codes into words)."""

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        find, number = regex.compile(PATTERN).findall, 0
        known: dict[str, int] = {}
        docs: list[dict] = []
        size = 0

        def flush() -> pd.DataFrame:
            return pd.DataFrame({"block": [(part << 33) + number], "words": [list(known)], "docs": [docs]})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                text = text or ""
                if docs and size + len(text) > block_chars:
                    yield flush()
                    number, known, docs, size = number + 1, {}, [], 0
                docs.append({"doc_id": doc_id, "codes": [known.setdefault(w, len(known)) for w in find(text)]})
                size += len(text)
        if docs:
            yield flush()

    return documents.select("doc_id", "text").mapInPandas(
        cut_up, "block bigint, words array<string>, docs array<struct<doc_id:bigint,codes:array<int>>>"
    )


def _lexicon(words: DataFrame, folder: str, name: str) -> DataFrame:
    """Distinct words with their token ids."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        byte_ids, merges = load_merges(folder, name)
        for batch in batches:
            yield pd.DataFrame({"word": batch["word"], "ids": replay([w.encode() for w in batch["word"]], byte_ids, merges)})

    return words.distinct().mapInPandas(encode, "word string, ids array<int>")


def _coded(documents: DataFrame, folder: str, name: str, block_chars: int, value: str, result: str) -> DataFrame:
    blocks = cut(_blocks(documents, block_chars))
    words = blocks.select("block", F.posexplode("words").alias("code", "word"))
    entries = words.join(_lexicon(words.select("word"), folder, name), "word")
    packed = entries.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("code", F.expr(value).alias("v")))).alias("found"))
    joined = blocks.select("block", "docs").join(packed, "block", "left").select("docs", F.col("found.v").alias("v"))
    return joined.select(F.expr(f"inline(transform(docs, d -> struct(d.doc_id AS doc_id, {result})))"))


def encode_corpus(documents: DataFrame, folder: str = TOKENIZERS, name: str = VOCABULARY, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, ids: token ids of each document's whole text, without special tokens.

    Null and empty texts give an empty list; the names of special tokens inside a text are ordinary text. A repeated
    doc_id gives a row per repetition. Other columns are ignored; an empty table gives an empty result. A block holds
    at most ``block_chars`` characters or one document, which bounds the groups that are formed per block.
    """
    ids = "flatten(transform(d.codes, c -> v[c])) AS ids"
    return _coded(documents, folder, name, block_chars, "ids", ids)


def count_tokens(documents: DataFrame, folder: str = TOKENIZERS, name: str = VOCABULARY, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_tokens: as encode_corpus, with the number of tokens only."""
    count = "aggregate(d.codes, 0L, (s, c) -> s + v[c]) AS n_tokens"
    return _coded(documents, folder, name, block_chars, "CAST(size(ids) AS BIGINT)", count)
