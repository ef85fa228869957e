"""Splitting oversized texts at topic boundaries, with overlap (problem 1).

Lexical cohesion: the text is cut into sentences; at each gap between sentences the words of the block before are
compared with those of the block after (cosine); valleys of that curve mark topic boundaries. Each piece ends at the
deepest valley inside its size window, and the next piece starts ``overlap`` characters before that end.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1600
OVERLAP = 200
#: Sentences in the block on either side of a gap.
BLOCK = 4

_GAP = regex.compile(r"""(?:[.!?…]["'”’»)\]]*\s+|[。！？]["'”’»）」』]*\s*|\s*\n\s*)""")
_WORD = regex.compile(r"[\p{L}\p{N}]{3,}|\p{Han}")
_SPACE = regex.compile(r"\s+")


def sentence_starts(text: str) -> list[int]:
    """Places where a sentence or a line begins, without the start of the text."""
    return [m.end() for m in _GAP.finditer(text) if 0 < m.end() < len(text)]


def valley_depths(text: str, gaps: list[int], block: int = BLOCK) -> list[float]:
    """For each gap, how far the similarity of its neighbouring blocks lies below the peaks on either side."""
    edges = [0, *gaps, len(text)]
    bags = [Counter(w.lower() for w in _WORD.findall(text, a, b)) for a, b in zip(edges, edges[1:])]
    left: Counter = Counter()
    right: Counter = Counter()
    for bag in bags[1 : 1 + block]:
        right.update(bag)
    sims = []
    for i in range(len(gaps)):  # the gap between bags i and i+1
        left.update(bags[i])
        if i >= block:
            left.subtract(bags[i - block])
            left = +left
        if i:
            right.subtract(bags[i])
            right = +right
            if i + block < len(bags):
                right.update(bags[i + block])
        small, large = (left, right) if len(left) < len(right) else (right, left)
        dot = sum(n * large[w] for w, n in small.items() if w in large)
        size = math.sqrt(sum(n * n for n in left.values()) * sum(n * n for n in right.values()))
        sims.append(dot / size if size else 0.0)
    n = len(sims)
    up_left, up_right = sims[:], sims[:]
    for i in range(1, n):  # the peak that is reached by climbing without a descent
        if sims[i - 1] >= sims[i]:
            up_left[i] = up_left[i - 1]
    for i in range(n - 2, -1, -1):
        if sims[i + 1] >= sims[i]:
            up_right[i] = up_right[i + 1]
    return [up_left[i] + up_right[i] - 2 * sims[i] for i in range(n)]


def _between_signs(text: str, at: int) -> bool:
    """Whether a cut at this place leaves letters with their combining marks, and joined signs together."""
    return not (0 < at < len(text)) or not (unicodedata.combining(text[at]) or text[at] in "\u200d\ufe0f" or text[at - 1] == "\u200d")


def _last_resort(text: str, low: int, high: int, overlap: int) -> tuple[int, str]:
    """The last white space in (low, high], else the last place between signs; both for this end and for the start of
    the next piece. Where there is no such place, ``high``."""
    fits = lambda at: _between_signs(text, at) and _between_signs(text, at - overlap)
    for m in _SPACE.finditer(text[low:high][::-1]):
        if low < (end := high - m.start()) and fits(end):
            return end, "space"
    return next((at for at in range(high, low, -1) if fits(at)), high), "none"


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP, block: int = BLOCK) -> list[tuple[int, int, str]]:
    """Pieces as (start, end, boundary at the end); boundary is ``topic`` (a valley between sentences), ``sentence`` (a
    gap that is no valley), ``space``, ``none`` or ``end``.

    Every piece has at most ``limit`` characters; each but the first starts ``overlap`` characters before the end of
    the one before; without the overlaps the pieces give back the text. A text within the limit is one piece.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below limit")
    n = len(text)
    if n <= limit:
        return [(0, n, "end")]
    gaps = sentence_starts(text)
    depths = valley_depths(text, gaps, block)
    pieces, start, done, g = [], 0, 0, 0
    while n - start > limit:
        low, high = start + overlap, start + limit  # a piece that ends at low or before leaves no room for the overlap
        while g < len(gaps) and gaps[g] <= low:
            g += 1
        k, inside = g, []
        while k < len(gaps) and gaps[k] <= high:
            inside.append(k)
            k += 1
        half = done + (high - done) // 2
        inside = [i for i in inside if _between_signs(text, gaps[i] - overlap)]
        late = [i for i in inside if gaps[i] > half] or inside
        if late:
            best = max(late, key=lambda i: (round(depths[i], 9), gaps[i]))
            end, kind = gaps[best], "topic" if round(depths[best], 9) > 0 else "sentence"
        else:
            end, kind = _last_resort(text, low, high, overlap)
        pieces.append((start, end, kind))
        done, start = end, end - overlap
    pieces.append((start, n, "end"))
    return pieces


KEEP = ("row_id", "guideline_id", "snippet_id", "section_path")
PIECES = (
    "row_id bigint, guideline_id string, snippet_id string, section_path array<string>, "
    "piece int, n_pieces int, start_at int, end_at int, boundary string, text string"
)


def split_snippets(snippets: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, block: int = BLOCK) -> DataFrame:
    """All snippets as pieces of at most ``limit`` characters, with ids and section_path kept.

    Texts within the limit, empty ones among them, pass as one piece without leaving the JVM; a null text gives one
    piece with null text. Repeated rows are split each by itself. Columns other than KEEP and text are left out.
    Only oversized texts go to Python, whole; the cost is linear in their length and there is no shuffle.
    """

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for *keys, text in zip(*(batch[c] for c in (*KEEP, "text"))):
                found = split_text(text, limit, overlap, block)
                rows += [(*keys, k, len(found), a, b, kind, text[a:b]) for k, (a, b, kind) in enumerate(found)]
            if rows:
                yield pd.DataFrame(rows, columns=[*KEEP, "piece", "n_pieces", "start_at", "end_at", "boundary", "text"])

    rows = snippets.select(*KEEP, "text")
    big = F.coalesce(F.length("text") > limit, F.lit(False))
    whole = rows.where(~big).select(
        *KEEP,
        F.lit(0).alias("piece"),
        F.lit(1).alias("n_pieces"),
        F.lit(0).alias("start_at"),
        F.coalesce(F.length("text"), F.lit(0)).alias("end_at"),
        F.lit("end").alias("boundary"),
        "text",
    )
    return whole.unionByName(rows.where(big).mapInPandas(cut_up, PIECES))
