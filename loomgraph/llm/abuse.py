"""Scoring documents for abusive, hateful or sexually explicit language (problem 9).

A factorization machine over hashed terms: besides a weight per term it learns a short vector per term, and the
product of two vectors is the weight of the pair, such as an insult together with a mention of a group. Judgements
are given per document but abuse sits in single sentences, so the machine scores sentences, a document has the score
of its worst sentence, and training alternates between fitting and choosing which sentences a judgement is about.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound on the judged documents that are used for training (those with the smallest hash of their id).
MAX_LABELLED = 20_000
#: Hash buckets for terms and length of a term's vector.
BUCKETS = 1 << 17
FACTORS = 6
#: From this score on a document counts as a case, if so few of the documents judged clear reach it out of fold.
THRESHOLD = 0.5
FALSE_ALARMS = 0.01
#: Share of the documents judged clear that may be taken for misjudged. More would let a common harmless sentence that
#: once scored as a case stay one, as its clear documents would no longer count.
MISJUDGED = 0.005
ROUNDS = 2
FOLDS = 3
EPOCHS = 10
BATCH = 256

#: Fixed look-alike letters of other scripts, and signs that are written for letters.
LOOKS = str.maketrans(
    {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "к": "k", "м": "m", "т": "t",
     "ο": "o", "α": "a", "ι": "i", "ν": "v", "κ": "k", "τ": "t", "ı": "i", "ł": "l", "ø": "o", "ß": "ss"}
)
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "€": "e"})

class _Folded(dict):
    """For str.translate: drops accents and invisible signs, turns look-alikes; fills itself on demand."""

    def __missing__(self, code: int) -> object:
        to = LOOKS.get(code, None if unicodedata.category(chr(code)) in ("Mn", "Cf") else code)
        self[code] = to
        return to


_FOLDED = _Folded()
_END = re.compile(r"(?<=\blol)\s+|(?<=[\U0001F300-\U0001FAFF])\s*|(?<=[.!?])[\"'”’)\]]*\s+|(?<=[。！？])|[\r\n]+|(?<=[.!?])(?=[㐀-鿿])")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_](?:[ .\-_*]|[.\-_] ?)){3,}[^\W\d_](?![^\W_])")
_TOKEN = re.compile(r"[㐀-鿿]|[^\W_]+(?:[*@$!€#]+(?=\w)[^\W_]*)*|[\U0001F300-\U0001FAFF☀-➿]")
_RUN = re.compile(r"(.)\1+")


#: The same ends but for ``lol``, led by the one sign that stands at each of them, so that most signs are passed at once.
_QUICK = re.compile(
    r"[.!?。！？\r\n\U0001F300-\U0001FAFF](?:(?<=[.!?])(?:[\"'”’)\]]*\s+|(?=[㐀-鿿]))|(?<=[。！？])|(?<=[\r\n])[\r\n]*|(?<=[\U0001F300-\U0001FAFF])\s*)"
)


def sentences(text: str) -> list[str]:
    if "lol" in text:
        found = _END.split(text)
    else:
        found, start = [], 0
        for m in _QUICK.finditer(text):
            at = m.start()
            found.append(text[start : at if text[at] in "\r\n" else at + 1])
            start = m.end()
        found.append(text[start:])
    return [s for s in found if s and not s.isspace()]


def plain(text: str) -> str:
    """Small letters without accents, invisible signs, look-alikes and letters set apart."""
    text = text.lower() if text.isascii() else unicodedata.normalize("NFKD", text.casefold()).translate(_FOLDED)
    return _SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m.group()), text)


def _words(t: str) -> list[str]:
    """The words that a token stands for."""
    if "*" in t:
        return ["<masked>", f"<{t[0]}{len(t)}{t[-1]}>"]
    if not t.isalpha():
        letters = sum(c.isalpha() for c in t)
        if t[0].isdigit() and letters < 2 or letters < 0.45 * len(t):
            return ["#" if any(c.isdigit() for c in t) else t]
        t = t.translate(LEET)
    return [_RUN.sub(r"\1", t)]


def terms(sentence: str) -> list[str]:
    """Words of a sentence in one spelling: doubled letters once, digits for letters undone, codes as ``#``."""
    return [w for t in _TOKEN.findall(plain(sentence)) for w in _words(t)]


_MASK = np.uint64(BUCKETS - 1)


def _number(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode("utf-8", "replace"), digest_size=8).digest(), "little")


class Bags(NamedTuple):
    """Distinct buckets of each sentence, one after the other: ``flat``, and how many each has: ``sizes``."""

    flat: np.ndarray
    sizes: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)


class _Words:
    """Words as numbers, with the buckets of what each word shows by itself. Made anew for each batch."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.number: list[int] = []
        self.own: list[tuple[int, int]] = []  # (word, bucket) of stems and letter sets

    def __call__(self, word: str) -> int:
        if (at := self.index.get(word)) is None:
            at = self.index[word] = len(self.number)
            self.number.append(_number(word))
            if len(word) > 3 and word.isalpha():
                self.own.append((at, _number(f"{word[0]}{''.join(sorted(word[1:-1]))}{word[-1]}?") & (BUCKETS - 1)))
                if len(word) > 5:
                    self.own.append((at, _number(f"{word[:4]}~") & (BUCKETS - 1)))
        return at

    def bags(self, ids: list[int], counts: list[int]) -> Bags:
        """Buckets of the distinct words, neighbouring pairs, word stems, and words with their inner letters in any order."""
        word, owner = np.array(ids, dtype=np.int64), np.repeat(np.arange(len(counts)), counts)
        number = np.array(self.number, dtype=np.uint64)[word] if len(word) else np.zeros(0, np.uint64)
        a, b = number[:-1], number[1:]
        mixed = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        same = owner[1:] == owner[:-1]
        parts = [(owner, number & _MASK), (owner[:-1][same], mixed[same] & _MASK)]
        if self.own and len(word):
            at, bucket = (np.array(c, dtype=np.int64) for c in zip(*self.own))
            begin = np.searchsorted(at, np.arange(len(self.number)))
            until = np.searchsorted(at, np.arange(len(self.number)), side="right")
            for k in range(2):
                has = begin[word] + k < until[word]
                parts.append((owner[has], bucket[begin[word][has] + k]))
        keys = np.sort(np.concatenate([o * BUCKETS + h.astype(np.int64) for o, h in parts]))
        keys = keys[np.diff(keys, prepend=-1) > 0]
        return Bags(keys % BUCKETS, np.bincount(keys // BUCKETS, minlength=len(counts)).astype(np.int64))


def hashed(words: list[str]) -> list[int]:
    """The buckets of one sentence's words."""
    known = _Words()
    return known.bags([known(w) for w in words], [len(words)]).flat.tolist()


def sentence_bags(found: Iterable[str]) -> Bags:
    """The buckets of sentences. Each spelling of a token is brought to its words once."""
    known = _Words()
    spelled: dict[str, list[int]] = {}
    ids: list[int] = []
    counts = []
    for s in found:
        before = len(ids)
        for t in _TOKEN.findall(plain(s)):
            if (at := spelled.get(t)) is None:
                at = spelled[t] = [known(w) for w in _words(t)]
            ids += at
        counts.append(len(ids) - before)
    return known.bags(ids, counts)


class Machine(NamedTuple):
    """Bias, weight and vector per bucket, and the log-odds from which a document is a case; buckets that were never
    trained have zeros."""

    bias: float
    weight: np.ndarray
    vector: np.ndarray
    cutoff: float = 0.0

    def score(self, features: Bags | list[list[int]]) -> np.ndarray:
        """Log-odds of each bag of buckets."""
        if not isinstance(features, Bags):
            features = Bags(np.array([i for f in features for i in f], dtype=np.int64), np.array([len(f) for f in features], dtype=np.int64))
        flat, sizes = features
        out = np.full(len(sizes), self.bias)
        full = sizes > 0
        if not full.any():
            return out
        at = features.starts[full]
        x = 1 / np.sqrt(sizes[full])
        w = np.add.reduceat(self.weight[flat], at) * x
        v = self.vector[flat]
        s = np.add.reduceat(v, at, axis=0) * x[:, None]
        q = np.add.reduceat((v * v).sum(axis=1), at) * x * x
        out[full] += w + 0.5 * ((s * s).sum(axis=1) - q)
        return out


def fit(bags: Bags, positive: np.ndarray, negative: np.ndarray, epochs: int = EPOCHS, factors: int = FACTORS, seed: int = 3, rate: float = 0.15, decay: float = 2e-5) -> Machine:
    """Fit by AdaGrad on bags with ``positive`` and ``negative`` weight each. Same input, same machine."""
    rng = np.random.default_rng(seed)
    used = np.flatnonzero((bags.sizes > 0) & (positive + negative > 0))
    begin, size_of = bags.starts[used], bags.sizes[used]
    weight, vector = np.zeros(BUCKETS), np.zeros((BUCKETS, factors))
    seen = np.zeros(len(bags.sizes), bool)
    seen[used] = True
    touched = np.unique(bags.flat[np.repeat(seen, bags.sizes)])
    vector[touched] = rng.normal(0, 0.05, (len(touched), factors))
    g_w, g_v = np.full(BUCKETS, 1e-3), np.full((BUCKETS, factors), 1e-3)
    total_p, total_n = positive.sum(), negative.sum()
    bias, g_b = float(np.log((total_p + 1) / (total_n + 1))), 1e-3
    p, n = positive[used], negative[used]
    for _ in range(epochs):
        order = rng.permutation(len(used))
        for k in range(0, len(order), BATCH):
            batch = order[k : k + BATCH]
            lens = size_of[batch]
            starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
            rows = np.repeat(np.arange(len(batch)), lens)
            flat = bags.flat[np.arange(len(rows)) + (begin[batch] - starts)[rows]]
            x = 1 / np.sqrt(lens)
            v = vector[flat]
            s = np.add.reduceat(v, starts, axis=0) * x[:, None]
            q = np.add.reduceat((v * v).sum(axis=1), starts) * x * x
            z = bias + np.add.reduceat(weight[flat], starts) * x + 0.5 * ((s * s).sum(axis=1) - q)
            prob = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            err = n[batch] * prob - p[batch] * (1 - prob)
            e = (err * x)[rows]
            by = np.argsort(flat, kind="stable")
            ordered = flat[by]
            first = np.flatnonzero(np.diff(ordered, prepend=-1))
            idx = ordered[first]
            dw = np.add.reduceat(e[by], first) + decay * weight[idx] * len(batch)
            grad = e[:, None] * (s[rows] - v * x[rows][:, None])
            dv = np.add.reduceat(grad[by], first, axis=0) + decay * vector[idx] * len(batch)
            g_w[idx] += dw * dw
            g_v[idx] += dv * dv
            weight[idx] -= rate * dw / np.sqrt(g_w[idx])
            vector[idx] -= 0.3 * rate * dv / np.sqrt(g_v[idx])
            db = err.sum()
            g_b += db * db
            bias -= rate * db / np.sqrt(g_b)
    return Machine(float(bias), weight.astype(np.float32), vector.astype(np.float32))


def _once(bags: Bags) -> tuple[Bags, list[int]]:
    """Equal bags once, and for each bag its place among them."""
    seen: dict[bytes, int] = {}
    ends = np.cumsum(bags.sizes)
    place = [seen.setdefault(bags.flat[e - k : e].tobytes(), len(seen)) for e, k in zip(ends.tolist(), bags.sizes.tolist())]
    flats = [np.frombuffer(b, dtype=bags.flat.dtype) for b in seen]
    return Bags(np.concatenate([np.zeros(0, np.int64), *flats]), np.array([len(f) for f in flats], dtype=np.int64)), place


def train(texts: list[str], flags: list[float], rounds: int = ROUNDS, folds: int = FOLDS, seed: int = 3) -> Machine:
    """Fit from documents and the share of judgements that flagged each.

    First every sentence of a flagged document counts as flagged that is not as common in unflagged ones. Then, round
    by round, each document's sentences are scored by a machine that was fitted without it: a flagged document
    that scores no higher than unflagged ones do is taken for misjudged, the judgement of the others is laid on their
    highest sentences, and sentences by which the highest few unflagged documents score as cases are left out. The
    last fit uses all documents. Equal sentences are counted once with weights.

    The cutoff is calibrated on the machines of the last round: the log-odds that all but FALSE_ALARMS of the unflagged
    documents stay below when they were not trained on, and 0 at least. With few judgements it is high.
    """
    known: dict[str, int] = {}
    split = [[known.setdefault(x, len(known)) for x in sentences(text)] for text in texts]
    features, same = _once(sentence_bags(known))
    docs = [np.array(list(dict.fromkeys(k for i in own if features.sizes[k := same[i]])), dtype=int) for own in split]
    n = len(features.sizes)
    flagged = [i for i, f in enumerate(flags) if f > 0.5 and len(docs[i])]
    clear = [i for i, f in enumerate(flags) if f < 0.5 and len(docs[i])]
    if not flagged or not clear:
        return Machine(-10.0 if not flagged else 10.0, np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32))

    def counted(groups: list[np.ndarray]) -> np.ndarray:
        return np.bincount(np.concatenate([np.zeros(0, int), *groups]), minlength=n).astype(float)

    def refit(chosen: dict[int, np.ndarray], left_out: np.ndarray, without: int | None, epochs: int, salt: int) -> Machine:
        """``chosen``: the sentences that judgements are laid on; ``without``: the fold to leave out."""
        use = lambda i: without is None or i % folds != without
        pos = counted([h for i, h in chosen.items() if use(i)])
        neg = counted([docs[i] for i in clear if use(i)]) * ~left_out
        neg += counted([np.setdiff1d(docs[i], h) for i, h in chosen.items() if use(i)])
        share = pos / np.maximum(pos + neg, 1)
        return fit(features, np.minimum(pos, 3) * (share > 0.4) * 2.0, np.minimum(neg, 3) * (share < 0.6), epochs=epochs, seed=seed + salt)

    chosen = {i: docs[i] for i in flagged}
    left_out = np.zeros(n, bool)
    for k in range(rounds):
        scored = [refit(chosen, left_out, fold, max(3, EPOCHS // 2), 1 + k * folds + fold).score(features) for fold in range(folds)]
        held_out = [scored[i % folds][docs[i]].max() for i in clear]
        usual, odd = np.quantile(held_out, [0.95, 1 - MISJUDGED])
        chosen = {}
        for i in flagged:
            z = scored[i % folds][docs[i]]
            if z.max() > usual:
                chosen[i] = docs[i][z >= max(usual, z.max() - 2.0)]
        left_out = np.zeros(n, bool)
        for i in clear:
            z = scored[i % folds][docs[i]]
            left_out[docs[i][z > max(0.0, odd)]] = True
        if not chosen:
            chosen = {i: docs[i] for i in flagged}
            break
    cutoff = max(0.0, float(np.quantile(held_out, 1 - FALSE_ALARMS)))
    return refit(chosen, left_out, None, EPOCHS, 0)._replace(cutoff=cutoff)


def labelled_texts(documents: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> list[tuple[str, float]]:
    """Texts of judged documents with the share of their judgements that flag them, ``bound`` of them at most.

    Null judgements do not count; of rows with the same doc_id the first text in order of letters is used.
    """
    shares = labels.where(F.col("flagged").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("flagged").alias("share"))
    chosen = shares.where(F.col("share") != 0.5).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = documents.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    found = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("share").alias("share")).collect()
    return [(r.text, float(r.share)) for r in sorted(found, key=lambda r: r.doc_id)]


def score_documents(documents: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, source, score (0 to 1, of the worst sentence; 0.5 at the cutoff), flagged. One row per row of ``documents``.

    Null, empty and blank texts have score 0. Training uses at most ``bound`` judged documents on the driver; the
    machine (BUCKETS * (FACTORS + 1) numbers) goes to the workers with the function. Texts are scored whole, in one
    pass without a shuffle. Without usable judgements nothing is flagged.
    """
    pairs = labelled_texts(documents, labels, bound)
    machine = train([t for t, _ in pairs], [f for _, f in pairs])
    shared = documents.sparkSession.sparkContext.broadcast(tuple(machine))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Machine(*shared.value)
        for batch in batches:
            known: dict[str, int] = {}
            split = [[known.setdefault(s, len(known)) for s in sentences(text)] if text else [] for text in batch["text"]]
            z = m.score(sentence_bags(known))
            worst = np.array([max((z[k] for k in own), default=-np.inf) for own in split]) - m.cutoff
            score = 1 / (1 + np.exp(-np.clip(worst, -50, 50)))
            score[np.isneginf(worst)] = 0.0
            yield pd.DataFrame({"doc_id": batch["doc_id"], "source": batch["source"], "score": score.round(6), "flagged": score >= threshold})

    return documents.select("doc_id", "source", "text").mapInPandas(run, "doc_id bigint, source string, score double, flagged boolean")


def rates_by_source(scored: DataFrame) -> DataFrame:
    """source (null as ``unknown``), n_docs, n_flagged, rate, mean_score."""
    hit = F.sum(F.col("flagged").cast("int"))
    return scored.groupBy(F.coalesce("source", F.lit("unknown")).alias("source")).agg(
        F.count(F.lit(1)).alias("n_docs"), hit.alias("n_flagged"), (hit / F.count(F.lit(1))).alias("rate"), F.avg("score").alias("mean_score")
    )
