"""One consistent table from files whose fields drift, and a report of each change (problem 4).

The fields that a feed's files have had, with their types and nesting, form a schema graph. Similarity flooding
compares the graph with itself: match scores start from the names and are propagated along nesting and types until
they settle. Consistent correspondences then join spellings to one field, and files are cast to one table by them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import ids
from loomgraph.operators.skew import heavy_keys, lookup_join
from loomgraph.session import cut

#: Fixed other names of fields, in normal form.
ALIASES = {"guidelinetitle": "title"}
#: Least settled score of a pair with equal names, and of a pair with other names.
LEAST_SCORE = 0.1
ACCEPT = 0.8
#: How alike two types are (any other pair: 0.1).
TYPE_LIKENESS = {
    ("string", "number"): 0.6,
    ("string", "boolean"): 0.5,
    ("string", "array of strings"): 0.7,
    ("object", "array of objects"): 0.7,
    ("array of strings", "array of objects"): 0.5,
    ("string", "object"): 0.3,
    ("string", "array of objects"): 0.3,
}

#: Columns of the consistent table that hold text, and those that hold lists of text, by field.
TEXT_COLUMNS = ("title", "organization", "date", "journal", "pages", "year", "version", "abstract", "scope", "openaccess", "fundingsource")
LIST_COLUMNS = ("authors", "reviewers", "keywords")
KNOWN = frozenset((*TEXT_COLUMNS, *LIST_COLUMNS))

HEADS = "file_id bigint, feed string, exported_at timestamp_ntz, fields array<struct<path:string,type:string,value:string>>"


def normal_name(name: str) -> str:
    """Lower case without blanks, ``_`` and ``-``, with other names resolved."""
    plain = "".join(c for c in name.lower() if not c.isspace() and c not in "_-")
    return ALIASES.get(plain, plain)


def normal_path(path: str) -> str:
    return ".".join(map(normal_name, path.split(".")))


def type_of(value: object) -> str | None:
    """The type of a JSON value; None for null and empty arrays, which count as absent."""
    if value is None or value == []:
        return None
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    if isinstance(value, str):
        return "string"
    if isinstance(value, dict):
        return "object"
    return "array of objects" if any(isinstance(x, dict) for x in value) else "array of strings"


def head_fields(body: str | None) -> list[tuple[str, str, str | None]] | None:
    """(path, type, JSON of the value at depth one) of the head; None if the body has no first content object."""
    try:
        root = json.loads(body) if body is not None else None
    except (ValueError, RecursionError):
        return None
    content = root.get("content") if isinstance(root, dict) else None
    if not isinstance(content, list) or not content or not isinstance(content[0], dict):
        return None
    head = content[0].get("content")
    found: dict[str, tuple[str, str | None]] = {}
    for key, value in head.items() if isinstance(head, dict) else ():
        if (kind := type_of(value)) is None:
            continue
        found[key] = (kind, json.dumps(value, ensure_ascii=False))
        for part in (value,) if kind == "object" else value if kind == "array of objects" else ():
            for sub, inner in part.items() if isinstance(part, dict) else ():
                if (inner_kind := type_of(inner)) is not None:
                    found.setdefault(f"{key}.{sub}", (inner_kind, None))
    return [(path, *rest) for path, rest in found.items()]


def read_heads(raw: DataFrame) -> DataFrame:
    """The heads of all files that have one (HEADS); files with other bodies are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [head_fields(b) for b in batch["body"]]
            kept = batch[[f is not None for f in found]].drop(columns="body")
            if len(kept):
                fields = [[{"path": p, "type": t, "value": v} for p, t, v in f] for f in found if f is not None]
                yield kept.assign(fields=pd.Series(fields, index=kept.index, dtype=object))

    cols = raw.select("file_id", F.coalesce("feed", F.lit("")).alias("feed"), F.col("exported_at").cast("timestamp_ntz").alias("exported_at"), "body")
    return cols.mapInPandas(run, HEADS)


def _letter_pairs(name: str) -> set[str]:
    return {f"^{name}$"[i : i + 2] for i in range(len(name) + 1)}


def _name_likeness(a: str, b: str) -> float:
    """1 for names in the same normal form, else the share of common letter pairs."""
    if a == b:
        return 1.0
    x, y = _letter_pairs(a), _letter_pairs(b)
    return len(x & y) * 2 / (len(x) + len(y))


class _Likeness:
    """How alike names in normal form are: the share of common letter pairs, 1 for equal names."""

    def __init__(self, names: Iterable[str]) -> None:
        self.names = sorted(set(names))
        self.at = {name: x for x, name in enumerate(self.names)}
        pairs = [_letter_pairs(name) for name in self.names]
        self.size = np.array([len(p) for p in pairs], dtype=float)
        having: dict[str, list[int]] = {}
        for x, p in enumerate(pairs):
            for pair in p:
                having.setdefault(pair, []).append(x)
        postings = {pair: np.array(xs) for pair, xs in having.items()}
        self.having = [[postings[pair] for pair in sorted(p)] for p in pairs]

    def row(self, x: int) -> np.ndarray:
        """The likeness of a name with every name."""
        common = np.zeros(len(self.names))
        for xs in self.having[x]:
            common[xs] += 1
        return 2 * common / (self.size[x] + self.size)


def _start_kinds(kinds: list[str]) -> np.ndarray:
    return np.array([[1.0 if a == b else TYPE_LIKENESS.get((a, b), TYPE_LIKENESS.get((b, a), 0.1)) for b in kinds] for a in kinds]).reshape(len(kinds), len(kinds))


class SchemaGraph:
    """The paths of one feed with their types and nesting, and the pairs of paths that are compared: each path with
    itself and with the first of those whose names are equal in normal form, so the pairs grow with the paths."""

    def __init__(self, elements: list[tuple[str, Iterable[str]]]) -> None:
        elements = sorted((p, sorted(t)) for p, t in elements)
        self.paths = [p for p, _ in elements]
        self.types = [t for _, t in elements]
        self.normal = [normal_path(p) for p in self.paths]
        self.last = [normal_name(p.rpartition(".")[2]) for p in self.paths]
        at = {p: i for i, p in enumerate(self.paths)}
        self.parent = [at.get(p.rpartition(".")[0], -1) if "." in p else -1 for p in self.paths]
        self.nested = ["." in p for p in self.paths]
        self.children: list[list[int]] = [[] for _ in self.paths]
        for i, up in enumerate(self.parent):
            if up >= 0:
                self.children[up].append(i)
        first: dict[str, int] = {}
        self.pairs = sorted({(i, i) for i in range(len(self.paths))} | {(first.setdefault(f, i), i) for i, f in enumerate(self.normal)})

    def flood(self, rounds: int = 60, tolerance: float = 1e-3) -> dict[tuple[int, int], float]:
        """Settled match score of each pair, as a share of what the two paths have with themselves.

        Scores start from the names. Each round a pair's score grows by what flows along equal edges: from the pair of
        its parents, from the pairs of its children (divided by their number) and from the pairs of its types; types
        gain from the paths that have them. All are scaled to 1 until they settle.
        """
        n, pairs = len(self.pairs), self.pairs
        if not n:
            return {}
        at = {p: k for k, p in enumerate(pairs)}
        start = np.array([_name_likeness(self.last[i], self.last[j]) for i, j in pairs])
        above = np.array([at.get((min(u, v), max(u, v)), -1) if (u := self.parent[i]) >= 0 and (v := self.parent[j]) >= 0 else -1 for i, j in pairs])
        held = above >= 0
        width = np.array([max(len(self.children[i]), len(self.children[j]), 1) for i, j in pairs], dtype=float)
        kinds = sorted({k for t in self.types for k in t})
        number = {k: x for x, k in enumerate(kinds)}
        start_kinds = _start_kinds(kinds)
        has = np.zeros((len(self.paths), len(kinds)))
        for i, t in enumerate(self.types):
            has[i, [number[k] for k in t]] = 1 / max(len(t), 1)
        left, right = has[[i for i, _ in pairs]], has[[j for _, j in pairs]]
        # a child's best partner below the other parent counts for the pair of the parents
        score, kind_score = start, start_kinds
        for _ in range(rounds):
            s, k = start + score, start_kinds + kind_score
            new = s + ((left @ k) * right).sum(axis=1)
            new[held] += s[above[held]]
            below = np.zeros(n)
            best: dict[tuple[int, int], float] = {}
            for x in np.flatnonzero(held):
                key = (int(above[x]), pairs[x][0])
                best[key] = max(best.get(key, 0.0), s[x])
            for (up, _), v in best.items():
                below[up] += v
            new += below / width
            gain = (left * s[:, None]).T @ right
            new_kinds = k + (gain + gain.T) / (2 * n)
            new, new_kinds = new / max(new.max(), 1e-12), new_kinds / max(new_kinds.max(initial=0), 1e-12)
            change = np.abs(new - score).max()
            score, kind_score = new, new_kinds
            if change < tolerance:
                break
        own = {i: score[at[i, i]] for i in range(len(self.paths))}
        return {(i, j): float(score[x] / np.sqrt(own[i] * own[j])) for x, (i, j) in enumerate(pairs)}


class WholeGraph(SchemaGraph):
    """A schema graph in which every two paths of one depth are compared. No list of these pairs is kept.

    Of a pair's score, one part is the likeness of the names times a factor that is the same for all pairs, one depends
    only on the types of the two paths, one only on their parents, and one is that of two containers (paths with others
    below them) for their children. The rules of ``SchemaGraph.flood`` hold for each part by itself, so the factor and
    the parts are settled, with all pairs in their sums, and the scores of a path are read off when they are asked for.
    Memory grows with the square of the containers and with names times types below containers, time with the paths squared.
    """

    def settle(self, rounds: int = 60, tolerance: float = 1e-6) -> None:
        self.alike = _Likeness(self.last)
        self.name = np.array([self.alike.at[x] for x in self.last], dtype=int)
        kinds = sorted({k for t in self.types for k in t})
        sets = sorted({tuple(t) for t in self.types})
        number = {t: x for x, t in enumerate(sets)}
        self.set = np.array([number[tuple(t)] for t in self.types], dtype=int)
        share = np.array([[(k in t) / max(len(t), 1) for k in kinds] for t in sets]).reshape(len(sets), len(kinds))
        start_kinds = _start_kinds(kinds)
        deep = np.array(self.nested, dtype=bool)
        self.levels = [np.flatnonzero(~deep), np.flatnonzero(deep)]

        holders = np.array([i for i, c in enumerate(self.children) if c], dtype=int)
        m = len(holders)
        place = {u: x for x, u in enumerate(holders.tolist())}
        self.holder = np.array([place.get(i, m) for i in range(len(self.paths))], dtype=int)  # m: no container
        self.under = np.array([place.get(u, m) for u in self.parent], dtype=int)  # m: no parent
        h_set, h_under = self.set[holders], self.under[holders]
        h_sets, h_unders = np.ix_(h_set, h_set), np.ix_(h_under, h_under)
        compared = deep[holders][:, None] == deep[holders][None, :]
        below = np.flatnonzero(self.under < m)
        below = below[np.lexsort((self.set[below], self.under[below]))]
        n_below = np.bincount(self.under[below], minlength=m)
        first_below = np.cumsum(n_below) - n_below
        width = np.maximum(n_below[:, None], n_below[None, :])
        # children of one container with the same types; these lie container by container
        first_alike = np.flatnonzero(np.diff(self.under[below] * len(sets) + self.set[below], prepend=-1))
        alike_set = self.set[below][first_alike]
        first_of_holder = np.flatnonzero(np.diff(self.under[below][first_alike], prepend=-1))
        inner = np.flatnonzero(h_under < m)  # containers that are children: of keys with a point
        row_inner = np.argsort(below)[np.searchsorted(np.sort(below), holders[inner])]

        # by names alone: sums over all pairs by types, likeness of containers, best likeness of a name to such children
        per_name = [np.zeros((len(self.alike.size), len(sets))) for _ in self.levels]
        for level, count in zip(self.levels, per_name):
            np.add.at(count, (self.name[level], self.set[level]), 1)
        names_below, child_name = np.unique(self.name[below], return_inverse=True)
        row_below = {x: k for k, x in enumerate(names_below.tolist())}
        sums, held, best_name = np.zeros((len(sets), len(sets))), np.zeros((m, m)), np.zeros((len(names_below), len(first_alike)))
        for x in range(len(self.alike.size)):
            row = self.alike.row(x)
            for count in per_name:
                sums += np.outer(count[x], row @ count)
            held[self.name[holders] == x] = row[self.name[holders]]
            if x in row_below:
                best_name[row_below[x]] = np.maximum.reduceat(row[self.name[below]], first_alike)
        children, child = np.unique(child_name * len(sets) + self.set[below], return_inverse=True)  # alike by name and types

        n_sets = [count.sum(axis=0) for count in per_name]
        under_sets = np.zeros((m + 1, len(sets)))
        np.add.at(under_sets, (self.under[self.levels[1]], self.set[self.levels[1]]), 1)
        n_pairs = max(sum(len(level) * (len(level) + 1) // 2 for level in self.levels), 1)

        factor, of_types, of_parents, of_children, kind_score = 1.0, np.zeros((len(sets), len(sets))), np.zeros((m + 1, m + 1)), np.zeros((m, m)), start_kinds
        for _ in range(rounds if self.paths else 0):
            f, k = 1 + factor, start_kinds + kind_score
            flow = share @ k @ share.T
            pair = (f * held + of_types[h_sets] + of_parents[h_unders] + of_children) * compared
            down = np.pad(pair, (0, 1))
            up = np.zeros((m, m))
            if m:
                best = np.array([np.maximum.reduceat(f * best_name[c // len(sets)] + of_types[c % len(sets), alike_set], first_of_holder) for c in children.tolist()])
                best = best[child]
                np.maximum.at(best, (row_inner[:, None], h_under[inner][None, :]), (f * held + of_types[h_sets] + of_children)[np.ix_(inner, inner)])
                up = np.add.reduceat(best, first_below, axis=0) + n_below[:, None] * of_parents[:m, :m]
                up = (np.triu(up) + np.triu(up, 1).T) * compared / width
            own = f + of_types[self.set, self.set] + of_parents[self.under, self.under]
            own[holders] += of_children.diagonal()
            total = f * sums + sum(np.outer(c, c) for c in n_sets) * of_types + under_sets.T @ of_parents @ under_sets
            np.add.at(total, (h_set[:, None], h_set[None, :]), of_children * compared)
            total += np.diag(np.bincount(self.set, weights=own, minlength=len(sets)))
            new_kinds = k + share.T @ (total + total.T) @ share / (4 * n_pairs)
            own += flow[self.set, self.set] + down[self.under, self.under]
            own[holders] += up.diagonal()
            scale = max(own.max(), ((pair + flow[h_sets] + down[h_unders] + up) * compared).max(initial=0))
            settled = f / scale, (of_types + flow) / scale, (of_parents + down) / scale, (of_children + up) / scale, new_kinds / new_kinds.max()
            change = max(np.abs(x - y).max(initial=0) for x, y in zip(settled, (factor, of_types, of_parents, of_children, kind_score)))
            factor, of_types, of_parents, of_children, kind_score = settled
            if change < tolerance:
                break
        even = lambda x: (x + x.T) / 2  # noqa: E731  a pair has the same score, to the last digit, from both its paths
        self.factor, self.of_types, self.of_parents, self.of_children = factor, even(of_types), even(of_parents), np.pad(even(of_children), (0, 1))
        self.own = factor + self.of_types[self.set, self.set] + self.of_parents[self.under, self.under] + self.of_children[self.holder, self.holder]

    def scores(self, i: int, others: np.ndarray) -> np.ndarray:
        """Settled score of a path with ``others`` of its depth, as a share of what the two paths have with themselves."""
        score = self.factor * self.alike.row(self.name[i])[self.name[others]] + self.of_types[self.set[i], self.set[others]]
        score = score + self.of_parents[self.under[i], self.under[others]] + self.of_children[self.holder[i], self.holder[others]]
        return score / np.sqrt(self.own[i] * self.own[others])

    def best_pairs(self, accept: float) -> list[tuple[int, int, float]]:
        """Pairs of other names that reach ``accept`` and of which neither path has a better partner of another name."""
        best: dict[int, dict[int, float]] = {}
        for level in self.levels:
            for i in level.tolist():
                others = level[self.name[level] != self.name[i]]
                s = self.scores(i, others)
                if len(others) and s.max() >= accept:
                    best[i] = dict.fromkeys(others[s == s.max()].tolist(), float(s.max()))
        return [(i, j, s) for i, found in best.items() for j, s in found.items() if i < j and i in best.get(j, ())]


def flood(paths: list[str], types: list[set[str]]) -> np.ndarray:
    """Settled match scores between the elements of a schema graph as a matrix; 0 for pairs of different depth."""
    graph = WholeGraph(list(zip(paths, types)))
    graph.settle()
    place = {p: i for i, p in enumerate(paths)}
    at = np.array([place[p] for p in graph.paths], dtype=int)
    out = np.zeros((len(paths), len(paths)))
    for level in graph.levels:
        for i in level.tolist():
            out[at[i], at[level]] = np.minimum(graph.scores(i, level), 1.0)
    return out


def candidates(elements: list[tuple[str, Iterable[str]]], accept: float = ACCEPT, exact: bool = False) -> list[tuple[str, str, float]]:
    """Pairs of paths that may be one field, by settled score: with equal names from LEAST_SCORE on, with others if the
    score is at least ``accept`` and neither path has a better partner among paths of other names. Best first. With
    ``exact`` only pairs of equal names are compared."""
    if exact:
        graph = SchemaGraph(elements)
        chosen = [(i, j, s) for (i, j), s in graph.flood().items() if i != j and s >= LEAST_SCORE]
    else:
        graph = WholeGraph(elements)
        graph.settle()
        same = [(i, j, float(graph.scores(i, np.array([j]))[0])) for i, j in graph.pairs if i != j]
        chosen = [x for x in same if x[2] >= LEAST_SCORE] + graph.best_pairs(accept)
    return [(graph.paths[i], graph.paths[j], s) for i, j, s in sorted(chosen, key=lambda x: (-x[2], x[0], x[1]))]


def correspondences(
    elements: list[tuple[str, Iterable[str]]], least: float = ACCEPT, exact: bool = True, found: list[tuple[str, str, float]] | None = None, apart: Iterable[tuple[str, str]] = ()
) -> dict[str, str]:
    """The field of each path: paths that stand for the same field share its name.

    Candidates (``found``, else computed) are taken best first, parents before what is nested in them; a nested pair
    needs its parents to correspond. With ``exact`` a candidate counts only if the names agree in normal form; without,
    one of other names counts, too, unless it is among the pairs ``apart``. A field is named by the normal form of a
    known column among its paths, else of its first path.
    """
    paths = sorted(p for p, _ in elements)
    root = {p: p for p in paths}
    blocked = {frozenset(x) for x in apart}

    def find(p: str) -> str:
        while root[p] != p:
            p = root[p]
        return p

    for depth in (0, 1):
        for a, b, _ in candidates(elements, least, exact) if found is None else found:
            if ("." in a) != bool(depth) or ("." in b) != bool(depth):
                continue
            equal = normal_path(a) == normal_path(b)
            if depth and not equal:
                u, v = a.rpartition(".")[0], b.rpartition(".")[0]
                if u not in root or v not in root or find(u) != find(v):
                    continue
            if equal or (not exact and frozenset((a, b)) not in blocked):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    groups: dict[str, list[str]] = {}
    for p in paths:
        groups.setdefault(find(p), []).append(p)
    name: dict[str, str] = {}
    for depth in (0, 1):
        for members in groups.values():
            if ("." in members[0]) != bool(depth):
                continue
            plain = sorted(map(normal_path, members), key=lambda f: (f not in KNOWN, f))
            top = members[0].rpartition(".")[0]
            field = f"{name[top]}.{plain[0].rpartition('.')[2]}" if depth and top in name else plain[0]
            for p in members:
                name[p] = field
    return name


def _normal(path: Column) -> Column:
    """``normal_path`` as an expression."""
    plain = F.regexp_replace(F.lower(path), f"{ids.SPACE}|[_-]", "")
    for other, name in ALIASES.items():
        plain = F.regexp_replace(plain, rf"(?<![^.]){other}(?![^.])", name)
    return plain


PAIRS = "array<struct<a:string,b:string,score:double>>"


def field_names(heads: DataFrame, exact: bool = True, accept: float = ACCEPT) -> DataFrame:
    """One row per feed: feed, names (map from each spelled path to its field). ``heads`` should be cut.

    Only a feed's distinct paths are brought together, never its files. Without ``exact``, paths of other names that
    some file has side by side, in any spelling, are different fields: the files are asked about the candidates alone.
    """
    each = heads.select("feed", F.explode("fields").alias("f")).groupBy("feed", F.col("f.path").alias("path")).agg(F.collect_set("f.type").alias("types"))
    feeds = each.groupBy("feed").agg(F.collect_list(F.struct("path", "types")).alias("elements"))
    of = lambda es: [(e["path"], list(e["types"])) for e in es]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[{"a": a, "b": b, "score": s} for a, b, s in candidates(of(es), accept, exact)] for es in batch["elements"]]
            yield batch.assign(found=pd.Series(found, index=batch.index, dtype=object))

    elements = "array<struct<path:string,types:array<string>>>"
    compared = cut(feeds.mapInPandas(compare, f"feed string, elements {elements}, found {PAIRS}"))
    none = F.array().cast("array<struct<a:string,b:string>>")
    if exact:
        joined = compared.withColumn("apart", none)
    else:
        heavy = cut(heavy_keys(heads, "feed", heads.count()))
        asked = compared.select("feed", F.filter("found", lambda x: _normal(x["a"]) != _normal(x["b"])).alias("found"))
        here = F.transform("fields", lambda f: _normal(f["path"]))
        seen = lookup_join(heads.select("feed", here.alias("here")), asked, "feed", heavy)
        both = F.filter("found", lambda x: F.array_contains(F.col("here"), _normal(x["a"])) & F.array_contains(F.col("here"), _normal(x["b"])))
        apart = seen.select("feed", F.explode(both).alias("x")).select("feed", "x.a", "x.b").distinct().groupBy("feed").agg(F.collect_list(F.struct("a", "b")).alias("apart"))
        joined = compared.join(apart, "feed", "left").withColumn("apart", F.coalesce("apart", none))

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            named = [
                correspondences(of(es), accept, exact, [(x["a"], x["b"], x["score"]) for x in found], [(x["a"], x["b"]) for x in apart])
                for es, found, apart in zip(batch["elements"], batch["found"], batch["apart"])
            ]
            yield pd.DataFrame({"feed": batch["feed"], "names": named})

    return joined.select("feed", "elements", "found", "apart").mapInPandas(name, "feed string, names map<string,string>")


def resolve_fields(heads: DataFrame, exact: bool = True) -> DataFrame:
    """The heads (cut) with ``names`` of their feed; feeds with a large share of the files are joined by broadcast."""
    heavy = cut(heavy_keys(heads, "feed", heads.count()))
    return lookup_join(heads, cut(field_names(heads, exact)), "feed", heavy)


def drift_events(raw: DataFrame) -> DataFrame:
    """Changes of a feed's fields: file_id, field_path, change_kind (added, renamed, retyped, removed).

    A feed's files are taken in order of (exported_at, file_id); a null time comes first, a null feed is one feed.
    ``added``: first file with the field, unless it is the feed's first file. ``renamed`` / ``retyped``: other
    spelling / type than at the previous appearance. ``removed``: the file after the last appearance, with its last
    spelling. A file that spells a field twice counts with the first spelling in order of letters.

    Rows are laid out in ranges of (feed, field, time); neighbours are found within a range first, then between ranges
    by one summary row per feed, field and range, so that no feed, field or day is ever sorted in one task.
    """
    heads = cut(read_heads(raw))
    moment = F.struct("exported_at", "file_id")
    ranged = lambda d, *by: cut(d.repartitionByRange(*by).withColumn("part", F.spark_partition_id()))
    files = ranged(heads.select("feed", moment.alias("at")), "feed", "at")
    of_feed = Window.partitionBy("feed").orderBy("part")
    parts = files.groupBy("feed", "part").agg(F.min("at").alias("first")).withColumn("next_part", F.lead("first").over(of_feed))
    first_files = files.groupBy("feed").agg(F.min("at").alias("feed_first"))

    named = resolve_fields(heads).select("feed", "exported_at", "file_id", F.explode("fields").alias("f"), "names")
    seen = (
        named.select("feed", moment.alias("at"), F.col("names")[F.col("f.path")].alias("field"), F.struct("f.path", "f.type").alias("s"))
        .groupBy("feed", "field", "at")
        .agg(F.min("s").alias("s"))
        .select("feed", "field", "at", F.col("s.path").alias("path"), F.col("s.type").alias("type"))
    )
    seen = ranged(seen, "feed", "field", "at")
    in_part = Window.partitionBy("part", "feed", "field").orderBy("at")
    inner = seen.select("*", F.lag("path").over(in_part).alias("old_path"), F.lag("type").over(in_part).alias("old_type")).where(F.col("old_path").isNotNull())
    state = F.struct("at", "path", "type")
    over_parts = Window.partitionBy("feed", "field").orderBy("part")
    summary = cut(
        seen.groupBy("feed", "field", "part").agg(F.min(state).alias("a"), F.max(state).alias("z")).withColumn("was", F.lag("z").over(over_parts))
        .withColumn("more", F.lead("a").over(over_parts).isNotNull())
    )
    across = summary.select("feed", F.col("a.at").alias("at"), F.col("a.path").alias("path"), F.col("a.type").alias("type"), F.col("was.path").alias("old_path"), F.col("was.type").alias("old_type"))

    pairs = inner.select("at", "path", "type", "old_path", "old_type").unionByName(across.where(F.col("old_path").isNotNull()).drop("feed"))
    changes = pairs.select(
        F.col("at.file_id").alias("file_id"),
        F.col("path").alias("field_path"),
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("path") != F.col("old_path"), F.lit("renamed")),
                    F.when(F.col("type") != F.col("old_type"), F.lit("retyped")),
                )
            )
        ).alias("change_kind"),
    )
    fresh = across.where(F.col("old_path").isNull()).join(first_files, "feed").where(F.col("at") != F.col("feed_first"))
    added = fresh.select(F.col("at.file_id").alias("file_id"), F.col("path").alias("field_path"), F.lit("added").alias("change_kind"))

    within = Window.partitionBy("feed", "part").orderBy("at")
    followers = files.withColumn("next", F.lead("at").over(within))
    ends = summary.where(~F.col("more")).select("feed", F.col("z.at").alias("at"), F.col("z.path").alias("path"))
    ends = ends.join(followers, ["feed", "at"]).join(parts.select("feed", "part", "next_part"), ["feed", "part"])
    gone = ends.withColumn("then", F.coalesce("next", "next_part")).where(F.col("then").isNotNull())
    removed = gone.select(F.col("then.file_id").alias("file_id"), F.col("path").alias("field_path"), F.lit("removed").alias("change_kind"))
    return added.unionByName(changes).unionByName(removed)


def _as_list(value: Column) -> Column:
    """Texts of a JSON value: of a string, number or boolean itself, of an object its main or name, of an array each."""
    one = lambda v: F.coalesce(F.get_json_object(v, "$.main"), F.get_json_object(v, "$.name"), F.get_json_object(v, "$.Main"), F.get_json_object(v, "$.Name"), v)
    many = F.transform(F.from_json(value, "array<string>"), lambda x: F.when(x.startswith("{"), one(x)).otherwise(x))
    plain = F.when(value.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")).otherwise(value)
    return F.when(value.startswith("["), many).when(value.startswith("{"), F.array(one(value))).otherwise(F.when(value.isNotNull(), F.array(plain)))


def consistent_heads(raw: DataFrame) -> DataFrame:
    """The heads of all files as one table: file_id, feed, exported_at, a column per known field, other.

    Spellings are brought together by the settled scores of the flooding, also where names do not agree.

    Text fields are cast to string (lists are joined by ``; ``, objects give their main text or name), list fields to
    array<string>; fields without a column stay in ``other`` as JSON by their name.
    """
    resolved = resolve_fields(cut(read_heads(raw)), exact=False)
    tops = F.filter("fields", lambda f: f["value"].isNotNull())
    entries = F.transform(tops, lambda f: F.struct(F.col("names")[f["path"]].alias("k"), f["value"].alias("v")))
    first = F.aggregate(entries, F.array().cast("array<struct<k:string,v:string>>"), lambda out, e: F.when(F.exists(out, lambda o: o["k"] == e["k"]), out).otherwise(F.concat(out, F.array(e))))
    rows = resolved.select("file_id", "feed", "exported_at", F.map_from_entries(first).alias("m"))
    known = [*TEXT_COLUMNS, *LIST_COLUMNS]
    return rows.select(
        "file_id",
        "feed",
        "exported_at",
        *(F.array_join(_as_list(F.col("m")[c]), "; ").alias(c) for c in TEXT_COLUMNS),
        *(_as_list(F.col("m")[c]).alias(c) for c in LIST_COLUMNS),
        F.map_filter("m", lambda k, v: ~k.isin(*known)).alias("other"),
    )
