"""Turning nested JSON records into related flat tables (problem 5).

Each body is read as a stream of events; every scalar becomes a (path, value, ordinal) triple. Triples are grouped by
the nearest repeated ancestor, the object that a record-like array element or its single stand-in is, and leave
Python as one row per such object with its own fields. Pivoting a group is then a projection of that map. Which
arrays repeat objects is found in the bodies; only items, sections and genes have a meaning of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from decimal import Decimal
from json import JSONDecodeError
from json.decoder import scanstring

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.session import cut

_SPACE = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?")
#: Literals that a JSON reader in Python takes, with what they are.
_LITERALS = {"true": True, "false": False, "null": None, "NaN": float("nan"), "Infinity": float("inf"), "-Infinity": float("-inf")}


def events(body: str) -> Iterator[tuple[str, object]]:
    """JSON events in order: ('{', None), ('key', name), ('}', None), ('[', None), (']', None), ('value', scalar).

    Raises JSONDecodeError where the text is no JSON, at the latest at its end. Depth is not limited.
    """
    skip = _SPACE.match
    at, n, stack = skip(body).end(), len(body), []
    want = "value"  # value, first key, key, first element, end of value
    while True:
        if want in ("first key", "key"):
            c = body[at : at + 1]
            if c == '"':
                name, at = scanstring(body, at + 1, True)
                at = skip(body, at).end()
                if body[at : at + 1] != ":":
                    raise JSONDecodeError("expecting ':'", body, at)
                yield "key", name
                at, want = skip(body, at + 1).end(), "value"
            elif c == "}" and want == "first key":
                at, want = at + 1, "end"
                stack.pop()
                yield "}", None
            else:
                raise JSONDecodeError("expecting a key", body, at)
            continue
        if want in ("value", "first element"):
            c = body[at : at + 1]
            if c == "]" and want == "first element":
                stack.pop()
                yield "]", None
                at, want = at + 1, "end"
            elif c == "{":
                stack.append("}")
                yield "{", None
                at, want = skip(body, at + 1).end(), "first key"
                continue
            elif c == "[":
                stack.append("]")
                yield "[", None
                at, want = skip(body, at + 1).end(), "first element"
                continue
            elif c == '"':
                text, at = scanstring(body, at + 1, True)
                yield "value", text
                want = "end"
            else:
                if (m := _NUMBER.match(body, at)) and m.end() > at:
                    value = float(m.group()) if m.group(1) or m.group(2) else int(m.group()) if len(m.group()) < 4000 else Decimal(m.group())
                    at = m.end()
                else:
                    name = next((w for w in _LITERALS if body.startswith(w, at)), None)
                    if name is None:
                        raise JSONDecodeError("expecting a value", body, at)
                    value, at = _LITERALS[name], at + len(name)
                yield "value", value
                want = "end"
        at = skip(body, at).end()
        if not stack:
            if at != n:
                raise JSONDecodeError("extra data", body, at)
            return
        c = body[at : at + 1]
        if c == ",":
            at = skip(body, at + 1).end()
            want = "key" if stack[-1] == "}" else "value"
        elif c == stack[-1]:
            stack.pop()
            yield c, None
            at, want = at + 1, "end"
        else:
            raise JSONDecodeError("expecting ',' or an end", body, at)


def triples(body: str) -> Iterator[tuple[tuple, object, int]]:
    """(path, value, ordinal) in order of the text. A path holds keys (str) and array positions (int).

    Objects and arrays give a triple of their own before their content, with ``dict`` or ``list`` as value.
    """
    path: list = []
    inside: list[str] = []
    ordinal = 0
    for kind, value in events(body):
        if kind == "key":
            path.append(value)
            continue
        if kind in "}]":
            if kind == "]":
                path.pop()
            inside.pop()
        else:
            yield tuple(path), {"{": dict, "[": list}.get(kind, value), ordinal
            ordinal += 1
            if kind != "value":
                inside.append(kind)
                if kind == "[":
                    path.append(0)
                continue
        if inside:  # a value has ended
            if inside[-1] == "[":
                path[-1] += 1
            else:
                path.pop()


#: Fixed names of the input: where repeated objects stand.
ITEM_KEY = "content"
SECTION_KEYS = ("Sections", "sections")
GENE_KEY = "genes"


def pointer(path: tuple) -> str:
    return "".join(f"/{p}" for p in path)


def _kind(path: tuple, item: tuple | None) -> str | None:
    """What a repeated object at this path is; ``item`` is the item that it lies in, if any."""
    at = path[:-1] if path and isinstance(path[-1], int) else path
    if not at or not isinstance(at[-1], str):
        return None
    if at == (ITEM_KEY,):
        return "item"
    if at == (GENE_KEY,):
        return "gene"
    if item is None:
        return None
    if at[-1] == GENE_KEY:
        return "gene"
    if at[-1] in SECTION_KEYS and GENE_KEY not in path[len(item) :]:
        return "section"
    return None


def _text(value: object) -> str | None:
    if value is None:
        return None
    return {True: "true", False: "false"}[value] if isinstance(value, bool) else str(value)


#: Kinds whose objects are told apart by the fixed names; any other object in an array has its array's key as kind.
NAMED_KINDS = ("document", "item", "section", "gene")


def flatten_body(body: str | None) -> list[tuple[str, str, str | None, int, dict[str, str | None]]]:
    """Repeated objects of one body and its root: kind, json_pointer, parent_pointer, ordinal, fields.

    Repeated is each element of an array that is an object, and the single object in place of such an array of items,
    sections or genes. Fields are the scalars that have this object as nearest repeated ancestor, by their path below
    it, so every scalar of the body is in exactly one row. The root is of kind ``document`` with pointer '' and a
    null parent. The parent of a section or gene is the nearest section, else the item; that of other objects the
    nearest repeated object, else the root. An object under genes without a name is of kind ``genes``.

    Bodies that are null, no JSON, or no JSON object give nothing. Of a key that is repeated in an object, the last
    one counts.
    """
    if body is None:
        return []
    open_: list[tuple[tuple, str, str | None, int, dict]] = []
    done: dict[tuple, tuple] = {}
    item: tuple | None = None
    seen: set[tuple] = set()
    named: dict[tuple, bool] = {}  # whether an object's Gene is a non-blank string
    try:
        for path, value, ordinal in triples(body):
            if not path:
                if value is not dict:
                    return []
                done[path] = (path, "document", None, ordinal, {})
                open_.append(done[path])
                continue
            while path[: len(open_[-1][0])] != open_[-1][0]:
                open_.pop()
            if item is not None and path[: len(item)] != item:
                item = None
            if path in seen:  # the key again: what its first value brought does not count
                for p in [p for p in done if p[: len(path)] == path]:
                    del done[p]
                while open_[-1][0][: len(path)] == path:
                    open_.pop()
                if item is not None and item[: len(path)] == path:
                    item = None
                below = pointer(path[len(open_[-1][0]) :])
                for k in [k for k in open_[-1][4] if k == below or k.startswith(below + "/")]:
                    del open_[-1][4][k]
                if below == "/Gene":
                    named.pop(open_[-1][0], None)
                seen = {p for p in seen if p[: len(path)] != path}
            seen.add(path)
            if value is dict:
                kind = _kind(path, item)
                if kind is None and isinstance(path[-1], int):
                    kind = "/" + next(p for p in reversed(path) if isinstance(p, str))
                if kind:
                    up = next((o for o in reversed(open_) if o[1] in ("item", "section")), open_[0]) if kind in NAMED_KINDS else open_[-1]
                    row = (path, kind, "" if kind == "item" else pointer(up[0]), ordinal, {})
                    open_.append(row)
                    done[path] = row
                    named.pop(path, None)
                    if kind == "item":
                        item = path
            elif value is not list:
                owner = open_[-1][0]
                open_[-1][4][pointer(path[len(owner) :])] = _text(value)
                if path == (*owner, "Gene"):
                    named[owner] = isinstance(value, str) and bool(value.strip())
    except (JSONDecodeError, RecursionError):
        return []
    return [
        ("/genes" if kind == "gene" and not named.get(path) else kind, pointer(path), parent, ordinal, fields)
        for path, kind, parent, ordinal, fields in done.values()
    ]


FLAT = "file_id bigint, kind string, json_pointer string, parent_pointer string, ordinal int, fields map<string,string>"


def flatten_bodies(raw: DataFrame, kinds: Iterable[str] | None = None, fields: bool = True) -> DataFrame:
    """Repeated objects of all bodies, see ``flatten_body``: file_id, kind, json_pointer, parent_pointer, ordinal, fields.

    ``kinds`` names the kinds that are wanted, by default all; without ``fields`` the rows come without them. A kind
    that is an array's key has a ``/`` before it. One pass over the rows without a shuffle; a body's rows are formed
    while it is read.
    """
    wanted = None if kinds is None else frozenset(kinds)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["file_id", "kind", "json_pointer", "parent_pointer", "ordinal", "fields"]
        for batch in batches:
            rows = [
                (i, kind, at, parent, ordinal, found if fields else None)
                for i, b in zip(batch["file_id"], batch["body"])
                for kind, at, parent, ordinal, found in flatten_body(b)
                if wanted is None or kind in wanted
            ]
            if rows:
                yield pd.DataFrame(rows, columns=names)

    return raw.select("file_id", "body").mapInPandas(run, FLAT)


def _pick(*names: str) -> Column:
    return F.coalesce(*(F.col("fields")[f"/{n}"] for n in names))


KEYS = ("file_id", "json_pointer", "parent_pointer", "ordinal")
#: Columns of the tables of named kinds, with the fields that they are taken from, the first that is there.
COLUMNS = {
    "document": {"title": ("title", "Title", "guideline_title")},
    "item": {"title": ("title", "Title", "content/title", "content/Title", "content/guideline_title")},
    "section": {"section": ("Section", "section"), "page": ("Page", "page"), "summary": ("summary",)},
    "gene": {"gene": ("Gene",), "occurrences": ("Occurrences",), "context": ("context",)},
}


def kind_table(flat: DataFrame, kind: str) -> DataFrame:
    """The table of one named kind: KEYS, its columns, and all other fields of a row in ``other`` by their path below it."""
    columns = COLUMNS[kind]
    known = [f"/{n}" for names in columns.values() for n in names]
    taken = {c: [f"/{n}" for n in names] for c, names in columns.items()}
    first = F.array(*(F.coalesce(*(F.when(F.col("fields")[n].isNotNull(), F.lit(n)) for n in names)) for names in taken.values()))
    other = F.map_filter("fields", lambda k, v: ~k.isin(*known) | ~F.array_contains(F.array_compact(first), k))
    return flat.where(F.col("kind") == kind).select(*KEYS, *(_pick(*names).alias(c) for c, names in columns.items()), other.alias("other"))


def pivot_kind(flat: DataFrame, kind: str, most: int = 100) -> DataFrame:
    """The table of any kind with a column per field that is found: KEYS, the ``most`` most frequent fields by their
    path below the object (``.`` for ``/``; without positions in arrays), and the rest in ``other``, so none is lost."""
    rows = flat.where(F.col("kind") == kind)
    each = rows.select(F.explode(F.map_keys("fields")).alias("k")).where(~F.col("k").rlike("/[0-9]+(/|$)") & (F.col("k") != "/other"))
    found = [r.k for r in each.groupBy("k").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "k").limit(most).collect()]
    names: dict[str, str] = {}  # names that differ in case only stay in other, as do those of the keys
    for k in found:
        plain = k[1:].replace("/", ".")
        if plain.lower() not in {n.lower() for n in (*KEYS, "kind", *names.values())}:
            names[k] = plain
    other = F.map_filter("fields", lambda k, v: ~k.isin(*names)) if names else F.col("fields")
    return rows.select(*KEYS, *(F.col("fields")[k].alias(n) for k, n in names.items()), other.alias("other"))


def nested_tables(raw: DataFrame) -> dict[str, DataFrame]:
    """The flat tables ``documents``, ``items``, ``sections``, ``genes``, linked by file_id and parent_pointer, and
    ``repeated``: the objects of all other arrays with their kind and fields (``pivot_kind`` gives one kind's columns).

    Bodies are read once for all tables.
    """
    flat = cut(flatten_bodies(raw))
    tables = {f"{kind}s": kind_table(flat, kind) for kind in NAMED_KINDS}
    return tables | {"repeated": flat.where(~F.col("kind").isin(*NAMED_KINDS)).select("kind", *KEYS, "fields")}
