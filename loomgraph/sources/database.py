"""A property graph in a graph database that takes openCypher statements.

``connect`` runs in each task and gives a function ``run(statement, parameters)`` that returns rows as dicts; any
driver can be put behind it. Rows go in batches of one label or relation, as those cannot be parameters.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators.graph import EDGE_SCHEMA, NODE_SCHEMA, GraphStore

Run = Callable[[str, dict], list[dict]]
CONSTRAINT = "CREATE CONSTRAINT loomgraph_node_id IF NOT EXISTS FOR (n:Entity) REQUIRE n.node_id IS UNIQUE"
_NAME = re.compile(r"[A-Za-z][A-Za-z0-9_]*")


def identifier(name: str | None) -> str:
    """The label or relation, if it is one that may stand in a statement; else an error."""
    if name is None or not _NAME.fullmatch(name):
        raise ValueError(f"no identifier: {name!r}")
    return name


def _values(properties: dict | None) -> dict:
    """Properties of a row as values; nulls go too, as they remove a property."""
    return {k: None if v is None else json.loads(v) for k, v in (properties or {}).items()}


def _node_statement(label: str) -> str:
    return f"UNWIND $rows AS r MERGE (n:Entity {{node_id: r.node_id}}) SET n:{identifier(label)}, n += r.properties, n.name = r.name, n.label = r.label"


def _edge_statement(relation: str) -> str:
    ends = "MATCH (s:Entity {node_id: r.source_id}) MATCH (t:Entity {node_id: r.target_id})"
    return f"UNWIND $rows AS r {ends} MERGE (s)-[e:{identifier(relation)} {{edge_id: r.edge_id}}]->(t) SET e += r.properties, e.relation = r.relation"


def write_database(store: GraphStore, connect: Callable[[], Run], batch: int = 1000) -> None:
    """Lay a graph over the one in the database: the constraint, then nodes, then edges between nodes that exist.

    Labels and relations that are no identifiers are an error before anything is written.
    """
    for table, column in ((store.nodes, "label"), (store.edges, "relation")):
        bad = table.where(~F.coalesce(F.col(column).rlike(f"\\A{_NAME.pattern}\\z"), F.lit(False))).select(column).first()
        if bad is not None:
            identifier(bad[0])
    connect()(CONSTRAINT, {})

    def push(column: str, statement: Callable[[str], str]) -> Callable[[Iterator], None]:
        def send(rows: Iterator) -> None:
            run = connect()
            for name, group in groupby(rows, key=lambda r: r[column]):
                pack: list[dict] = []
                for r in group:
                    pack.append(r.asDict() | {"properties": _values(r["properties"])})
                    if len(pack) == batch:
                        run(statement(name), {"rows": pack})
                        pack = []
                if pack:
                    run(statement(name), {"rows": pack})

        return send

    store.nodes.sortWithinPartitions("label", "node_id").foreachPartition(push("label", _node_statement))
    store.edges.sortWithinPartitions("relation", "source_id").foreachPartition(push("relation", _edge_statement))


def read_database(spark: SparkSession, connect: Callable[[], Run]) -> GraphStore:
    """The graph in the database, read by one task per label and per relation. Values become JSON text."""
    run = connect()
    labels = [r["name"] for r in run("MATCH (n:Entity) RETURN DISTINCT n.label AS name ORDER BY name", {})]
    relations = [r["name"] for r in run("MATCH (:Entity)-[e]->(:Entity) RETURN DISTINCT type(e) AS name ORDER BY name", {})]
    text = lambda d, own: {k: json.dumps(v, ensure_ascii=False) for k, v in d.items() if k not in own and v is not None}

    def node_rows(name: str) -> Iterator[tuple]:
        for r in connect()(f"MATCH (n:Entity:{identifier(name)}) RETURN properties(n) AS p", {}):
            p = r["p"]
            yield p["node_id"], p.get("label") or "Entity", p.get("name") or p["node_id"], text(p, ("node_id", "label", "name"))

    def edge_rows(name: str) -> Iterator[tuple]:
        asked = f"MATCH (s:Entity)-[e:{identifier(name)}]->(t:Entity) RETURN properties(e) AS p, s.node_id AS s, t.node_id AS t"
        for r in connect()(asked, {}):
            p = r["p"]
            yield p["edge_id"], r["s"], r["t"], p.get("relation") or name, text(p, ("edge_id", "relation"))

    def scan(names: list[str], rows: Callable[[str], Iterator[tuple]], schema: str, key: str) -> DataFrame:
        columns = [c.strip().split()[0] for c in schema.replace("map<string,string>", "map").split(",")]

        def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for name in b["name"]:
                    pack = []
                    for row in rows(name):
                        pack.append(row)
                        if len(pack) == 10_000:
                            yield pd.DataFrame(pack, columns=columns)
                            pack = []
                    if pack:
                        yield pd.DataFrame(pack, columns=columns)

        wanted = spark.createDataFrame([(n,) for n in names], "name string").repartition(max(1, len(names)), "name")
        return wanted.mapInPandas(read, schema).dropDuplicates([key])

    return GraphStore(scan(labels, node_rows, NODE_SCHEMA, "node_id"), scan(relations, edge_rows, EDGE_SCHEMA, "edge_id"))
