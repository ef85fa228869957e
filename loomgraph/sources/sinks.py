"""Writing tables, graphs and reports."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators.graph import EDGE_SCHEMA, NODE_SCHEMA, GraphStore


def write_normalized(table: DataFrame, folder: str) -> None:
    """One partition per guideline; only guidelines that are written are replaced."""
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("guideline_id").parquet(folder)


def write_graph(store: GraphStore, folder: str) -> None:
    """Nodes partitioned by label, edges by relation and sorted by source."""
    store.nodes.write.mode("overwrite").partitionBy("label").parquet(f"{folder}/nodes")
    store.edges.sortWithinPartitions("relation", "source_id").write.mode("overwrite").partitionBy("relation").parquet(f"{folder}/edges")


def read_graph(spark: SparkSession, folder: str) -> GraphStore:
    """The written graph; an empty one where nothing was written."""
    try:
        nodes, edges = spark.read.parquet(f"{folder}/nodes"), spark.read.parquet(f"{folder}/edges")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return GraphStore(spark.createDataFrame([], NODE_SCHEMA), spark.createDataFrame([], EDGE_SCHEMA))
    return GraphStore(nodes.select("node_id", "label", "name", "properties"), edges.select("edge_id", "source_id", "target_id", "relation", "properties"))


def read_node_link(spark: SparkSession, path: str) -> GraphStore:
    """A graph in node-link JSON: nodes with id, label, name and properties; links with source, target and key."""
    body = spark.read.text(path, wholetext=True)
    nodes = body.select(F.explode(F.from_json(F.get_json_object("value", "$.nodes"), "array<map<string,string>>")).alias("n"))
    links = F.coalesce(F.get_json_object("value", "$.links"), F.get_json_object("value", "$.edges"))
    edges = body.select(F.explode(F.from_json(links, "array<map<string,string>>")).alias("e"))
    rest = lambda c, *own: F.map_filter(c, lambda k, v: ~k.isin(*own))
    return GraphStore(
        nodes.select(F.col("n")["id"].alias("node_id"), F.col("n")["label"].alias("label"), F.col("n")["name"].alias("name"), rest("n", "id", "label", "name").alias("properties")),
        edges.select(
            F.col("e")["key"].alias("edge_id"), F.col("e")["source"].alias("source_id"), F.col("e")["target"].alias("target_id"), F.col("e")["relation"].alias("relation"), rest("e", "key", "source", "target", "relation").alias("properties")
        ),
    )


def write_subgraph(store: GraphStore, path: str) -> None:
    """A gene's subgraph as one JSON text with nodes and edges. For subgraphs, which are small; not for whole graphs."""
    each = store.nodes.select(F.lit(True).alias("node"), F.to_json(F.struct("*")).alias("j")).unionByName(
        store.edges.select(F.lit(False).alias("node"), F.to_json(F.struct("*")).alias("j"))
    )
    part = lambda test: F.array_join(F.array_sort(F.collect_list(F.when(test, F.col("j")))), ",")
    whole = F.concat(F.lit('{"nodes":['), part(F.col("node")), F.lit('],"edges":['), part(~F.col("node")), F.lit("]}"))
    each.agg(whole.alias("value")).write.mode("overwrite").text(path)


def write_to_database(store: GraphStore, connect: Callable[[], Callable[[str, list[dict]], None]], batch: int = 1000) -> None:
    """Hand nodes, then edges, to a database in batches. ``connect`` runs in each partition and gives a function that
    takes ``nodes`` or ``edges`` and a list of rows, and must upsert them."""

    def push(kind: str) -> Callable[[Iterator], None]:
        def run(rows: Iterator) -> None:
            send, pack = connect(), []
            for r in rows:
                pack.append(r.asDict(recursive=True))
                if len(pack) == batch:
                    send(kind, pack)
                    pack = []
            if pack:
                send(kind, pack)

        return run

    store.nodes.foreachPartition(push("nodes"))
    store.edges.foreachPartition(push("edges"))


def render(rows: list[dict], pretty: bool = True) -> str:
    """Rows of a report as JSON text with sorted keys."""
    return json.dumps(rows, ensure_ascii=False, sort_keys=True, indent=2 if pretty else None, default=str)
