"""The property graph as two tables, with merging, lookups, adjacency and neighbourhoods.

nodes: node_id, label, name, properties; edges: edge_id, source_id, target_id, relation, properties. Property values
are JSON text in a map, so that a key with a null value differs from a missing key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.session import cut

NODE = ["node_id", "label", "name", "properties"]
EDGE = ["edge_id", "source_id", "target_id", "relation", "properties"]
NODE_SCHEMA = "node_id string, label string, name string, properties map<string,string>"
#: What a database takes for a label or relation.
IDENTIFIER = r"\A[A-Za-z][A-Za-z0-9_]*\z"
EDGE_SCHEMA = "edge_id string, source_id string, target_id string, relation string, properties map<string,string>"


def merge_properties(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key with the properties of all its rows laid over one another in order; later values win, nulls too.

    Each property is brought down to its latest value by a combining aggregation before a key's properties are put
    together, so a key with a large share of the rows costs as many entries as it has property names.
    """
    each = rows.select(*keys, F.col(order).alias("o"), F.explode_outer("properties").alias("k", "v"))
    latest = each.groupBy(*keys, "k").agg(F.max_by(F.struct("v"), "o").alias("x"))
    entries = F.array_sort(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", F.col("x.v").alias("v")))))
    return latest.groupBy(*keys).agg(F.map_from_entries(entries).alias("properties"))


def merge_nodes(rows: DataFrame, order: str) -> DataFrame:
    """Upsert by node_id: label, name and each property of the latest row that has it.

    ``order`` names an orderable column without ties within a node. Properties named ``label`` or ``name`` are left
    out. Rows without node_id are left out.
    """
    rows = rows.where(F.col("node_id").isNotNull())
    last = rows.groupBy("node_id").agg(F.max_by(F.struct("label", "name"), order).alias("v"))
    props = merge_properties(rows, ["node_id"], order)
    named = F.map_filter("properties", lambda k, v: ~k.isin("label", "name"))
    return last.join(props, "node_id").select("node_id", "v.label", "v.name", named.alias("properties"))


def merge_edges(rows: DataFrame, order: str) -> DataFrame:
    """Upsert by (source_id, target_id, edge_id): the latest relation, properties laid over one another."""
    keys = ["source_id", "target_id", "edge_id"]
    rows = rows.where(F.col("source_id").isNotNull() & F.col("target_id").isNotNull() & F.col("edge_id").isNotNull())
    last = rows.groupBy(*keys).agg(F.max_by("relation", order).alias("relation"))
    return last.join(merge_properties(rows, keys, order), keys).select(*EDGE)


def first_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The earliest whole row of each key."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("v")).select(*keys, *(F.col(f"v.{c}") for c in rest))


def current_nodes(versions: DataFrame) -> DataFrame:
    """Live nodes of a log of versions: the newest by (updated_at, row_id), unless it deletes the node."""
    order = F.struct("updated_at", "row_id")
    last = versions.where(F.col("node_id").isNotNull()).groupBy("node_id").agg(F.max_by(F.struct("label", "name", "properties", "deleted"), order).alias("v"))
    return last.where(~F.coalesce("v.deleted", F.lit(False))).select("node_id", "v.label", "v.name", "v.properties")


def current_edges(deliveries: DataFrame) -> DataFrame:
    """Each edge once: its latest delivery by (loaded_at, row_id)."""
    order = F.struct("loaded_at", "row_id")
    last = deliveries.where(F.col("edge_id").isNotNull()).groupBy("edge_id").agg(F.max_by(F.struct(*EDGE[1:]), order).alias("v"))
    return last.select("edge_id", *(F.col(f"v.{c}") for c in EDGE[1:]))


@dataclass(frozen=True)
class GraphStore:
    """A graph to read from. Every method gives a plan; nothing is written on read."""

    nodes: DataFrame
    edges: DataFrame

    def upsert(self, nodes: DataFrame, edges: DataFrame, require_endpoints: bool = False) -> GraphStore:
        """The graph with more rows laid over it.

        Endpoints that no node row names become nodes without label, as in a file-backed store; with
        ``require_endpoints`` such edges are dropped and null properties remove their key, as in a database, and
        labels and relations must be plain identifiers (letters, digits and ``_``): others are an error.
        """
        age = lambda d, n: d.withColumn("age", F.lit(n))
        all_nodes = merge_nodes(age(self.nodes.select(*NODE), 0).unionByName(age(nodes.select(*NODE), 1)), "age")
        all_edges = merge_edges(age(self.edges.select(*EDGE), 0).unionByName(age(edges.select(*EDGE), 1)), "age")
        if require_endpoints:
            checked = lambda d, c: d.withColumn(c, F.when(F.col(c).rlike(IDENTIFIER), F.col(c)).otherwise(F.raise_error(F.concat(F.lit("no identifier: "), F.coalesce(c, F.lit("null"))))))
            all_nodes, all_edges = checked(all_nodes, "label"), checked(all_edges, "relation")
            live = all_nodes.select("node_id")
            all_edges = all_edges.join(live.withColumnRenamed("node_id", "source_id"), "source_id", "left_semi")
            all_edges = all_edges.join(live.withColumnRenamed("node_id", "target_id"), "target_id", "left_semi")
            drop = lambda d: d.withColumn("properties", F.map_filter("properties", lambda k, v: v.isNotNull()))
            return GraphStore(drop(all_nodes), drop(all_edges).select(*EDGE))
        ends = all_edges.select(F.explode(F.array("source_id", "target_id")).alias("node_id")).distinct()
        bare = ends.join(all_nodes, "node_id", "left_anti").select("node_id", F.lit("").alias("label"), F.col("node_id").alias("name"), F.create_map().cast("map<string,string>").alias("properties"))
        return GraphStore(all_nodes.unionByName(bare), all_edges)

    def list_nodes(self, label: str | None = None) -> DataFrame:
        return self.nodes if label is None else self.nodes.where(F.col("label") == label)

    def get_node(self, node_id: str) -> DataFrame:
        return self.nodes.where(F.col("node_id") == node_id)

    def get_edges(self, node_id: str, relation: str | None = None, direction: str = "both") -> DataFrame:
        """Edges at a node, each once. ``direction``: in, out or both; anything else is an error."""
        if direction not in ("in", "out", "both"):
            raise ValueError(f"unknown direction {direction!r}")
        out, into = F.col("source_id") == node_id, F.col("target_id") == node_id
        at = {"out": out, "in": into, "both": out | into}[direction]
        found = self.edges.where(at if relation is None else at & (F.col("relation") == relation))
        return found.dropDuplicates(["edge_id"])

    def distances(self, node_id: str, depth: int) -> DataFrame:
        """(node_id, hops) of the nodes within ``depth`` undirected hops of a node that exists. Edges should be cut."""
        links = self.edges.select(F.col("source_id").alias("a"), F.col("target_id").alias("b"))
        links = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        reached = last = cut(self.get_node(node_id).select("node_id").distinct().withColumn("hops", F.lit(0)))
        for hop in range(1, depth + 1):
            step = links.join(last.select(F.col("node_id").alias("a")), "a", "left_semi").select(F.col("b").alias("node_id")).distinct()
            last = cut(step.join(reached, "node_id", "left_anti").withColumn("hops", F.lit(hop)))
            reached = reached.unionByName(last)
        return reached

    def _settled(self) -> GraphStore:
        """The same graph with its edges cut, as walks read them once per hop."""
        return GraphStore(self.nodes, cut(self.edges))

    def k_hop(self, node_id: str, depth: int = 2) -> GraphStore:
        """The nodes within ``depth`` hops, the node itself too, with all edges among them. Unknown node: empty."""
        own = self._settled()
        near = own.distances(node_id, depth).select("node_id")
        inner = own.edges.join(near.withColumnRenamed("node_id", "source_id"), "source_id", "left_semi")
        inner = inner.join(near.withColumnRenamed("node_id", "target_id"), "target_id", "left_semi")
        return GraphStore(self.nodes.join(near, "node_id", "left_semi"), inner.select(*EDGE))

    def k_hop_paths(self, node_id: str, depth: int = 2) -> GraphStore:
        """Nodes and edges on paths of up to ``depth`` (1 to 5) edges from the node. A node without edges: empty."""
        depth = min(max(depth, 1), 5)
        own = self._settled()
        inner = own.distances(node_id, depth - 1).select("node_id")
        out = own.edges.join(inner.withColumnRenamed("node_id", "source_id"), "source_id", "left_semi").select(*EDGE)
        into = own.edges.join(inner.withColumnRenamed("node_id", "target_id"), "target_id", "left_semi").select(*EDGE)
        on_path = out.unionByName(into).dropDuplicates(["edge_id"])
        ends = on_path.select(F.explode(F.array("source_id", "target_id")).alias("node_id")).distinct()
        return GraphStore(self.nodes.join(ends, "node_id", "left_semi"), on_path)
