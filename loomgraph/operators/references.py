"""References to records that do not exist: endpoints of edges without a live node (problem 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.skew import HEAVY_PARTS, heavy_keys, lookup_join
from loomgraph.session import cut


def endpoints(edges: DataFrame) -> DataFrame:
    """One row per endpoint that is neither null nor empty: row_id, side, ref, relation, created_at."""
    sides = F.array(
        F.struct(F.lit("source").alias("side"), F.col("source_id").alias("ref")),
        F.struct(F.lit("target").alias("side"), F.col("target_id").alias("ref")),
    )
    return (
        edges.select("row_id", "relation", "created_at", F.explode(sides).alias("e"))
        .select("row_id", "relation", "created_at", "e.side", "e.ref")
        .where(F.col("ref").isNotNull() & (F.col("ref") != ""))
    )


def node_states(nodes: DataFrame) -> DataFrame:
    """One row per node_id: when it was first written and whether its newest version deletes it.

    Of versions with the same updated_at the one with the larger row_id is the newest; a null updated_at is older
    than any other; a null ``deleted`` counts as false.
    """
    version = F.struct(F.col("updated_at"), F.col("row_id"))
    return (
        nodes.where(F.col("node_id").isNotNull())
        .groupBy(F.col("node_id").alias("ref"))
        .agg(
            F.min("updated_at").alias("first_seen"),
            F.coalesce(F.max_by(F.coalesce(F.col("deleted"), F.lit(False)), version), F.lit(False)).alias("gone"),
            F.lit(True).alias("known"),
        )
    )


def orphan_references(edges: DataFrame, nodes: DataFrame, parts: int = HEAVY_PARTS) -> DataFrame:
    """Endpoints without a live node: row_id, side, relation, period (month of created_at), status.

    status is ``missing`` (no row in nodes), ``deleted`` (the newest version deletes it) or ``late`` (first written
    after the edge's created_at). Ids are compared exactly. A null created_at is never late and has a null period.
    Empty tables give an empty result. Other columns of the inputs are ignored.

    Plan: references are counted per key and month with map-side combine; keys that are heavy in some month (at most
    ``parts``, whatever the data) are joined by broadcast, all others by a shuffle join, and both results are united.
    """
    refs = endpoints(edges)
    month = F.trunc("created_at", "month")
    heavy = cut(heavy_keys(refs, "ref", 2 * edges.count(), parts, period=month))
    joined = lookup_join(refs, node_states(nodes), "ref", heavy)
    status = (
        F.when(F.col("known").isNull(), F.lit("missing"))
        .when(F.col("gone"), F.lit("deleted"))
        .when(F.col("first_seen") > F.col("created_at"), F.lit("late"))
    )
    return (
        joined.select("row_id", "side", "relation", month.alias("period"), status.alias("status"))
        .where(F.col("status").isNotNull())
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Number of orphan references per relation, month, side and status."""
    return orphans.groupBy("relation", F.date_format("period", "yyyy-MM").alias("period"), "side", "status").agg(
        F.count(F.lit(1)).alias("n_refs")
    )


def count_orphans(edges: DataFrame, nodes: DataFrame, parts: int = HEAVY_PARTS) -> DataFrame:
    """Number of orphan references, as ``orphan_report`` gives it: relation, period, side, status, n_refs.

    References are counted per key, relation, side and month before any join, with their earliest and latest time, and
    only counts meet the nodes. The counts decide everything but the lateness of references to a node that was first
    written between the two times: of those keys the rows are looked at, and both orphan counts are united.
    """
    refs = endpoints(edges).withColumn("period", F.trunc("created_at", "month"))
    by = ["relation", "period", "side"]
    packed = cut(
        refs.groupBy("ref", *by).agg(
            F.count(F.lit(1)).alias("n"), F.count("created_at").alias("timed"), F.min("created_at").alias("first"), F.max("created_at").alias("last")
        )
    )
    heavy = cut(heavy_keys(packed, "ref", packed.count(), parts))
    joined = cut(lookup_join(packed, node_states(nodes), "ref", heavy))
    status = (
        F.when(F.col("known").isNull(), F.lit("missing"))
        .when(F.col("gone"), F.lit("deleted"))
        .when(F.col("first_seen") > F.col("last"), F.lit("late"))
    )
    counted = joined.select(*by, status.alias("status"), "n", "timed").where(F.col("status").isNotNull())
    counted = counted.select(*by, "status", F.when(F.col("status") == "late", F.col("timed")).otherwise(F.col("n")).alias("n"))

    between = F.col("known") & ~F.col("gone") & (F.col("first_seen") > F.col("first")) & (F.col("first_seen") <= F.col("last"))
    open_ = cut(joined.where(between).select("ref", *by, "first_seen"))
    late = None
    totals = packed.groupBy("ref").agg(F.sum("n").alias("n"))
    hot = cut(totals.where(F.col("n") >= max(2, -(-2 * edges.count() // parts))).select("ref"))
    mark = F.broadcast(hot)
    for how in ("left_semi", "left_anti"):  # hot keys: at most ``parts``, each with its months
        wanted = open_.join(mark, "ref", how)
        wanted = F.broadcast(wanted) if how == "left_semi" else wanted
        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"w.{c}")) for c in ("ref", *by)]
        rows = refs.join(mark, "ref", how).alias("r").join(wanted.alias("w"), same)
        found = rows.where(F.col("w.first_seen") > F.col("r.created_at")).select(*(F.col(f"r.{c}") for c in by), F.lit("late").alias("status"), F.lit(1).cast("bigint").alias("n"))
        late = found if late is None else late.unionByName(found)
    return (
        counted.unionByName(late)
        .groupBy("relation", F.date_format("period", "yyyy-MM").alias("period"), "side", "status")
        .agg(F.sum("n").alias("n_refs"))
    )
