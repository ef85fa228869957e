"""The state of a pipeline: one row per document with the stages that are done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.session import cut

SCHEMA = "doc_id string, source_json_path string, source_pdf_path string, family string, stages map<string,string>, notes array<string>"


def load(spark: SparkSession, folder: str) -> DataFrame:
    """The state; empty where there is none."""
    try:
        return spark.read.schema(SCHEMA).parquet(folder)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], SCHEMA)
        raise


def save(state: DataFrame, folder: str) -> None:
    """Write the state in order of doc_id. It may come from the same folder, so it is cut first."""
    cut(state).repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.mode("overwrite").parquet(folder)


def upsert(state: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` in place of the rows with their doc_id."""
    return state.join(rows.select("doc_id"), "doc_id", "left_anti").select(*rows.columns).unionByName(rows)


def pending(discovered: DataFrame, state: DataFrame, stage: str, force: bool = False) -> DataFrame:
    """Discovered documents (doc_id, ...) for which the stage is not done."""
    if force:
        return discovered
    return discovered.join(state.where(F.col("stages")[stage] == "completed").select("doc_id"), "doc_id", "left_anti")


def mark(state: DataFrame, docs: DataFrame, stage: str, status: str = "completed") -> DataFrame:
    """The state with the stage of the given documents set."""
    hit = docs.select("doc_id").distinct().withColumn("hit", F.lit(True))
    kept = F.map_filter(F.coalesce("stages", F.create_map().cast("map<string,string>")), lambda k, v: k != stage)
    new = F.when(F.col("hit"), F.map_concat(kept, F.create_map(F.lit(stage), F.lit(status)))).otherwise(F.col("stages"))
    return state.join(hit, "doc_id", "left").withColumn("stages", new).drop("hit")
