"""Following a folder: new JSON files are normalized as they arrive, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomgraph.functions.ids import doc_id
from loomgraph.operators.normalize import normalize
from loomgraph.session import ship_package
from loomgraph.sources.sinks import write_normalized


def follow(spark: SparkSession, folder: str, out: str, checkpoint: str, family: str = "aha", once: bool = False, files_per_batch: int = 1000) -> StreamingQuery:
    """Normalize files of ``folder`` into the tables under ``out``.

    A batch replaces the partitions of its guidelines, so a batch that is redone after a failure gives the same
    tables. ``once`` takes what is there and ends; else the query goes on until it is stopped.
    """
    ship_package(spark)
    files = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "*.json").load(folder)
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")
    rows = files.select(path.alias("path"), F.col("value").alias("body"))

    def batch(df: DataFrame, _number: int) -> None:
        raw = df.select(F.xxhash64("path").alias("file_id"), doc_id(F.col("path")).alias("guideline_id"), "path", "body")
        for name, table in normalize(raw, family).items():
            write_normalized(table, f"{out}/{name}")

    writer = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
