"""Finding and reading JSON documents, companion PDFs and term lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.functions.ids import doc_id, strip


def discover(spark: SparkSession, glob: str, limit: int | None = None) -> DataFrame:
    """Paths that match, in order of letters, the first ``limit`` of them: path."""
    found = spark.read.format("binaryFile").load(glob).select(F.regexp_replace(F.col("path"), "^file:/+", "/").alias("path"))
    return found if limit is None else found.orderBy("path").limit(limit)


def read_documents(spark: SparkSession, glob: str, limit: int | None = None) -> DataFrame:
    """file_id (from the path), guideline_id, path, body of each file."""
    texts = spark.read.format("text").option("wholetext", True).load(glob)
    rows = texts.select(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("path"), F.col("value").alias("body"))
    if limit is not None:
        rows = rows.orderBy("path").limit(limit)
    return rows.select(F.xxhash64("path").alias("file_id"), doc_id(F.col("path")).alias("guideline_id"), "path", "body")


def with_sidecars(documents: DataFrame, pdf_folder: str) -> DataFrame:
    """Documents with source_pdf_path: ``stem.pdf`` anywhere below the folder, the first in order of letters; else null.

    The stem is that of the document without a trailing ``_aggregated``.
    """
    spark = documents.sparkSession
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(pdf_folder)
        files = files.select(F.regexp_replace(F.col("path"), "^file:/+", "/").alias("source_pdf_path"))
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        files = spark.createDataFrame([], "source_pdf_path string")
    return join_sidecars(documents, files)


def join_sidecars(documents: DataFrame, files: DataFrame) -> DataFrame:
    """Documents (path) with the source_pdf_path of the file (source_pdf_path) that has their stem. A null path has none."""
    stem = lambda c: F.regexp_extract(c, r"([^/]+?)(?:\.[^./]*)?$", 1)
    best = files.groupBy(stem(F.col("source_pdf_path")).alias("stem")).agg(F.min("source_pdf_path").alias("source_pdf_path"))
    own = F.regexp_replace(stem(F.col("path")), "_aggregated$", "")
    return documents.withColumn("stem", own).join(best, "stem", "left").drop("stem")


def read_lexicon(spark: SparkSession, path: str | None) -> DataFrame:
    """Upper-case terms of a text file, without blank lines and ``#`` lines: term. No file: empty."""
    try:
        lines = spark.read.text(path) if path else None
        if lines is None:
            raise FileNotFoundError
    except Exception as e:  # noqa: BLE001
        if path and "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "term string")
    term = F.upper(strip(F.col("value")))
    return lines.select(term.alias("term")).where((F.col("term") != "") & ~F.col("term").startswith("#")).distinct()


def document_shape(body: str) -> str:
    """SQL for what a body is: ``normalized`` (metadata and snippets among its keys), ``raw`` or ``other``."""
    keys = f"json_object_keys({body})"
    return f"CASE WHEN {keys} IS NULL THEN 'other' WHEN array_contains({keys}, 'metadata') AND array_contains({keys}, 'snippets') THEN 'normalized' ELSE 'raw' END"
