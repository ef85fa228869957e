"""TF-IDF search over snippets: a table of weighted postings and a table of term weights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.operators.skew import HEAVY_PARTS, lookup_join
from loomgraph.session import cut

#: Tokens: two or more letters, digits or underscores.
TOKEN = r"[\p{L}\p{N}_]{2,}"


def ngrams(text: Column) -> Column:
    """Words and pairs of neighbouring words of the lower-cased text, in order and with repetitions."""
    words = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    count = F.size(words)
    pairs = F.when(count > 1, F.zip_with(F.slice(words, 1, count - 1), F.slice(words, 2, count), lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))
    return F.concat(words, pairs)


def counts(texts: DataFrame, key: str = "snippet_id") -> DataFrame:
    """(key, term, tf)."""
    return texts.select(key, F.explode(ngrams(F.col("text"))).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


@dataclass(frozen=True)
class TfidfIndex:
    """postings: snippet_id, term, weight; idf: term, df, idf."""

    postings: DataFrame
    idf: DataFrame

    @classmethod
    def fit(cls, texts: DataFrame) -> TfidfIndex:
        """Index (snippet_id, text). Texts that are null or without tokens count as documents but have no postings.

        idf = ln((1+N)/(1+df))+1; weight = tf*idf, scaled to length 1 per snippet. snippet_id must be unique.

        Texts are taken apart once. Terms with a large share of the postings get their weight by broadcast, the others
        by a shuffle; a snippet's length is summed over its own postings.
        """
        n = texts.count()
        tf = cut(counts(texts))
        df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        idf = cut(df.withColumn("idf", F.log((F.lit(1.0) + F.lit(float(n))) / (F.col("df") + 1)) + 1))
        heavy = idf.where(F.col("df") >= max(2, -(-tf.count() // HEAVY_PARTS))).select("term")
        weighed = lookup_join(tf, idf.select("term", "idf"), "term", heavy).withColumn("w", F.col("tf") * F.col("idf"))
        norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("snippet_id")))
        return cls(weighed.select("snippet_id", "term", (F.col("w") / norm).alias("weight")), idf)

    def search(self, query: str, top_k: int = 5) -> DataFrame:
        """snippet_id, score of the best snippets by cosine, above 0; ties by snippet_id.

        Only postings of the query's terms are read; the query side has as many rows as the query has terms.
        """
        spark = self.idf.sparkSession
        asked = counts(spark.createDataFrame([("q", query)], "snippet_id string, text string")).drop("snippet_id")
        q = self.idf.join(F.broadcast(asked), "term").select("term", (F.col("tf") * F.col("idf")).alias("qw"))
        length = F.sqrt(F.sum(F.col("qw") * F.col("qw")).over(Window.partitionBy()))  # over the query's terms
        hits = self.postings.join(F.broadcast(q.select("term", (F.col("qw") / length).alias("qw"))), "term")
        scored = hits.groupBy("snippet_id").agg(F.sum(F.col("weight") * F.col("qw")).alias("score"))
        return scored.where(F.col("score") > 0).orderBy(F.desc("score"), "snippet_id").limit(top_k)

    def save(self, folder: str) -> None:
        """Write both tables, postings sorted by term so that a search skips most row groups."""
        self.postings.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{folder}/postings")
        self.idf.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{folder}/idf")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> TfidfIndex | None:
        """The saved index, or None where there is none."""
        try:
            return cls(spark.read.parquet(f"{folder}/postings"), spark.read.parquet(f"{folder}/idf"))
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
