"""Queries of the training-text problems and their SQL, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.llm.abuse import rates_by_source, score_documents
from loomgraph.llm.canonical import map_values
from loomgraph.llm.copies import collapsed, copies_found, keyed_records
from loomgraph.llm.mixing import mix_report, mix_sources
from loomgraph.llm.split import split_snippets
from loomgraph.llm.tokens import count_tokens, encode_corpus
from loomgraph.session import cut, read_table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = split_snippets(read_table(spark, sf_dir, "snippets"))
    return pieces.where((F.col("piece") == 0) & (F.col("n_pieces") > 1)).select("row_id")


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_snippets(read_table(spark, sf_dir, "snippets"))


def p1_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each snippet what its pieces come to: their number, longest, overlaps, and whether they give back the text."""
    p = p1_pieces(spark, sf_dir).where(F.col("text").isNotNull())
    after = Window.partitionBy("row_id").orderBy("piece")
    overlap = F.lag("end_at").over(after) - F.col("start_at")
    rows = p.withColumn("overlap", overlap).withColumn("own", F.expr("substring(text, 1 + coalesce(overlap, 0))"))
    merged = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "own"))), lambda x: x["own"]), "")
    return rows.groupBy("row_id").agg(
        F.md5(merged).alias("text_md5"), (F.max(F.length("text")) <= 1600).alias("within"), F.coalesce(F.min("overlap"), F.lit(200)).alias("least"), F.coalesce(F.max("overlap"), F.lit(200)).alias("most")
    )


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_values(*(read_table(spark, sf_dir, t) for t in ("gene_mentions", "llm_extractions", "terms")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir).where(~F.col("exact")).select("src_field", "row_id", "pos", "term_id")


def p3_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = _mapped(spark, sf_dir).where(F.col("term_id") == -1)
    return lost.groupBy("src_field", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies_found(keyed_records(read_table(spark, sf_dir, "snippets"), read_table(spark, sf_dir, "gene_mentions")))


def p6_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapsed(read_table(spark, sf_dir, "snippets"), read_table(spark, sf_dir, "gene_mentions"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(read_table(spark, sf_dir, "documents"))


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents, targets = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "mix_targets")
    sized = cut(count_tokens(documents).join(documents.select("doc_id", "source"), "doc_id"))
    return mix_sources(sized, targets), targets


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(*_mix(spark, sf_dir))


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "doc_labels"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_scores(spark, sf_dir).where("flagged").select("doc_id")


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates_by_source(p9_scores(spark, sf_dir))


QUERIES = {
    "p1_found": p1_found,
    "p1_pieces": p1_pieces,
    "p1_checked": p1_checked,
    "p3_found": p3_found,
    "p3_unmatched": p3_unmatched,
    "p6_found": p6_found,
    "p6_collapsed": p6_collapsed,
    "p7_ids": p7_ids,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_scores": p9_scores,
    "p9_rates": p9_rates,
}

# a point between two digits is kept as another sign; the pattern takes no overlapping pairs, so it is applied twice
_POINTS = r"regexp_replace(regexp_replace(lower({}), '([0-9])\.([0-9])', '\1∙\2', 'g'), '([0-9])\.([0-9])', '\1∙\2', 'g')"
_FORM = lambda c: r"regexp_replace(" + _POINTS.format(c) + r", '[\p{Z}\p{C}\p{P}\s]', '', 'g')"
_COPIES = f"""WITH st AS (SELECT row_id, CASE WHEN coalesce(snippet_type = 'record', false)
    THEN 'r' || nullif(array_to_string(list_sort(list_filter(list_transform(regexp_split_to_array(text, '[;|\n]'), lambda x: {_FORM('x')}), lambda x: x <> '')), ';'), '')
    ELSE 't' || nullif({_FORM('text')}, '') END AS k FROM snippets),
  sn AS (SELECT 'snippets' AS tbl, min(row_id) OVER (PARTITION BY k) AS first_row_id, row_id FROM st WHERE k IS NOT NULL),
  mt AS (SELECT row_id, guideline_id, occurrences, content_index, {_FORM('gene_symbol')} AS s, {_FORM('context')} AS c,
    list_sort(list_transform(associated_conditions, lambda x: coalesce('=' || {_FORM('x')}, '~'))) AS a FROM gene_mentions WHERE regexp_matches(gene_symbol, '[^\\s\\p{{Z}}\\p{{C}}]')),
  mn AS (SELECT 'gene_mentions' AS tbl, min(row_id) OVER (PARTITION BY guideline_id, occurrences, content_index, s, c, a) AS first_row_id, row_id FROM mt)"""

ORACLES = {
    "p1_found": "SELECT row_id FROM snippets WHERE length(text) > 1600",
    "p1_checked": "SELECT row_id, md5(text) AS text_md5, true AS within, 200 AS least, 200 AS most FROM snippets WHERE text IS NOT NULL",
    "p6_found": _COPIES + " SELECT tbl, first_row_id, row_id FROM sn WHERE first_row_id < row_id UNION ALL SELECT tbl, first_row_id, row_id FROM mn WHERE first_row_id < row_id",
    "p6_collapsed": _COPIES
    + """ SELECT tbl, first_row_id AS row_id, count(*) AS n_copies FROM (SELECT * FROM sn UNION ALL SELECT * FROM mn) GROUP BY ALL
      UNION ALL SELECT 'snippets', row_id, 1 FROM snippets WHERE row_id NOT IN (SELECT row_id FROM sn)
      UNION ALL SELECT 'gene_mentions', row_id, 1 FROM gene_mentions WHERE row_id NOT IN (SELECT row_id FROM mn)""",
}
