"""Queries of the general data problems (p2, p4, p5) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators.nested import NAMED_KINDS, flatten_bodies, kind_table
from loomgraph.operators.references import count_orphans, orphan_references
from loomgraph.operators.schema_drift import consistent_heads, drift_events
from loomgraph.session import read_table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, nodes = read_table(spark, sf_dir, "edges"), read_table(spark, sf_dir, "nodes")
    return orphan_references(edges, nodes).select("row_id", "side", "status")


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, nodes = read_table(spark, sf_dir, "edges"), read_table(spark, sf_dir, "nodes")
    return count_orphans(edges, nodes)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift_events(read_table(spark, sf_dir, "raw_guidelines"))


def p4_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consistent_heads(read_table(spark, sf_dir, "raw_guidelines"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_bodies(read_table(spark, sf_dir, "raw_guidelines"), ("item", "section", "gene"), fields=False)
    return flat.select("file_id", "kind", "json_pointer", "parent_pointer")


def _p5(kind: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return kind_table(flatten_bodies(read_table(spark, sf_dir, "raw_guidelines"), (kind,)), kind)

    return query


def p5_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_bodies(read_table(spark, sf_dir, "raw_guidelines"))
    return flat.where(~F.col("kind").isin(*NAMED_KINDS)).select("file_id", "kind", "json_pointer", "parent_pointer", "fields")


QUERIES = {
    "p2_found": p2_found,
    "p2_report": p2_report,
    "p4_found": p4_found,
    "p4_heads": p4_heads,
    "p5_found": p5_found,
    "p5_documents": _p5("document"),
    "p5_items": _p5("item"),
    "p5_sections": _p5("section"),
    "p5_genes": _p5("gene"),
    "p5_repeated": p5_repeated,
}

_P2 = """
WITH state AS (
  SELECT node_id, min(updated_at) AS first_seen, arg_max(coalesce(deleted, false), (updated_at, row_id)) AS gone
  FROM nodes WHERE node_id IS NOT NULL GROUP BY node_id),
refs AS (
  SELECT row_id, 'source' AS side, source_id AS ref, relation, created_at FROM edges
  UNION ALL
  SELECT row_id, 'target' AS side, target_id AS ref, relation, created_at FROM edges),
judged AS (
  SELECT row_id, side, relation, strftime(created_at, '%Y-%m') AS period,
    CASE WHEN state.node_id IS NULL THEN 'missing' WHEN gone THEN 'deleted'
         WHEN first_seen > created_at THEN 'late' END AS status
  FROM refs LEFT JOIN state ON ref = node_id WHERE ref IS NOT NULL AND ref <> '')
"""

# heads as (file, path, type): of a key in several objects of an array the first type that is no absence
_P4 = r"""
WITH ok AS (
  SELECT file_id, coalesce(feed, '') AS feed, exported_at, json_extract(body::JSON, '$.content[0].content') AS head FROM raw_guidelines
  WHERE json_valid(body) AND json_type(body::JSON) = 'OBJECT' AND json_type(body::JSON, '$.content') = 'ARRAY' AND json_type(body::JSON, '$.content[0]') = 'OBJECT'),
files AS (SELECT feed, file_id, (exported_at, file_id) AS moment FROM ok),
tops AS (SELECT o.feed, o.file_id, (o.exported_at, o.file_id) AS moment, e.key AS path, e.type AS jt, e.value AS v FROM ok o, json_each(o.head) e WHERE json_type(o.head) = 'OBJECT'),
items AS (
  SELECT t.feed, t.file_id, t.moment, t.path, 0 AS n, t.v AS o FROM tops t WHERE t.jt = 'OBJECT'
  UNION ALL SELECT t.feed, t.file_id, t.moment, t.path, x.id::BIGINT, x.value FROM tops t, json_each(t.v) x WHERE t.jt = 'ARRAY' AND x.type = 'OBJECT'),
subs AS (SELECT i.feed, i.file_id, i.moment, i.path || '.' || e.key AS path, i.n, e.type AS jt, e.value AS v FROM items i, json_each(i.o) e),
each_path AS (SELECT feed, file_id, moment, path, -1 AS n, jt, v FROM tops UNION ALL SELECT * FROM subs),
typed AS (
  SELECT feed, file_id, moment, path, n, CASE WHEN jt = 'VARCHAR' THEN 'string' WHEN jt = 'BOOLEAN' THEN 'boolean' WHEN jt = 'OBJECT' THEN 'object' WHEN jt = 'NULL' THEN NULL
    WHEN jt <> 'ARRAY' THEN 'number' WHEN json_array_length(v) = 0 THEN NULL
    WHEN list_contains(list_transform(json_extract(v, '$[*]'), lambda x: json_type(x)), 'OBJECT') THEN 'array of objects' ELSE 'array of strings' END AS type FROM each_path),
paths AS (SELECT feed, file_id, moment, path, arg_min(type, n) AS type FROM typed WHERE type IS NOT NULL GROUP BY ALL),
named AS (SELECT *, regexp_replace(regexp_replace(lower(path), '[\s\p{Z}_-]', '', 'g'), '(^|\.)guidelinetitle(\.|$)', '\1title\2') AS field FROM paths),
seen AS (SELECT feed, field, file_id, moment, min(path) AS path, arg_min(type, path) AS type FROM named GROUP BY ALL),
lagged AS (SELECT *, lag(path) OVER w AS old_path, lag(type) OVER w AS old_type, lead(moment) OVER w IS NULL AS is_last FROM seen WINDOW w AS (PARTITION BY feed, field ORDER BY moment)),
nexts AS (SELECT feed, moment, lead(file_id) OVER (PARTITION BY feed ORDER BY moment) AS next_file, lag(moment) OVER (PARTITION BY feed ORDER BY moment) IS NULL AS is_first FROM files)
SELECT file_id, path AS field_path, 'added' AS change_kind FROM lagged JOIN nexts USING (feed, moment) WHERE old_path IS NULL AND NOT is_first
UNION ALL SELECT file_id, path, 'renamed' FROM lagged WHERE path <> old_path
UNION ALL SELECT file_id, path, 'retyped' FROM lagged WHERE type <> old_type
UNION ALL SELECT next_file, path, 'removed' FROM lagged JOIN nexts USING (feed, moment) WHERE is_last AND next_file IS NOT NULL"""

# ptr: pointer; ck: key of the array that holds an element, or of a single object; item, near: pointers of the nearest
_P5 = r"""
WITH RECURSIVE ok AS (SELECT file_id, body::JSON AS j FROM raw_guidelines WHERE json_valid(body) AND json_type(body::JSON) = 'OBJECT'),
t AS MATERIALIZED (SELECT ok.file_id, x.id, x.parent, x.key, x.type, CASE WHEN x.type = 'OBJECT' THEN json_extract_string(x.value, '$.Gene') END AS gene,
  CASE WHEN x.type = 'OBJECT' THEN json_type(x.value, '$.Gene') END AS gene_type FROM ok, json_tree(ok.j) x WHERE x.type IN ('OBJECT', 'ARRAY')),
r AS (
  SELECT file_id, id, type, '' AS ptr, NULL::VARCHAR AS own, NULL::VARCHAR AS kind, false AS in_item, false AS in_genes, '' AS near, gene, gene_type FROM t WHERE parent IS NULL
  UNION ALL
  SELECT file_id, id, type, ptr, own, kind, in_item OR coalesce(kind = 'item', false), in_genes,
    CASE WHEN kind IN ('item', 'section') THEN ptr ELSE near END, gene, gene_type
  FROM (
    SELECT *, CASE WHEN type <> 'OBJECT' OR ck IS NULL THEN NULL WHEN cp = '/content' THEN 'item' WHEN cp = '/genes' THEN 'gene' WHEN NOT in_item THEN NULL WHEN ck = 'genes' THEN 'gene'
      WHEN ck IN ('Sections', 'sections') AND NOT in_genes THEN 'section' END AS kind
    FROM (
      SELECT t.file_id, t.id, t.type, r.ptr || '/' || t.key AS ptr, CASE WHEN r.type = 'OBJECT' THEN t.key END AS own,
        CASE WHEN r.type = 'OBJECT' THEN t.key ELSE r.own END AS ck, CASE WHEN r.type = 'OBJECT' THEN r.ptr || '/' || t.key WHEN r.own IS NOT NULL THEN r.ptr END AS cp,
        r.in_item, r.in_genes OR (r.in_item AND r.type = 'OBJECT' AND t.key = 'genes') AS in_genes, r.near, t.gene, t.gene_type
      FROM r JOIN t ON t.file_id = r.file_id AND t.parent = r.id)))
SELECT file_id, kind, ptr AS json_pointer, CASE WHEN kind = 'item' THEN '' ELSE parent END AS parent_pointer
FROM (SELECT r.*, up.near AS parent FROM r JOIN t USING (file_id, id) JOIN r up ON up.file_id = r.file_id AND up.id = t.parent)
WHERE kind IN ('item', 'section') OR (kind = 'gene' AND gene_type = 'VARCHAR' AND regexp_matches(gene, '[^\s\p{Z}]'))"""

ORACLES = {
    "p4_found": _P4,
    "p5_found": _P5,
    "p2_found": _P2 + "SELECT row_id, side, status FROM judged WHERE status IS NOT NULL",
    "p2_report": _P2
    + "SELECT relation, period, side, status, count(*) AS n_refs FROM judged WHERE status IS NOT NULL GROUP BY ALL",
}
