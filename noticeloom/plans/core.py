"""The pN queries of the general problems over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import asof, hierarchy, references
from ..sources.tables import table

WITHHELD = "氏名非公表"


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    gold = table(spark, folder, "gold_records").select("id", "superseded_by")
    sets = hierarchy.nested_sets(gold, "id", "superseded_by", path=False)
    return sets.join(gold.where("superseded_by is not null").select("id").distinct(), "id", "left_semi").select("id", "root_id", F.col("depth").cast("int").alias("depth"))


def p2_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Every row with its path from the final row, depth, range and number of rows it replaced."""
    gold = table(spark, folder, "gold_records").select("id", "superseded_by")
    sets = hierarchy.nested_sets(gold, "id", "superseded_by")
    return sets.select("id", "root_id", F.col("depth").cast("int").alias("depth"), F.concat_ws("/", F.col("path").cast("array<string>")).alias("path"), "n_descendants")


def p2_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """Every row with each row that it replaced, directly or through others."""
    gold = table(spark, folder, "gold_records").select("id", "superseded_by")
    return hierarchy.descendants(hierarchy.nested_sets(gold, "id", "superseded_by", path=False))


#: referring table and column, referring time, referenced table and time
REFERENCES = [
    ("jobs", "pdf_id", "started_at", "pdfs", "created_at"),
    ("jobs", "parser_version_id", "started_at", "parser_versions", "released_at"),
    ("personnel_sections", "layout_id", "created_at", "layouts", "created_at"),
]


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    out = None
    for name, column, at, parent, since in REFERENCES:
        child = table(spark, folder, name).select(F.lit(f"{name}.{column}").alias("ref_field"), F.lit(parent).alias("parent"), F.col("id").alias("row_id"), F.col(column).alias("ref"), F.col(at).alias("at")).distinct()
        found = references.orphans(child, table(spark, folder, parent).select("id", since), [("ref", "id")], times=("at", since))
        out = found if out is None else out.unionByName(found)
    return out


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return _orphans(spark, folder).select("ref_field", "row_id").distinct()


def p4_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Orphans counted for each reference, month of the referring row and reason; `deleted` where the missing row is in
    the log of deletions."""
    log = table(spark, folder, "deleted_rows").select(F.col("table_name").alias("parent"), F.col("row_id").alias("ref")).distinct().withColumn("gone", F.lit(True))
    found = _orphans(spark, folder).join(log, ["parent", "ref"], "left")
    reason = F.when(F.col("gone") & (F.col("reason") == "missing"), "deleted").otherwise(F.col("reason"))
    return found.groupBy("ref_field", F.date_format("at", "yyyy-MM").alias("month"), reason.alias("why")).agg(F.countDistinct("row_id").alias("n"))


def p4_composite(spark: SparkSession, folder: str) -> DataFrame:
    """raw_records hold a key of two columns, (section_ref, layout_id), null in part: under partial matching a section
    with that id and layout must exist, or, where section_ref is null, any section of that layout."""
    sections = table(spark, folder, "personnel_sections").select(F.col("id").alias("section"), "layout_id")
    eras = table(spark, folder, "layouts").select(F.col("id").alias("layout_id"), "era_id")
    parent = sections.join(F.broadcast(eras), "layout_id").select("section", "era_id")
    child = table(spark, folder, "raw_records").select("record_id", "section_ref", "layout_id").distinct()
    return references.orphans(child, parent, [("section_ref", "section"), ("layout_id", "era_id")], match="partial").select("record_id", F.col("section_ref").isNull().alias("ref_is_null"), "reason")


def _as_of(spark: SparkSession, folder: str) -> DataFrame:
    gold = table(spark, folder, "gold_records").select(F.col("id").alias("gold_id"), "effective_date", "created_at", F.get_json_object("fields", "$.organization.value").alias("organization"))
    items = table(spark, folder, "knowledge_items").where("category = 'organization'")
    return asof.as_known(gold, items, key=("organization", "item_key"), event_date="effective_date", event_known="created_at", item_id="id", item_value="canonical_value", valid=("effective_from", "effective_to"), item_known="created_at")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _as_of(spark, folder).where("item_id is not null").select("gold_id", "item_id").distinct()


def p5_gold_with_organization(spark: SparkSession, folder: str) -> DataFrame:
    """Every gold row with its organisation's name in force and known at the time, or null."""
    return _as_of(spark, folder).select("gold_id", "organization", F.col("item_value").alias("canonical_value"))


QUERIES = {f.__name__: f for f in (p2_found, p2_paths, p2_replaced, p4_found, p4_by_month, p4_composite, p5_found, p5_gold_with_organization)}

_WALK = """WITH RECURSIVE e AS (SELECT DISTINCT id, superseded_by nxt FROM gold_records),
g AS (SELECT e.id, p.id AS nxt FROM e LEFT JOIN e p ON p.id = e.nxt),
w(id, cur, path, looped) AS (
  SELECT id, id, [id], false FROM g
  UNION ALL
  SELECT w.id, g.nxt, list_append(w.path, g.nxt), list_contains(w.path, g.nxt)
  FROM w JOIN g ON g.id = w.cur WHERE g.nxt IS NOT NULL AND NOT w.looped),
final AS (
  SELECT id, cur AS root_id, len(path) - 1 AS depth, path FROM w JOIN g USING (id) WHERE NOT looped AND NOT EXISTS (SELECT 1 FROM g n WHERE n.id = w.cur AND n.nxt IS NOT NULL)
  UNION ALL
  SELECT id, list_min(path[list_position(path, cur):]), -1, NULL FROM w WHERE looped)
"""

ORACLES = {
    "p2_found": _WALK + "SELECT id, root_id, CAST(depth AS INTEGER) AS depth FROM final WHERE id IN (SELECT id FROM gold_records WHERE superseded_by IS NOT NULL)",
    "p2_paths": _WALK
    + """, below AS (SELECT anc, count(*) - 1 AS n FROM (SELECT unnest(path) AS anc FROM final WHERE path IS NOT NULL) GROUP BY anc)
SELECT id, root_id, CAST(depth AS INTEGER) AS depth, coalesce(array_to_string(list_reverse(path), '/'), '') AS path, CASE WHEN depth >= 0 THEN n END AS n_descendants FROM final LEFT JOIN below ON anc = id""",
    "p2_replaced": _WALK + "SELECT anc AS ancestor_id, id AS descendant_id FROM (SELECT id, unnest(path) AS anc FROM final WHERE path IS NOT NULL) WHERE anc <> id",
    "p4_found": """SELECT DISTINCT 'jobs.pdf_id' AS ref_field, id AS row_id FROM jobs c WHERE pdf_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pdfs p WHERE p.id = c.pdf_id AND p.created_at <= c.started_at)
UNION SELECT 'jobs.parser_version_id', id FROM jobs c WHERE parser_version_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM parser_versions p WHERE p.id = c.parser_version_id AND p.released_at <= c.started_at)
UNION SELECT 'personnel_sections.layout_id', id FROM personnel_sections c WHERE layout_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM layouts p WHERE p.id = c.layout_id AND p.created_at <= c.created_at)""",
    "p4_by_month": """WITH c AS (SELECT 'jobs.pdf_id' AS ref_field, 'pdfs' AS parent, id, pdf_id AS ref, started_at AS t FROM jobs
UNION SELECT 'jobs.parser_version_id', 'parser_versions', id, parser_version_id, started_at FROM jobs
UNION SELECT 'personnel_sections.layout_id', 'layouts', id, layout_id, created_at FROM personnel_sections),
p AS (SELECT parent, id, min(since) AS since FROM (SELECT 'pdfs' AS parent, id, created_at AS since FROM pdfs UNION ALL SELECT 'parser_versions', id, released_at FROM parser_versions UNION ALL SELECT 'layouts', id, created_at FROM layouts) GROUP BY 1, 2),
d AS (SELECT DISTINCT table_name, row_id FROM deleted_rows)
SELECT c.ref_field, strftime(c.t, '%Y-%m') AS month, CASE WHEN p.id IS NOT NULL THEN 'later' WHEN d.row_id IS NOT NULL THEN 'deleted' ELSE 'missing' END AS why, count(DISTINCT c.id) AS n
FROM c LEFT JOIN p ON p.parent = c.parent AND p.id = c.ref LEFT JOIN d ON d.table_name = c.parent AND d.row_id = c.ref
WHERE c.ref IS NOT NULL AND (p.id IS NULL OR p.since > c.t) GROUP BY 1, 2, 3""",
    "p4_composite": """WITH s AS (SELECT s.id, l.era_id FROM personnel_sections s JOIN layouts l ON l.id = s.layout_id)
SELECT DISTINCT record_id, section_ref IS NULL AS ref_is_null, 'missing' AS reason FROM raw_records r
WHERE (section_ref IS NOT NULL AND layout_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s WHERE s.id = r.section_ref AND s.era_id = r.layout_id))
OR (section_ref IS NULL AND layout_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s WHERE s.era_id = r.layout_id))
OR (section_ref IS NOT NULL AND layout_id IS NULL AND NOT EXISTS (SELECT 1 FROM s WHERE s.id = r.section_ref))""",
    "p5_found": """SELECT gold_id, item_id FROM (SELECT g.id AS gold_id, k.id AS item_id, row_number() OVER (PARTITION BY g.id ORDER BY k.effective_from DESC NULLS LAST, k.created_at DESC, k.id DESC) AS r
FROM gold_records g JOIN (SELECT DISTINCT * FROM knowledge_items WHERE category = 'organization') k ON k.item_key = json_extract_string(g.fields, '$.organization.value')
WHERE (k.effective_from IS NULL OR k.effective_from <= g.effective_date) AND (k.effective_to IS NULL OR g.effective_date < k.effective_to) AND k.created_at <= g.created_at) WHERE r = 1""",
    "p5_gold_with_organization": """SELECT g.id AS gold_id, json_extract_string(g.fields, '$.organization.value') AS organization, f.canonical_value FROM gold_records g LEFT JOIN
(SELECT g.id, k.canonical_value, row_number() OVER (PARTITION BY g.id ORDER BY k.effective_from DESC NULLS LAST, k.created_at DESC, k.id DESC) AS r
FROM gold_records g JOIN (SELECT DISTINCT * FROM knowledge_items WHERE category = 'organization') k ON k.item_key = json_extract_string(g.fields, '$.organization.value')
WHERE (k.effective_from IS NULL OR k.effective_from <= g.effective_date) AND (k.effective_to IS NULL OR g.effective_date < k.effective_to) AND k.created_at <= g.created_at) f ON f.id = g.id AND f.r = 1""",
}
