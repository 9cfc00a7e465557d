"""Queries of the document-record operators over whole tables, and their SQL.

Fixed times stand in for the clock, so that results can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scoring, text
from ..operators import audit, extract, features, layout, lookup, metrics, resume, versions
from ..runtime import Scratch, broadcast_if_small
from ..sinks import export
from ..sources.tables import table
from ..streaming import ingest

NOW, AS_OF = "2026-01-01 00:00:00", "2020-01-01"
QUERIES, ORACLES = {}, {}


def _at(time: str) -> Column:
    return F.lit(time).cast("timestamp_ntz")


def _day(date: str) -> Column:
    return F.lit(date).cast("date")


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


# SQL pieces for lines of a text and for bands, used by several statements
_B = text.BLANK
_STRIP = lambda x: f"regexp_replace({x}, '^{_B}+|{_B}+$', '', 'g')"
_LINES = lambda x: f"list_filter(list_transform(regexp_split_to_array(coalesce({x}, ''), '{text.LINE_END}'), lambda l: {_STRIP('l')}), lambda l: l <> '')"
_BLOCKS = lambda x: f"list_filter(string_split(coalesce({x}, ''), chr(10) || chr(10)), lambda l: {_STRIP('l')} <> '')"
_BAND = lambda s: f"CASE WHEN {s} >= 0.9 THEN 'verified' WHEN {s} >= 0.75 THEN 'high' WHEN {s} >= 0.5 THEN 'medium' ELSE 'low' END"


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """The sections of a notice in order stand for its pages; of several parses the sections still in use."""
    sections = table(spark, folder, "personnel_sections").where("status = 'parsed'")
    return sections.select(F.col("pdf_id").alias("doc_id"), F.struct("section_index", "id").alias("page_index"), F.col("section_text").alias("text"))


_EVIDENCE = f"""WITH p AS (SELECT pdf_id AS doc_id, section_index, id, coalesce(section_text, '') AS t, {_LINES('section_text')} AS lines, len({_BLOCKS('section_text')}) AS blocks FROM personnel_sections WHERE status = 'parsed'),
ev AS (SELECT doc_id, count(*) AS page_count, avg(length(t)) AS mean_chars, avg(len(lines)) AS mean_lines, avg(blocks) AS mean_blocks,
  arg_min(lines, (section_index, id))[1] AS header, arg_max(lines, (section_index, id))[-1] AS footer FROM p GROUP BY doc_id)
"""


@query(_EVIDENCE + "SELECT * FROM ev")
def layout_evidence(spark: SparkSession, folder: str) -> DataFrame:
    return layout.evidence(_pages(spark, folder))


#: A manifest of two layouts with a margin case: ordinal, id and rules.
MANIFEST = [
    (0, "public_notice", [("head", "header_pattern", "公示", 0.4), ("foot", "footer_pattern", "以上", 0.2), ("pages", "min_page_count", "2", 0.2), ("many", "min_page_count", "3", 0.2)]),
    (1, "order_slip", [("head", "header_pattern", "発令", 0.6), ("foot", "footer_pattern", "以上", 0.4)]),
]


def _manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MANIFEST, f"ordinal int, layout_id string, rules {layout.RULES}")


def _score_sql(rules: list) -> str:
    test = {"header_pattern": "coalesce(contains(header, '{}'), false)", "footer_pattern": "coalesce(contains(footer, '{}'), false)", "min_page_count": "page_count >= {}"}
    hit = " + ".join(f"CASE WHEN {test[kind].format(value)} THEN {weight}::DOUBLE ELSE 0::DOUBLE END" for _, kind, value, weight in rules)
    return f"(0::DOUBLE + {hit}) / (0::DOUBLE + {' + '.join(f'{w}::DOUBLE' for *_, w in rules)})"


_DETECT = (
    _EVIDENCE
    + f""", c AS (SELECT doc_id, 0 AS ordinal, 'public_notice' AS layout_id, {_score_sql(MANIFEST[0][2])} AS score FROM ev UNION ALL SELECT doc_id, 1, 'order_slip', {_score_sql(MANIFEST[1][2])} FROM ev),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ordinal) AS n, lead(score) OVER (PARTITION BY doc_id ORDER BY score DESC, ordinal) AS second FROM c),
d AS (SELECT doc_id, CASE WHEN score >= 0.6 THEN layout_id END AS layout_id, score, {_BAND('score')} AS band,
  CASE WHEN score < 0.3 THEN 'NO_MATCH' WHEN score < 0.6 THEN 'LOW_CONFIDENCE' WHEN score - second < 0.05 THEN 'AMBIGUOUS' ELSE '' END AS warnings FROM r WHERE n = 1)
"""
)


def _detected(spark: SparkSession, folder: str) -> DataFrame:
    return layout.detect(layout.evidence(_pages(spark, folder)), _manifest(spark))


@query(_DETECT + "SELECT * FROM d")
def layout_detect(spark: SparkSession, folder: str) -> DataFrame:
    return _detected(spark, folder).withColumn("warnings", F.array_join("warnings", ","))


@query(_DETECT + "SELECT coalesce(layout_id, 'none') AS layout, band, count(*) AS n FROM d GROUP BY 1, 2")
def layout_detect_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _detected(spark, folder).groupBy(F.coalesce("layout_id", F.lit("none")).alias("layout"), "band").agg(F.count("*").alias("n"))


@query(f"""WITH l AS (SELECT doc_id, {_LINES('text')} AS lines FROM documents)
SELECT doc_id, lines[1] AS header, lines[-1] AS footer, CAST(greatest(len(lines) - 2, 0) AS BIGINT) AS body_lines, length(array_to_string(lines, chr(10))) AS n_chars, CASE WHEN len(lines) < 3 THEN 0.3 ELSE 1.0 END::DOUBLE AS score FROM l WHERE len(lines) >= 1""")
def section_split(spark: SparkSession, folder: str) -> DataFrame:
    found = extract.sections(table(spark, folder, "documents").select("doc_id", "text"), keep=0.3)
    return found.select("doc_id", "header", "footer", F.size("body_lines").cast("long").alias("body_lines"), F.length("section_text").cast("long").alias("n_chars"), F.col("section_score").alias("score"))


@query(f"""WITH l AS (SELECT id, unnest({_LINES('section_text')}) AS line, unnest(range(len({_LINES('section_text')}))) AS record_index FROM personnel_sections),
c AS (SELECT id, record_index, list_filter(regexp_split_to_array(line, '{_B}{{2,}}'), lambda x: {_STRIP('x')} <> '') AS cols FROM l)
SELECT id, CAST(record_index AS INTEGER) AS record_index, CAST(len(cols) AS INTEGER) AS n_columns, array_to_string(cols, '|') AS vals FROM c WHERE len(cols) >= 2""")
def field_extract(spark: SparkSession, folder: str) -> DataFrame:
    found = extract.records(table(spark, folder, "personnel_sections").select("id", "section_text"))
    return found.select("id", "record_index", F.size("raw_fields").alias("n_columns"), F.array_join(F.transform("raw_fields", lambda x: x["value"]), "|").alias("vals"))


@query("""WITH m AS (SELECT item_key, arg_min(canonical_value, ordinal) AS semantic FROM knowledge_items WHERE category = 'layout' GROUP BY 1),
f AS (SELECT layout_id, unnest(raw_fields) AS f FROM raw_records)
SELECT coalesce(semantic, 'unmapped') AS semantic, count(*) AS n, count(DISTINCT f.value) AS n_values FROM f LEFT JOIN m ON item_key = layout_id || '.' || f.name GROUP BY 1""")
def semantic_fields(spark: SparkSession, folder: str) -> DataFrame:
    found = lookup.fields(table(spark, folder, "raw_records"), table(spark, folder, "knowledge_items"))
    return found.groupBy(F.coalesce("semantic", F.lit("unmapped")).alias("semantic")).agg(F.count("*").alias("n"), F.countDistinct("raw").alias("n_values"))


def _typography(spark: SparkSession, folder: str) -> list[tuple[int, str, str]]:
    rows = table(spark, folder, "knowledge_items").where("category = 'typography'").dropDuplicates(["id"]).orderBy("ordinal", "id")
    return [(r.id, r.item_key, r.canonical_value) for r in rows.toLocalIterator()]


@query("""WITH RECURSIVE k AS (SELECT id, item_key, canonical_value, row_number() OVER (ORDER BY ordinal, id) AS n FROM (SELECT DISTINCT * FROM knowledge_items WHERE category = 'typography')),
v AS (SELECT DISTINCT f.value AS raw FROM (SELECT unnest(raw_fields) AS f FROM raw_records) WHERE f.value IS NOT NULL),
s(raw, value, n, ids) AS (SELECT raw, raw, 0, '' FROM v UNION ALL
SELECT s.raw, replace(s.value, k.item_key, k.canonical_value), s.n + 1, CASE WHEN contains(s.value, k.item_key) THEN s.ids || k.id || ',' ELSE s.ids END FROM s JOIN k ON k.n = s.n + 1)
SELECT raw, value, rtrim(ids, ',') AS ids FROM s WHERE n = (SELECT count(*) FROM k) AND ids <> ''""")
def typography_replaced(spark: SparkSession, folder: str) -> DataFrame:
    values = table(spark, folder, "raw_records").select(F.explode("raw_fields").alias("f")).select(F.col("f.value").alias("raw")).distinct()
    t = lookup.typography(F.col("raw"), _typography(spark, folder))
    return values.withColumn("t", t).where("size(t.ids) > 0").select("raw", F.col("t.value").alias("value"), F.concat_ws(",", F.col("t.ids").cast("array<string>")).alias("ids"))


@query()
def normalize_records(spark: SparkSession, folder: str) -> DataFrame:
    """Needs compatibility forms, which SQL here lacks; tested against plain Python."""
    found = lookup.normalize(table(spark, folder, "raw_records"), table(spark, folder, "knowledge_items"), _day(AS_OF))
    return found.select("record_id", "score", "band", F.to_json("normalized_fields").alias("fields"), F.concat_ws(",", F.col("applied").cast("array<string>")).alias("applied"))


@query()
def nfkc_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Values that the compatibility form changes; tested against plain Python."""
    values = table(spark, folder, "raw_records").select(F.explode("raw_fields").alias("f")).select(F.col("f.value").alias("raw")).where(F.col("raw").rlike(r"[^\x00-\x7F]")).distinct()
    return values.withColumn("value", text.nfkc(F.col("raw"))).where("value <> raw")


@query("""WITH m AS (SELECT item_key, arg_min(canonical_value, ordinal) AS semantic FROM knowledge_items WHERE category = 'layout' GROUP BY 1),
f AS (SELECT record_id, semantic, f.value AS v FROM (SELECT record_id, layout_id, unnest(raw_fields) AS f FROM raw_records) LEFT JOIN m ON item_key = layout_id || '.' || f.name),
a AS (SELECT DISTINCT 'rank' AS semantic, canonical_value AS v FROM knowledge_items WHERE category = 'rank'),
g AS (SELECT record_id, count(semantic) AS checkable, count(*) FILTER (semantic = 'rank' AND NOT EXISTS (SELECT 1 FROM a WHERE a.v = f.v)) AS errors, count(*) FILTER (semantic IS NULL) AS warnings FROM f GROUP BY 1)
SELECT record_id, CASE WHEN errors > 0 THEN 'failed' ELSE 'passed' END AS status, CASE WHEN checkable = 0 THEN 0.5 ELSE (checkable - errors)::DOUBLE / checkable END AS score, errors, warnings FROM g""")
def validate_allowed_set(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "knowledge_items")
    allowed = items.where("category = 'rank'").select(F.lit("rank").alias("semantic"), F.col("canonical_value").alias("value"))
    return lookup.validate(lookup.fields(table(spark, folder, "raw_records"), items), allowed)


_IN_FORCE = "(effective_from IS NULL OR effective_from <= DATE '2020-01-01') AND (effective_to IS NULL OR DATE '2020-01-01' < effective_to)"


@query(f"""SELECT category, item_key, id, canonical_value FROM (SELECT *, row_number() OVER (PARTITION BY category, item_key ORDER BY coalesce(effective_from, DATE '0001-01-01') DESC, id DESC) AS n
FROM knowledge_items WHERE {_IN_FORCE}) WHERE n = 1""")
def dictionary_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.newest(lookup.effective(table(spark, folder, "knowledge_items"), _day(AS_OF)), ["category", "item_key"]).select("category", "item_key", "id", "canonical_value")


@query("""WITH k AS (SELECT DISTINCT id, category, item_key, coalesce(effective_from, DATE '0001-01-01') AS s, coalesce(effective_to, DATE '9999-12-31') AS e FROM knowledge_items),
p AS (SELECT b.category, b.item_key, b.id, a.id AS earlier_id, row_number() OVER (PARTITION BY b.id ORDER BY a.e DESC, a.id DESC) AS n FROM k a JOIN k b ON a.category = b.category AND a.item_key = b.item_key AND (a.s, a.id) < (b.s, b.id) AND a.e > b.s WHERE a.s < a.e AND b.s < b.e)
SELECT category, item_key, id, earlier_id FROM p WHERE n = 1""")
def dictionary_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.overlaps(table(spark, folder, "knowledge_items"), ["category", "item_key"])


@query("""WITH k AS (SELECT DISTINCT id, category, item_key, coalesce(effective_from, DATE '0001-01-01') AS s, coalesce(effective_to, DATE '9999-12-31') AS e FROM knowledge_items)
SELECT b.category, b.item_key, b.id, count(*) AS n_earlier FROM k a JOIN k b ON a.category = b.category AND a.item_key = b.item_key AND (a.s, a.id) < (b.s, b.id) AND a.e > b.s WHERE a.s < a.e AND b.s < b.e GROUP BY 1, 2, 3""")
def overlap_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The number of all links of which dictionary_overlaps gives one for each item."""
    return lookup.overlap_counts(table(spark, folder, "knowledge_items"), ["category", "item_key"])


@query("""WITH d AS (SELECT DISTINCT id, category, item_key, canonical_value, created_at FROM knowledge_items),
c AS (SELECT *, lag(canonical_value) OVER w AS was, row_number() OVER w AS n FROM d WINDOW w AS (PARTITION BY category, item_key ORDER BY created_at, id))
SELECT category, item_key, canonical_value, created_at AS effective_from, lead(created_at) OVER (PARTITION BY category, item_key ORDER BY created_at, id) AS effective_to FROM c WHERE n = 1 OR was IS DISTINCT FROM canonical_value""")
def type2_upsert(spark: SparkSession, folder: str) -> DataFrame:
    deliveries = table(spark, folder, "knowledge_items").select("id", "category", "item_key", "canonical_value", "created_at").distinct()
    return versions.type2(deliveries, ["category", "item_key"], ["canonical_value"], F.col("created_at"), [F.col("id")])


_FACTS = "SELECT DISTINCT id, person_key, effective_date, created_at FROM gold_records"
_NUMBERED = f"SELECT *, row_number() OVER (PARTITION BY person_key, effective_date ORDER BY created_at, id) AS version FROM ({_FACTS})"


def _facts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "gold_records").select("id", "person_key", "effective_date", "created_at").distinct()


@query(f"SELECT id, CAST(version AS INTEGER) AS version FROM ({_NUMBERED})")
def next_version(spark: SparkSession, folder: str) -> DataFrame:
    return versions.numbered(_facts(spark, folder), ["person_key", "effective_date"], [F.col("created_at"), F.col("id")]).select("id", "version")


_CHAIN = f"SELECT id, person_key, effective_date, created_at AS valid_from, lead(created_at) OVER w AS valid_to, lead(id) OVER w AS superseded_by, lead(id) OVER w IS NULL AS is_current FROM ({_FACTS}) WINDOW w AS (PARTITION BY person_key, effective_date ORDER BY created_at, id)"


def _chain(spark: SparkSession, folder: str) -> DataFrame:
    return versions.chained(_facts(spark, folder).withColumnRenamed("created_at", "valid_from"), ["person_key", "effective_date"], [F.col("valid_from"), F.col("id")])


@query(f"SELECT id, valid_from, valid_to, superseded_by, is_current FROM ({_CHAIN})")
def scd2_history(spark: SparkSession, folder: str) -> DataFrame:
    return _chain(spark, folder).select("id", "valid_from", "valid_to", "superseded_by", "is_current")


@query(f"SELECT id, person_key FROM ({_CHAIN}) WHERE valid_from <= TIMESTAMP '2020-01-01' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2020-01-01')")
def scd2_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return versions.snapshot(_chain(spark, folder), _at(AS_OF)).select("id", "person_key")


@query("SELECT id, person_key FROM gold_records WHERE valid_from <= TIMESTAMP '2020-01-01' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2020-01-01')")
def gold_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return versions.snapshot(table(spark, folder, "gold_records"), _at(AS_OF)).select("id", "person_key")


@query("""SELECT pdf_id, section_index, id FROM (SELECT *, row_number() OVER (PARTITION BY pdf_id, section_index ORDER BY created_at DESC, id DESC) AS n FROM personnel_sections) WHERE n = 1""")
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "personnel_sections").select("pdf_id", "section_index", "id", "created_at")
    return versions.latest(rows, ["pdf_id", "section_index"], [F.desc("created_at"), F.desc("id")]).drop("created_at")


@query("SELECT DISTINCT id, started_at, status FROM jobs ORDER BY started_at DESC, id DESC LIMIT 10")
def top_recent(spark: SparkSession, folder: str) -> DataFrame:
    """A report of the last ten."""
    return table(spark, folder, "jobs").select("id", "started_at", "status").distinct().orderBy(F.desc("started_at"), F.desc("id")).limit(10)


def _sections(spark: SparkSession, folder: str) -> DataFrame:
    released = table(spark, folder, "parser_versions").select(F.col("id").alias("parser_version_id"), "released_at")
    return table(spark, folder, "personnel_sections").drop("section_text", "page_range").join(broadcast_if_small(released), "parser_version_id")


_PLACE = ["pdf_id", "section_index"]


@query("""SELECT id, CASE WHEN row_number() OVER (PARTITION BY pdf_id, section_index ORDER BY released_at DESC, s.id DESC) = 1 THEN 'parsed' ELSE 'superseded' END AS new_status
FROM (SELECT s.*, v.released_at FROM personnel_sections s JOIN parser_versions v ON v.id = s.parser_version_id) s""")
def supersede_active(spark: SparkSession, folder: str) -> DataFrame:
    return versions.supersede(_sections(spark, folder), _PLACE, [F.desc("released_at"), F.desc("id")]).select("id", "new_status")


@query("SELECT min(doc_id) AS doc_id, sha256(coalesce(text, '')) AS content_hash FROM documents GROUP BY 2")
def dedupe_by_hash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_hash"))
    return docs.groupBy("content_hash").agg(F.min("doc_id").alias("doc_id"))


@query("""SELECT min(id) AS id, content_hash FROM pdfs WHERE status <> 'fetched' OR content_hash NOT IN (SELECT content_hash FROM pdfs WHERE status <> 'fetched') GROUP BY content_hash HAVING count(*) FILTER (status <> 'fetched') = 0""")
def unseen_files(spark: SparkSession, folder: str) -> DataFrame:
    """Fetched files of which no copy was worked on, one for each content."""
    pdfs = table(spark, folder, "pdfs")
    known = pdfs.where("status <> 'fetched'").select(F.col("content_hash").alias("key"))
    return versions.unseen(pdfs.where("status = 'fetched'"), known, F.col("content_hash"), [F.col("id")]).select("id", "content_hash")


@query("""WITH f AS (SELECT DISTINCT candidate_record_id FROM gold_records),
s AS (SELECT section_ref, count(*) AS n_records, count(*) FILTER (f.candidate_record_id IS NULL) AS n_pending FROM raw_records r LEFT JOIN f ON f.candidate_record_id = r.record_id WHERE section_ref IS NOT NULL GROUP BY 1)
SELECT id AS section, coalesce(n_records, 0) AS n_records, coalesce(n_pending, 0) AS n_pending, CASE WHEN coalesce(n_records, 0) = 0 THEN 'extract' WHEN n_pending = 0 THEN 'skip' ELSE 'rerun' END AS action
FROM personnel_sections LEFT JOIN s ON section_ref = id""")
def resume_classify(spark: SparkSession, folder: str) -> DataFrame:
    """A record is final once a gold row was made of it."""
    done = table(spark, folder, "gold_records").select(F.col("candidate_record_id").alias("record_id")).distinct().withColumn("final", F.lit(True))
    records = table(spark, folder, "raw_records").select("record_id", "section_ref").join(done, "record_id", "left").withColumn("final", F.coalesce("final", F.lit(False)))
    return resume.classify(table(spark, folder, "personnel_sections").select("id"), records)


@query("""WITH j AS (SELECT DISTINCT * FROM jobs WHERE pdf_id IS NOT NULL)
SELECT pdf_id, sum(processed_count)::BIGINT AS processed, sum(failed_count)::BIGINT AS failed, arg_min(error_summary, (started_at, id)) FILTER (error_summary IS NOT NULL) AS first_error, CASE WHEN sum(failed_count) > 0 THEN 'failed' ELSE 'validated' END AS status FROM j GROUP BY 1""")
def outcome_fold(spark: SparkSession, folder: str) -> DataFrame:
    return resume.outcome(table(spark, folder, "jobs").where("pdf_id is not null").distinct(), ["pdf_id"], "processed_count", "failed_count", "error_summary", ["started_at", "id"])


# --- integrity checks -------------------------------------------------------------------------------------------------


@query("SELECT pdf_id, section_index, count(*) AS n FROM personnel_sections WHERE status = 'parsed' GROUP BY 1, 2 HAVING count(*) > 1")
def audit_dup_active(spark: SparkSession, folder: str) -> DataFrame:
    return audit.duplicated(table(spark, folder, "personnel_sections").where("status = 'parsed'"), _PLACE)


@query("""WITH s AS (SELECT s.id, pdf_id, section_index, status, released_at FROM personnel_sections s JOIN parser_versions v ON v.id = parser_version_id)
SELECT a.id AS id_active, arg_max(b.id, (b.released_at, b.id)) AS id_newer FROM s a JOIN s b USING (pdf_id, section_index) WHERE a.status = 'parsed' AND b.status <> 'parsed' AND b.released_at > a.released_at GROUP BY a.id""")
def audit_newer_superseded(spark: SparkSession, folder: str) -> DataFrame:
    return audit.newer_not_active(_sections(spark, folder), _PLACE, F.col("status") == "parsed", "released_at")


@query("""WITH s AS (SELECT s.id, pdf_id, section_index, status, released_at FROM personnel_sections s JOIN parser_versions v ON v.id = parser_version_id)
SELECT a.id AS id_active, count(*) AS n_newer FROM s a JOIN s b USING (pdf_id, section_index) WHERE a.status = 'parsed' AND b.status <> 'parsed' AND b.released_at > a.released_at GROUP BY a.id""")
def newer_superseded_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The number of all newer rows of which audit_newer_superseded gives the one released last."""
    return audit.newer_counts(_sections(spark, folder), _PLACE, F.col("status") == "parsed", "released_at")


@query("SELECT id FROM personnel_sections s WHERE status = 'superseded' AND NOT EXISTS (SELECT 1 FROM personnel_sections p WHERE p.pdf_id = s.pdf_id AND p.section_index = s.section_index AND p.status = 'parsed')")
def audit_orphan_superseded(spark: SparkSession, folder: str) -> DataFrame:
    return audit.without_sibling(table(spark, folder, "personnel_sections"), _PLACE, F.col("status") == "superseded", F.col("status") == "parsed").select("id")


def _dangling(spark: SparkSession, folder: str, child: str, key: str, column: str, parent: str, parent_key: str = "id") -> DataFrame:
    found = audit.dangling(table(spark, folder, child).select(F.col(key).alias("row_id"), column).distinct(), column, table(spark, folder, parent).select(parent_key), parent_key)
    return found.select(F.lit(f"{child}.{column}").alias("reference"), "row_id", F.col(column).cast("long").alias("missing"))


def _dangling_sql(child: str, key: str, column: str, parent: str, parent_key: str = "id") -> str:
    return f"SELECT DISTINCT '{child}.{column}' AS reference, {key} AS row_id, {column} AS missing FROM {child} c WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{column})"


#: Every foreign key of the tables: referring table, its key, column, referenced table and key.
FOREIGN_KEYS = [
    ("personnel_sections", "id", "pdf_id", "pdfs", "id"), ("personnel_sections", "id", "layout_id", "layouts", "id"), ("personnel_sections", "id", "parser_version_id", "parser_versions", "id"),
    ("raw_records", "record_id", "section_ref", "personnel_sections", "id"), ("gold_records", "id", "candidate_record_id", "raw_records", "record_id"), ("gold_records", "id", "superseded_by", "gold_records", "id"),
    ("jobs", "id", "pdf_id", "pdfs", "id"), ("jobs", "id", "parser_version_id", "parser_versions", "id"),
]


def _all(spark: SparkSession, folder: str, keys: list) -> DataFrame:
    out = _dangling(spark, folder, *keys[0])
    for key in keys[1:]:
        out = out.unionByName(_dangling(spark, folder, *key))
    return out


@query(" UNION ALL ".join(_dangling_sql(*k) for k in FOREIGN_KEYS[:3]))
def audit_section_parents(spark: SparkSession, folder: str) -> DataFrame:
    return _all(spark, folder, FOREIGN_KEYS[:3])


@query(_dangling_sql(*FOREIGN_KEYS[3]))
def audit_record_parent(spark: SparkSession, folder: str) -> DataFrame:
    return _all(spark, folder, FOREIGN_KEYS[3:4])


@query("""SELECT r.record_id, s.id AS section FROM raw_records r JOIN personnel_sections s ON s.id = r.section_ref WHERE s.status = 'superseded' AND NOT EXISTS (SELECT 1 FROM gold_records g WHERE g.candidate_record_id = r.record_id)""")
def audit_pending_under_superseded(spark: SparkSession, folder: str) -> DataFrame:
    records = table(spark, folder, "raw_records").select("record_id", "section_ref")
    pending = records.join(table(spark, folder, "gold_records").select(F.col("candidate_record_id").alias("record_id")), "record_id", "left_anti")
    return audit.mismatched(pending, "section_ref", table(spark, folder, "personnel_sections").select("id", "status"), "id", F.col("status") == "superseded").select("record_id", F.col("id").alias("section"))


@query("""SELECT r.record_id, r.layout_id AS era_id, l.era_id AS section_era FROM raw_records r JOIN personnel_sections s ON s.id = r.section_ref JOIN layouts l ON l.id = s.layout_id WHERE l.era_id <> r.layout_id""")
def audit_lineage_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    eras = table(spark, folder, "layouts").select(F.col("id").alias("layout"), F.col("era_id").alias("section_era"))
    sections = table(spark, folder, "personnel_sections").select("id", F.col("layout_id").alias("layout")).join(broadcast_if_small(eras), "layout")
    records = table(spark, folder, "raw_records").select("record_id", "section_ref", F.col("layout_id").alias("era_id"))
    return audit.mismatched(records, "section_ref", sections, "id", F.col("section_era") != F.col("era_id")).select("record_id", "era_id", "section_era")


@query("SELECT DISTINCT id, started_at FROM jobs WHERE status = 'running' AND started_at < TIMESTAMP '2026-01-01' - INTERVAL 24 HOUR")
def audit_stale_running(spark: SparkSession, folder: str) -> DataFrame:
    return audit.stale(table(spark, folder, "jobs"), _at(NOW)).select("id", "started_at").distinct()


@query("SELECT DISTINCT id, status FROM jobs WHERE (status = 'running') = (finished_at IS NOT NULL)")
def audit_status_contradiction(spark: SparkSession, folder: str) -> DataFrame:
    return audit.contradictory(table(spark, folder, "jobs")).select("id", "status").distinct()


@query(" UNION ALL ".join(_dangling_sql(*k) for k in FOREIGN_KEYS[6:]))
def audit_job_parents(spark: SparkSession, folder: str) -> DataFrame:
    return _all(spark, folder, FOREIGN_KEYS[6:])


@query("SELECT person_key, effective_date, count(*) AS n FROM gold_records WHERE is_current = 1 GROUP BY 1, 2 HAVING count(*) > 1")
def audit_dup_current(spark: SparkSession, folder: str) -> DataFrame:
    return audit.duplicated(table(spark, folder, "gold_records").where("is_current = 1"), ["person_key", "effective_date"])


@query("""WITH RECURSIVE g AS (SELECT e.id, p.id AS nxt FROM gold_records e LEFT JOIN gold_records p ON p.id = e.superseded_by),
w(id, cur, path, looped) AS (SELECT id, id, [id], false FROM g UNION ALL SELECT w.id, g.nxt, list_append(w.path, g.nxt), list_contains(w.path, g.nxt) FROM w JOIN g ON g.id = w.cur WHERE g.nxt IS NOT NULL AND NOT w.looped)
SELECT DISTINCT id, list_min(path[list_position(path, cur):]) AS loop_id FROM w WHERE looped""")
def audit_cycle(spark: SparkSession, folder: str) -> DataFrame:
    return audit.cycles(table(spark, folder, "gold_records"), "id", "superseded_by")


@query(_dangling_sql(*FOREIGN_KEYS[5]))
def audit_dangling_successor(spark: SparkSession, folder: str) -> DataFrame:
    return _all(spark, folder, FOREIGN_KEYS[5:6])


@query("""SELECT table_name, row_id FROM deleted_rows d WHERE NOT EXISTS (SELECT 1 FROM pdfs WHERE table_name = 'pdfs' AND id = row_id) AND NOT EXISTS (SELECT 1 FROM layouts WHERE table_name = 'layouts' AND id = row_id) AND NOT EXISTS (SELECT 1 FROM parser_versions WHERE table_name = 'parser_versions' AND id = row_id)""")
def audit_polymorphic_ref(spark: SparkSession, folder: str) -> DataFrame:
    """The log of deletions names table and row: those that are gone."""
    parents = {name: table(spark, folder, name).select("id") for name in ("pdfs", "layouts", "parser_versions")}
    return audit.dangling_by_kind(table(spark, folder, "deleted_rows").select("table_name", "row_id"), "table_name", "row_id", parents)


@query(" UNION ALL ".join(_dangling_sql(*k) for k in FOREIGN_KEYS))
def audit_every_reference(spark: SparkSession, folder: str) -> DataFrame:
    return _all(spark, folder, FOREIGN_KEYS)


#: check, severity and query of the audit.
CHECKS = [(q, "warning" if q in ("audit_newer_superseded", "audit_pending_under_superseded", "audit_stale_running") else "error") for q in list(QUERIES) if q.startswith("audit_")]


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    out = None
    for name, severity in CHECKS:
        one = QUERIES[name](spark, folder).agg(F.count("*").alias("n")).select(F.lit(name).alias("check_id"), F.lit(severity).alias("severity"), "n")
        out = one if out is None else out.unionByName(one)
    return out


_COUNTS = " UNION ALL ".join(f"SELECT '{name}' AS check_id, '{severity}' AS severity, (SELECT count(*) FROM ({ORACLES[name]})) AS n" for name, severity in CHECKS)


@query(_COUNTS)
def audit_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _counts(spark, folder)


@query(f"SELECT sum(n)::BIGINT AS findings, CAST(max(CASE WHEN n = 0 THEN 0 WHEN severity = 'error' THEN 2 ELSE 1 END) AS INTEGER) AS exit_code FROM ({_COUNTS})")
def audit_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return audit.rollup(_counts(spark, folder))


# --- features, checksums, exports -----------------------------------------------------------------------------------


@query(f"""SELECT record_id, CASE WHEN len(raw_fields) > 0 THEN len(list_filter(raw_fields, lambda f: f.value IS NOT NULL AND {_STRIP('f.value')} <> ''))::DOUBLE / len(raw_fields) ELSE 0 END AS fill_rate,
CASE WHEN len(raw_fields) > 0 THEN len(list_filter(raw_fields, lambda f: coalesce(contains(f.value, chr(65533)), false)))::DOUBLE / len(raw_fields) ELSE 0 END AS suspicious_rate FROM raw_records""")
def feature_vector(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "raw_records").select("record_id", features.fill_rate(F.col("raw_fields")).alias("fill_rate"), features.suspicious_rate(F.col("raw_fields")).alias("suspicious_rate"))


_PARTS = ["name", "rank", "organization", "position"]


@query("""SELECT id, CASE WHEN n > 0 THEN changed::DOUBLE / n ELSE 0 END AS change_rate FROM (SELECT id, """ + " + ".join(f"(json_extract(fields, '$.{p}.value') IS NOT NULL)::INT" for p in _PARTS) + " AS n, " + " + ".join(f"(json_extract(fields, '$.{p}.value') IS NOT NULL AND json_extract_string(fields, '$.{p}.value') IS DISTINCT FROM json_extract_string(fields, '$.{p}.raw'))::INT" for p in _PARTS) + " AS changed FROM gold_records)")
def change_rate(spark: SparkSession, folder: str) -> DataFrame:
    part = "struct<value:string,raw:string>"
    parsed = F.from_json("fields", ", ".join(f"{p} {part}" for p in _PARTS))
    present = F.filter(F.array(*(parsed[p] for p in _PARTS)), lambda f: f.isNotNull())
    # a field that is there with a null value counts in SQL too: its value is JSON null
    return table(spark, folder, "gold_records").select("id", features.change_rate(present).alias("change_rate"))


@query("""SELECT record_id, CAST(('0x' || substr(sha256(layout_id || ':' || coalesce(section_ref::VARCHAR, '-') || ':' || record_index), 1, 16))::UBIGINT & 9223372036854775807::UBIGINT AS BIGINT) AS subject_ref FROM raw_records""")
def subject_ref_hash(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "raw_records").select("record_id", features.subject_ref(F.col("layout_id"), F.col("section_ref"), F.col("record_index")).alias("subject_ref"))


@query("SELECT DISTINCT id, sha256(category || ':' || source_file || ':' || item_key || ':' || canonical_value) AS checksum FROM knowledge_items")
def item_checksums(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "knowledge_items").select("id", features.checksum(*(F.col(c) for c in ("category", "source_file", "item_key", "canonical_value"))).alias("checksum")).distinct()


def _part(name: str, what: str) -> str:
    return f"json_extract_string(fields, '$.{name}.{what}')"


_FLAT = "SELECT printf('gold-%08d', id) AS id, person_key AS person_value, " + f"{_part('name', 'raw')} AS person_raw, " + ", ".join(f"{_part(n, w)} AS {n}_{w}" for n in _PARTS[1:] for w in ("value", "raw")) + """, appointment_type, strftime(effective_date, '%Y-%m-%d') AS effective_date, version::BIGINT AS version, is_current = 1 AS is_current,
CASE WHEN superseded_by IS NOT NULL THEN printf('gold-%08d', superseded_by) END AS superseded_by, NULL::VARCHAR AS source_pdf_content_hash, NULL::VARCHAR AS source_pdf_source_url, NULL::VARCHAR AS source_pdf_published_date, NULL::VARCHAR AS parser_version, NULL::VARCHAR AS layout_era_id,
1.0::DOUBLE AS confidence_score, 'verified' AS confidence_band FROM gold_records"""


@query(_FLAT)
def export_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return export.flatten(table(spark, folder, "gold_records"))


_SUMS = ", ".join(f"sum(('0x' || substr(h, {1 + 15 * i}, 15))::BIGINT)::DECIMAL(38,0)::VARCHAR AS s{i}" for i in range(4))


def _hash_sql(columns: list[str], rows: str) -> str:
    text = ", ".join(f"coalesce(replace(replace({c}::VARCHAR, chr(92), chr(92) || chr(92)), '|', chr(92) || '|'), chr(92) || 'N')" for c in sorted(columns))
    return f"SELECT n, sha256(n || ':' || s0 || ':' || s1 || ':' || s2 || ':' || s3) AS content_hash FROM (SELECT count(*) AS n, {_SUMS} FROM (SELECT sha256(concat_ws('|', {text})) AS h FROM ({rows})))"


@query(_hash_sql(export.COLUMNS, _FLAT))
def export_content_hash(spark: SparkSession, folder: str) -> DataFrame:
    return export.content_hash(export.flatten(table(spark, folder, "gold_records")))


# --- operations ---------------------------------------------------------------------------------------------------------


@query("SELECT DISTINCT id, (epoch_us(finished_at) - epoch_us(started_at)) / 1000 AS elapsed_ms FROM jobs WHERE finished_at IS NOT NULL")
def job_durations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "jobs").where("finished_at is not null").select("id", metrics.elapsed_ms(F.col("started_at"), F.col("finished_at")).alias("elapsed_ms")).distinct()


@query("""SELECT job_type, count(*) FILTER (status <> 'running') AS n_ended, CASE WHEN count(*) FILTER (status <> 'running') > 0 THEN count(*) FILTER (status = 'succeeded')::DOUBLE / count(*) FILTER (status <> 'running') END AS success_rate FROM (SELECT DISTINCT * FROM jobs) GROUP BY 1""")
def sli_success(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.success_rate(table(spark, folder, "jobs").distinct(), ["job_type"])


@query("""SELECT status, count(v) AS n, quantile_cont(v, 0.5) AS median_h, quantile_cont(v, 0.95) AS p95_h FROM (SELECT status, (epoch_us(updated_at) - epoch_us(fetched_at)) / 3.6e9 AS v FROM pdfs) GROUP BY 1""")
def sli_freshness(spark: SparkSession, folder: str) -> DataFrame:
    hours = (F.unix_micros(F.to_timestamp("updated_at")) - F.unix_micros(F.to_timestamp("fetched_at"))) / 3.6e9
    return metrics.quantiles(table(spark, folder, "pdfs"), ["status"], hours, {"median_h": 0.5, "p95_h": 0.95})


@query("""WITH c AS (SELECT date_trunc('month', created_at)::DATE AS period, count(*) AS n FROM gold_records WHERE created_at IS NOT NULL GROUP BY 1)
SELECT period, n, (n - lag(n) OVER (ORDER BY period))::DOUBLE / lag(n) OVER (ORDER BY period) AS change FROM c""")
def growth_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.growth(table(spark, folder, "gold_records"), "created_at")


@query("""SELECT DISTINCT id, TIMESTAMP '2010-01-01' + to_seconds(greatest(0, ceil((floor(epoch_us(started_at) / 1e6) - epoch(TIMESTAMP '2010-01-01')) / 604800))::BIGINT * 604800) AS next_run FROM jobs""")
def next_run_at(spark: SparkSession, folder: str) -> DataFrame:
    run = metrics.next_run(F.col("started_at"), F.lit("2010-01-01 00:00:00").cast("timestamp_ntz"), 7 * 86400)
    return table(spark, folder, "jobs").select("id", run.cast("timestamp_ntz").alias("next_run")).distinct()


@query(f"""WITH l AS (SELECT source, lang, len({_LINES('text')}) AS k FROM documents), s AS (SELECT source, lang, CASE WHEN k = 0 THEN 0.0 WHEN k < 3 THEN 0.3 ELSE 1.0 END AS score FROM l)
SELECT source, lang, count(*) AS n, count(*) FILTER (score >= 0.5) AS n_passed, CAST(grouping(source) * 2 + grouping(lang) AS BIGINT) AS level FROM s GROUP BY ROLLUP (source, lang)""")
def benchmark_eval(spark: SparkSession, folder: str) -> DataFrame:
    """Share of texts with a body by source and language, with totals."""
    scored = table(spark, folder, "documents").select("source", "lang", scoring.section_score(text.lines(F.col("text"))).alias("score"))
    return scored.rollup("source", "lang").agg(F.count("*").alias("n"), F.count_if(F.col("score") >= 0.5).alias("n_passed"), F.grouping_id().alias("level"))


@query("""WITH m AS (SELECT item_key, arg_min(canonical_value, ordinal) AS semantic FROM knowledge_items WHERE category = 'layout' GROUP BY 1),
v AS (SELECT section_ref, f.value AS v FROM (SELECT section_ref, layout_id, unnest(raw_fields) AS f FROM raw_records) JOIN m ON item_key = layout_id || '.' || f.name AND semantic = 'organization'),
k AS (SELECT DISTINCT item_key FROM knowledge_items WHERE category IN ('organization', 'alias'))
SELECT v AS spelling, count(DISTINCT pdf_id) AS n_pdfs FROM v JOIN personnel_sections s ON s.id = v.section_ref WHERE v IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k WHERE k.item_key = v.v) GROUP BY 1 HAVING count(DISTINCT pdf_id) >= 2""")
def reproposal_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """Organisations that the dictionary does not know and at least two notices hold."""
    items = table(spark, folder, "knowledge_items")
    records = table(spark, folder, "raw_records").select("record_id", "section_ref", "layout_id", "raw_fields")
    found = lookup.fields(records.withColumn("record_id", F.col("section_ref")), items).where("semantic = 'organization' and raw is not null")
    known = items.where("category in ('organization', 'alias')").select(F.col("item_key").alias("raw")).distinct()
    new = found.join(broadcast_if_small(known), "raw", "left_anti")
    return new.join(table(spark, folder, "personnel_sections").select(F.col("id").alias("record_id"), "pdf_id"), "record_id").groupBy(F.col("raw").alias("spelling")).agg(F.countDistinct("pdf_id").alias("n_pdfs")).where("n_pdfs >= 2")


@query("""WITH e AS (SELECT DISTINCT id, 'started' AS kind, started_at AS t FROM jobs UNION ALL SELECT DISTINCT id, 'ended', finished_at FROM jobs WHERE finished_at IS NOT NULL),
l AS (SELECT *, lag(kind) OVER w AS was, lag(t) OVER w AS begun FROM e WINDOW w AS (PARTITION BY id ORDER BY t, kind = 'ended'))
SELECT id, (epoch_us(t) - epoch_us(begun)) / 1000 AS elapsed_ms FROM l WHERE kind = 'ended' AND was = 'started'""")
def stage_durations(spark: SparkSession, folder: str) -> DataFrame:
    """From an event log of starts and ends."""
    jobs = table(spark, folder, "jobs").select("id", "started_at", "finished_at").distinct()
    events = jobs.select("id", F.explode(F.array(F.struct(F.lit("started").alias("kind"), F.col("started_at").alias("t")), F.struct(F.lit("ended").alias("kind"), F.col("finished_at").alias("t")))).alias("e")).select("id", "e.*").where("t is not null")
    return metrics.paired_durations(events, ["id"], "kind", "t", "started", "ended")


@query("""SELECT job_type, max(started_at) AS last_start, max(finished_at) FILTER (status = 'succeeded') AS last_success, (epoch_us(TIMESTAMP '2026-01-01') - epoch_us(max(finished_at) FILTER (status = 'succeeded'))) / 1000 / 3.6e6 AS hours_since FROM jobs GROUP BY 1""")
def health_checks(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.health(table(spark, folder, "jobs"), ["job_type"], _at(NOW))


@query("""SELECT code_version, status, count(*) AS n, count(DISTINCT error_summary) AS n_errors FROM (SELECT DISTINCT * FROM jobs) j LEFT JOIN parser_versions v ON v.id = j.parser_version_id GROUP BY 1, 2""")
def analytics_version_status(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "parser_versions").select(F.col("id").alias("parser_version_id"), "code_version")
    jobs = table(spark, folder, "jobs").distinct().join(broadcast_if_small(known), "parser_version_id", "left")
    return jobs.groupBy("code_version", "status").agg(F.count("*").alias("n"), F.countDistinct("error_summary").alias("n_errors"))


@query("""SELECT l.era_id, s.status, count(*) AS n, count(DISTINCT s.pdf_id) AS n_pdfs FROM raw_records r JOIN personnel_sections s ON s.id = r.section_ref JOIN layouts l ON l.id = s.layout_id GROUP BY 1, 2""")
def records_by_layout(spark: SparkSession, folder: str) -> DataFrame:
    eras = table(spark, folder, "layouts").select(F.col("id").alias("layout_id"), "era_id")
    sections = table(spark, folder, "personnel_sections").select(F.col("id").alias("section_ref"), "layout_id", "status", "pdf_id").join(broadcast_if_small(eras), "layout_id")
    return table(spark, folder, "raw_records").select("section_ref").join(sections, "section_ref").groupBy("era_id", "status").agg(F.count("*").alias("n"), F.countDistinct("pdf_id").alias("n_pdfs"))


@query("""SELECT id, substr(content_hash, 1, 2) || '/' || substr(content_hash, 3, 2) || '/' || content_hash || '.pdf' AS stored_as, regexp_extract(source_url, '^([a-z]+):', 1) IN ('http', 'https') AS allowed FROM pdfs""")
def storage_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Where a file belongs by its content, and whether its address may be fetched."""
    h = F.col("content_hash")
    return table(spark, folder, "pdfs").select("id", F.concat(F.substring(h, 1, 2), F.lit("/"), F.substring(h, 3, 2), F.lit("/"), h, F.lit(".pdf")).alias("stored_as"), F.coalesce(F.parse_url("source_url", F.lit("PROTOCOL")).isin("http", "https"), F.lit(False)).alias("allowed"))


@query(f"""SELECT count(*) AS n, sha256(coalesce(string_agg(source_file || chr(0) || category || chr(0) || item_key || chr(0) || canonical_value || chr(0) || version || chr(0), '' ORDER BY ordinal, id), '')) AS checksum
FROM (SELECT DISTINCT id, source_file, category, item_key, canonical_value, version, ordinal FROM knowledge_items WHERE {_IN_FORCE})""")
def snapshot_checksum(spark: SparkSession, folder: str) -> DataFrame:
    """One checksum of the dictionary in force, in its order."""
    items = lookup.effective(table(spark, folder, "knowledge_items"), _day(AS_OF))
    columns = ("source_file", "category", "item_key", "canonical_value", "version")
    rows = items.select("id", "ordinal", *columns).distinct()
    return features.sequence_checksum(rows, [F.col(c).cast("string") for c in columns], ["ordinal", "id"])


@query("""SELECT event_type, time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS start, count(*) AS n FROM events GROUP BY 1, 2""")
def windowed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The counts that streaming.ingest.counts makes of a stream, over all that is there."""
    return table(spark, folder, "events").groupBy(F.window("ts", "7 days").alias("w"), "event_type").agg(F.count("*").alias("n")).select("event_type", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT DISTINCT sha256(coalesce(text, '')) AS content_hash FROM documents")
def stream_equals_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Documents taken from a stream once for each content; SQL does the same in one go."""
    path = f"{folder.rstrip('/')}/documents.parquet"
    scratch = Scratch(spark)
    # a pattern, since a stream's path may not be a single file
    stream = ingest.arrivals(spark, f"{path[:-1]}[t]", spark.read.parquet(path).schema)
    timed = stream.withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
    ingest.drain(ingest.first_seen(timed, "text", "ingested_at", "3650 days").select("content_hash"), f"{scratch.folder}/stream", f"{scratch.folder}/progress")
    return spark.read.parquet(f"{scratch.folder}/stream")
