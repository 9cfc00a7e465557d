"""Queries of documents, layouts, life cycles, features, exports and operations over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import documents, extract, features, layout, lifecycle, lookup, metrics, versions
from ..runtime import Scratch, broadcast_if_small
from ..sinks import export as sink
from ..sources.files import LARGE
from ..sources.tables import table
from ..streaming import ingest
from . import reference as base

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return keep


# --- documents and layouts ----------------------------------------------------------------------------------------------

_TESTS = {"header_pattern": "coalesce(contains(header, '{}'), false)", "footer_pattern": "coalesce(contains(footer, '{}'), false)", "min_page_count": "page_count >= {}"}


def _candidate_sql(ordinal: int, name: str, rules: list) -> str:
    listed = lambda want: "concat_ws(',', " + ", ".join(f"CASE WHEN ({_TESTS[k].format(v)}) = {want} THEN '{i}' END" for i, k, v, _ in rules) + ")"
    return f"SELECT doc_id, {ordinal} AS ordinal, '{name}' AS layout_id, {base._score_sql(rules)} AS score, {listed('true')} AS matched, {listed('false')} AS failed FROM ev"


@query(base._EVIDENCE + f", c AS ({' UNION ALL '.join(_candidate_sql(*m) for m in base.MANIFEST)}) SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ordinal) AS INTEGER) AS place, layout_id, score, matched, failed FROM c")
def layout_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every layout for every document with the rules that matched and failed."""
    found = layout.candidates(layout.evidence(base._pages(spark, folder)), base._manifest(spark))
    return found.withColumns({c: F.concat_ws(",", c) for c in ("matched", "failed")})


@query(f"""WITH p AS (SELECT pdf_id AS doc_id, section_index, id, {base._LINES('section_text')} AS lines, (section_index % 4) * 90 AS rotation FROM personnel_sections WHERE status = 'parsed'),
w AS (SELECT *, coalesce(list_max(list_transform(lines, lambda l: length(l))), 0) AS width, len(lines) AS height FROM p),
r AS (SELECT doc_id, rotation, count(*) AS n, min((section_index, id)) AS first FROM w GROUP BY 1, 2),
m AS (SELECT doc_id, rotation, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS k FROM r)
SELECT w.doc_id, count(*) AS page_count, avg(width) AS mean_width, avg(height) AS mean_height, count(*) FILTER (w.rotation <> 0) AS rotated_pages, CAST(any_value(m.rotation) AS INTEGER) AS dominant_rotation, '' AS fonts FROM w JOIN m ON m.doc_id = w.doc_id AND m.k = 1 GROUP BY 1""")
def page_features(spark: SparkSession, folder: str) -> DataFrame:
    """Sections in order stand for pages: as wide as their longest line, as high as their lines, every next one turned by a
    quarter; the tables hold no fonts."""
    lines = text.lines(F.col("section_text"))
    sections = table(spark, folder, "personnel_sections").where("status = 'parsed'")
    width = F.coalesce(F.array_max(F.transform(lines, lambda x: F.length(x))), F.lit(0))
    pages = sections.select(F.col("pdf_id").alias("doc_id"), (F.col("section_index") * 1_000_000_000_000 + F.col("id")).alias("page_index"), width.alias("width"), F.size(lines).alias("height"), ((F.col("section_index") % 4) * 90).alias("rotation"), F.array().cast("array<string>").alias("fonts"))
    return layout.page_features(pages).withColumn("fonts", F.concat_ws(",", "fonts"))


@query(f"""WITH s AS (SELECT pdf_id, count(*) AS page_count, sum(length(coalesce(section_text, ''))) AS text_length FROM personnel_sections WHERE status = 'parsed' GROUP BY 1),
d AS (SELECT p.id AS doc_id, coalesce(page_count, 0) AS page_count, CAST(coalesce(text_length, 0) AS BIGINT) AS text_length, file_size_bytes > {LARGE} AS large, status = 'failed' AS broken FROM pdfs p LEFT JOIN s ON s.pdf_id = p.id),
w AS (SELECT *, NOT broken AND page_count > 0 AND text_length = 0 AS images FROM d)
SELECT doc_id, page_count, text_length, concat_ws(',', CASE WHEN broken THEN 'BROKEN' END, CASE WHEN images THEN 'IMAGE_ONLY' END, CASE WHEN large THEN 'LARGE_FILE' END) AS warnings,
CASE WHEN broken THEN 0.0 WHEN images OR large THEN 0.6 ELSE 1.0 END::DOUBLE AS score, CASE WHEN broken THEN 'low' WHEN images OR large THEN 'medium' ELSE 'verified' END AS band FROM w""")
def document_analysis(spark: SparkSession, folder: str) -> DataFrame:
    """Files with their pages' totals, warnings and confidence; failed files count as broken."""
    pdfs = table(spark, folder, "pdfs").select(F.col("id").alias("doc_id"), F.col("file_size_bytes").alias("size"), F.lit("1.4").alias("version"), F.lit(False).alias("encrypted"), (F.col("status") == "failed").alias("broken"))
    sections = table(spark, folder, "personnel_sections").where("status = 'parsed'")
    pages = sections.select(F.col("pdf_id").alias("doc_id"), F.coalesce("section_text", F.lit("")).alias("text"), F.lit(0).alias("rotation"), F.lit(0).alias("image_count"))
    return documents.analysed(pdfs, pages).select("doc_id", "page_count", "text_length", F.concat_ws(",", "warnings").alias("warnings"), "score", "band")


@query(base._DETECT + f""", s AS (SELECT pdf_id AS doc_id, id, section_index, {base._LINES('section_text')} AS lines FROM personnel_sections WHERE status = 'parsed')
SELECT s.id, d.layout_id, lines[1] AS section_label, '[' || section_index || ',' || section_index || ']' AS page_range, length(array_to_string(lines, chr(10))) AS n_chars FROM s JOIN d USING (doc_id) WHERE d.layout_id IS NOT NULL AND len(lines) >= 3""")
def section_records(spark: SparkSession, folder: str) -> DataFrame:
    sections = table(spark, folder, "personnel_sections").where("status = 'parsed'").select("id", F.col("pdf_id").alias("doc_id"), F.col("section_index").alias("page_index"), F.col("section_text").alias("text"))
    found = extract.section_records(extract.sections(sections), base._detected(spark, folder))
    return found.select("id", "layout_id", "section_label", "page_range", F.length("section_text").cast("long").alias("n_chars"))


@query(f"""WITH s AS (SELECT pdf_id, len({base._LINES('section_text')}) AS k FROM personnel_sections),
g AS (SELECT pdf_id, sum(CASE WHEN k = 0 THEN 0 WHEN k < 3 THEN 3 ELSE 10 END)::DOUBLE / (10 * count(*)) AS score FROM s GROUP BY 1)
SELECT p.id AS pdf_id, coalesce(score, 0.0) AS score, {base._BAND('coalesce(score, 0.0)')} AS band FROM pdfs p LEFT JOIN g ON g.pdf_id = p.id""")
def overall_confidence(spark: SparkSession, folder: str) -> DataFrame:
    """The mean score of a file's sections, 0.0 without any. Tenths are summed, so that their order does not matter."""
    from ..functions import scoring

    tenths = F.round(scoring.section_score(text.lines(F.col("section_text"))) * 10).cast("long")
    mean = table(spark, folder, "personnel_sections").groupBy("pdf_id").agg((F.sum(tenths).cast("double") / (F.count("*") * 10)).alias("score"))
    out = table(spark, folder, "pdfs").select(F.col("id").alias("pdf_id")).join(mean, "pdf_id", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    return out.withColumn("band", scoring.band(F.col("score")))


@query(f"""WITH l AS (SELECT id, {base._LINES('section_text')} AS lines FROM personnel_sections),
z AS (SELECT id, unnest(range(len(lines))) AS position, unnest(lines) AS line FROM l)
SELECT id, CAST(position AS INTEGER) AS position, line, CAST(length(line) AS INTEGER) AS n_chars FROM z""")
def zipped_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines beside their lengths, by position."""
    lines = text.lines(F.col("section_text"))
    rows = table(spark, folder, "personnel_sections").select("id", lines.alias("line"), F.transform(lines, lambda x: F.length(x)).alias("n_chars"))
    return extract.zipped(rows, "line", "n_chars")


# --- selections ---------------------------------------------------------------------------------------------------------


@query("SELECT id, content_hash FROM pdfs WHERE status = 'failed' ORDER BY id")
def pdfs_by_status(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pdfs").where("status = 'failed'").select("id", "content_hash").orderBy("id")


@query("SELECT section_ref, record_index, arg_max(record_id, (extracted_at, record_id)) AS record_id FROM raw_records WHERE section_ref IS NOT NULL AND extracted_at IS NOT NULL GROUP BY 1, 2")
def record_by_place(spark: SparkSession, folder: str) -> DataFrame:
    """The record that stands for each place of a section: the one extracted last."""
    rows = table(spark, folder, "raw_records").where("section_ref is not null and extracted_at is not null").select("section_ref", "record_index", "record_id", "extracted_at")
    return rows.groupBy("section_ref", "record_index").agg(F.max_by("record_id", F.struct("extracted_at", "record_id")).alias("record_id"))


@query("SELECT person_key, effective_date, version, id FROM gold_records ORDER BY person_key, effective_date, version, id")
def gold_history(spark: SparkSession, folder: str) -> DataFrame:
    """Every person's records in order. A range sort, in which a key of many rows is spread by the further columns."""
    columns = ("person_key", "effective_date", "version", "id")
    return table(spark, folder, "gold_records").select(*columns).orderBy(*columns)


@query("SELECT DISTINCT person_key, effective_date, id FROM gold_records WHERE is_current = 1")
def gold_current(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "gold_records").where("is_current = 1").select("person_key", "effective_date", "id").distinct()


@query("SELECT DISTINCT j.id, code_version FROM jobs j LEFT JOIN parser_versions v ON v.id = j.parser_version_id WHERE status = 'running'")
def jobs_running(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "parser_versions").select(F.col("id").alias("parser_version_id"), "code_version")
    return table(spark, folder, "jobs").where("status = 'running'").select("id", "parser_version_id").distinct().join(broadcast_if_small(known), "parser_version_id", "left").select("id", "code_version")


@query("""WITH f AS (SELECT section_ref, record_index, arg_min(raw_fields, (extracted_at, record_id)) AS a, arg_max(raw_fields, (extracted_at, record_id)) AS b, count(*) AS n FROM raw_records WHERE section_ref IS NOT NULL AND extracted_at IS NOT NULL GROUP BY 1, 2)
SELECT section_ref, record_index, list_sort(list_distinct(list_transform(a, lambda x: x.name))) = list_sort(list_distinct(list_transform(b, lambda x: x.name))) AS same FROM f WHERE n > 1""")
def same_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Of records extracted again, whether the first and the last extraction have the same set of fields."""
    rows = table(spark, folder, "raw_records").where("section_ref is not null and extracted_at is not null")
    place = F.struct("extracted_at", "record_id")
    ends = rows.groupBy("section_ref", "record_index").agg(F.min_by("raw_fields", place).alias("a"), F.max_by("raw_fields", place).alias("b"), F.count("*").alias("n")).where("n > 1")
    return ends.select("section_ref", "record_index", features.same_keys(F.col("a"), F.col("b")).alias("same"))


# --- life cycle ---------------------------------------------------------------------------------------------------------

STAGES = ["field", "normalize", "validate"]
_BLANK_NAME = "len(list_filter(raw_fields, lambda f: f.value IS NOT NULL AND f.value <> '')) < len(raw_fields)"
_FAILED = f"""SELECT record_id, section_ref, CASE WHEN coalesce(len(raw_fields), 0) = 0 THEN 'field' WHEN section_ref IS NULL THEN 'normalize' WHEN {_BLANK_NAME} THEN 'validate' END AS stage,
CASE WHEN coalesce(len(raw_fields), 0) = 0 THEN 'no fields' WHEN section_ref IS NULL THEN 'no section' WHEN {_BLANK_NAME} THEN 'blank values' END AS error FROM raw_records"""


def _ran(spark: SparkSession, folder: str) -> DataFrame:
    fields = F.coalesce(F.size("raw_fields"), F.lit(0))
    blank = F.size(F.filter("raw_fields", lambda f: f["value"].isNotNull() & (f["value"] != ""))) < F.size("raw_fields")
    stages = [("field", F.when(fields <= 0, "no fields")), ("normalize", F.when(F.col("section_ref").isNull(), "no section")), ("validate", F.when(blank, "blank values"))]
    return lifecycle.run_stages(table(spark, folder, "raw_records").select("record_id", "section_ref", "raw_fields"), stages)


@query(f"""WITH f AS ({_FAILED}), e AS (SELECT record_id, unnest([0, 1, 2]) AS stage_index, unnest(['field', 'normalize', 'validate']) AS stage, coalesce(list_position(['field', 'normalize', 'validate'], stage), 4) AS place FROM f)
SELECT record_id, CAST(stage_index AS INTEGER) AS stage_index, stage, CASE WHEN stage_index + 1 < place THEN 'completed' WHEN stage_index + 1 = place THEN 'failed' ELSE 'skipped' END AS event FROM e""".replace("coalesce(list_position(['field', 'normalize', 'validate'], stage), 4)", "coalesce(list_position(['field', 'normalize', 'validate'], f.stage), 4)"))
def stage_events(spark: SparkSession, folder: str) -> DataFrame:
    return lifecycle.stage_events(_ran(spark, folder), STAGES, "record_id")


@query(f"SELECT record_id, stage, error FROM ({_FAILED}) WHERE stage IS NOT NULL")
def failure_rows(spark: SparkSession, folder: str) -> DataFrame:
    return lifecycle.failures(_ran(spark, folder), "record_id")


@query(f"""WITH f AS ({_FAILED}), r AS (SELECT section_ref, count(*) AS n, count(stage) AS bad FROM f GROUP BY 1),
s AS (SELECT pdf_id, count(*) AS n_sections, sum(coalesce(n, 0)) AS n_records, sum(coalesce(bad, 0) + (section_text IS NULL OR section_text = '')::INT) AS bad FROM personnel_sections LEFT JOIN r ON section_ref = id GROUP BY 1)
SELECT id AS document, coalesce(n_sections, 0) AS n_sections, CAST(coalesce(n_records, 0) AS BIGINT) AS n_records, CAST(coalesce(bad, 0) + (status = 'failed')::INT AS BIGINT) AS n_failed, CASE WHEN coalesce(bad, 0) + (status = 'failed')::INT > 0 THEN 'failed' ELSE 'validated' END AS status FROM pdfs LEFT JOIN s ON pdf_id = id""")
def coordinated_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Files, their sections and their records, each with its own failures."""
    docs = table(spark, folder, "pdfs").select(F.col("id").alias("document"), (F.col("status") == "failed").alias("failed"))
    sections = table(spark, folder, "personnel_sections").select(F.col("pdf_id").alias("document"), F.col("id").alias("section"), (F.coalesce("section_text", F.lit("")) == "").alias("failed"))
    return lifecycle.coordinated(docs, sections, _ran(spark, folder).select(F.col("section_ref").alias("section"), F.col("failed_stage").isNotNull().alias("failed")))


@query("SELECT record_id, section_ref FROM raw_records r WHERE section_ref IN (SELECT id FROM personnel_sections) AND NOT EXISTS (SELECT 1 FROM gold_records g WHERE g.candidate_record_id = r.record_id)")
def resume_pending(spark: SparkSession, folder: str) -> DataFrame:
    """The records that a second run takes up, with what is stored of them."""
    done = table(spark, folder, "gold_records").select(F.col("candidate_record_id").alias("record_id")).distinct().withColumn("final", F.lit(True))
    records = table(spark, folder, "raw_records").select("record_id", "section_ref").join(done, "record_id", "left").withColumn("final", F.coalesce("final", F.lit(False)))
    return lifecycle.pending(table(spark, folder, "personnel_sections"), records).select("record_id", "section_ref")


@query("""WITH r AS (SELECT DISTINCT record_id FROM raw_records), n AS (SELECT DISTINCT candidate_record_id AS record_id FROM gold_records WHERE candidate_record_id IS NOT NULL),
v AS (SELECT candidate_record_id AS record_id, bool_and(is_current = 1) AS ok FROM gold_records WHERE superseded_by IS NULL AND candidate_record_id IS NOT NULL GROUP BY 1)
SELECT record_id, CASE WHEN r.record_id IS NULL THEN 'lost' WHEN ok THEN 'passed' WHEN NOT ok THEN 'failed' WHEN n.record_id IS NOT NULL THEN 'normalized' ELSE 'raw' END AS state FROM r FULL JOIN n USING (record_id) FULL JOIN v USING (record_id)""")
def record_states(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows, those a gold row was made of, and whether their last gold rows are all marked as current."""
    gold = table(spark, folder, "gold_records").where("candidate_record_id is not null").select(F.col("candidate_record_id").alias("record_id"), (F.col("is_current") == 1).alias("passed"), "superseded_by")
    return lifecycle.states(table(spark, folder, "raw_records"), gold, gold.where("superseded_by is null"), "record_id")


@query("""WITH j AS (SELECT pdf_id, CASE WHEN count(*) FILTER (status = 'failed') > 0 THEN 'failed' END AS status, max(finished_at) AS updated_at FROM jobs WHERE pdf_id IS NOT NULL GROUP BY 1)
SELECT p.id, coalesce(j.status, p.status) AS status, coalesce(j.updated_at, p.updated_at) AS updated_at FROM pdfs p LEFT JOIN j ON j.pdf_id = p.id""")
def patched_pdfs(spark: SparkSession, folder: str) -> DataFrame:
    """Files patched by the outcome of their jobs."""
    patches = table(spark, folder, "jobs").where("pdf_id is not null").groupBy(F.col("pdf_id").alias("id")).agg(F.max(F.when(F.col("status") == "failed", "failed")).alias("status"), F.max("finished_at").alias("updated_at"))
    return lifecycle.patched(table(spark, folder, "pdfs").select("id", "status", "updated_at"), patches, "id", ("status", "updated_at"))


@query("""WITH j AS (SELECT DISTINCT id, status, started_at, finished_at FROM jobs), e AS (SELECT id, 'running' AS status, started_at AS moment, 0 AS n FROM j UNION ALL SELECT id, status, finished_at, 1 FROM j WHERE finished_at IS NOT NULL AND status <> 'running')
SELECT id, arg_max(status, (n, moment, status)) AS status, min(moment) AS started_at, CASE WHEN arg_max(status, (n, moment, status)) <> 'running' THEN min(moment) FILTER (status <> 'running') END AS finished_at, count(*) AS n_events FROM e GROUP BY 1""")
def jobs_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Runs folded from the events of their starts and ends."""
    jobs = table(spark, folder, "jobs").select("id", "status", "started_at", "finished_at").distinct()
    events = jobs.select("id", F.lit("running").alias("status"), F.col("started_at").alias("at"), F.lit(0).alias("n")).unionByName(jobs.where("finished_at is not null and status <> 'running'").select("id", "status", F.col("finished_at").alias("at"), F.lit(1).alias("n")))
    return lifecycle.ledger(events, "id", ["n", "at", "status"])


@query("SELECT DISTINCT layout_id AS era_id, 2 AS version FROM raw_records r WHERE layout_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM layouts l WHERE l.era_id = r.layout_id AND l.version = 2)")
def layouts_unregistered(spark: SparkSession, folder: str) -> DataFrame:
    """Of the layouts that records were read with, those not registered in their second version."""
    known = table(spark, folder, "layouts").select("era_id", "version")
    return lifecycle.unregistered(table(spark, folder, "raw_records").select(F.col("layout_id").alias("era_id"), F.lit(2).alias("version")), known, ["era_id", "version"])


_D = "PARTITION BY category, item_key"


@query(f"""WITH d AS (SELECT DISTINCT id, category, item_key, canonical_value, source_file, effective_from, effective_to, created_at FROM knowledge_items),
a AS (SELECT *, (lag(canonical_value) OVER w IS DISTINCT FROM canonical_value OR lag(source_file) OVER w IS DISTINCT FROM source_file OR row_number() OVER w = 1)::INT AS turn FROM d WINDOW w AS ({_D} ORDER BY created_at, id)),
b AS (SELECT *, sum(turn) OVER ({_D} ORDER BY created_at, id) AS run FROM a),
c AS (SELECT *, coalesce(max((effective_to IS NULL)::INT) OVER (PARTITION BY category, item_key, run ORDER BY created_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opened FROM b)
SELECT category, item_key, canonical_value, source_file, id, effective_from, coalesce(effective_to, lead(effective_from) OVER w, lead(created_at::DATE) OVER w) AS effective_to FROM c WHERE opened = 0 WINDOW w AS ({_D} ORDER BY created_at, id)""")
def dictionary_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The dictionary as its deliveries build it."""
    items = table(spark, folder, "knowledge_items").select("id", "category", "item_key", "canonical_value", "source_file", "effective_from", "effective_to", "created_at").distinct()
    return lifecycle.delivered(items, ["category", "item_key"], ["canonical_value", "source_file"], [F.col("created_at"), F.col("id")], F.col("created_at").cast("date"))


@query("""WITH v AS (SELECT *, row_number() OVER (PARTITION BY pdf_id, section_index ORDER BY created_at DESC, id DESC) AS n FROM personnel_sections),
a AS (SELECT pdf_id, section_index, section_text FROM v WHERE n = 2), b AS (SELECT pdf_id, section_index, section_text FROM v WHERE n = 1)
SELECT pdf_id, section_index, CASE WHEN a.pdf_id IS NULL THEN 'added' WHEN a.section_text IS NOT DISTINCT FROM b.section_text THEN 'same' ELSE 'changed' END AS change
FROM b LEFT JOIN (SELECT pdf_id, section_index, section_text FROM a) a USING (pdf_id, section_index)""")
def backfill_changes(spark: SparkSession, folder: str) -> DataFrame:
    """What the last parse of each section changed against the one before."""
    rows = versions.numbered(table(spark, folder, "personnel_sections").select("pdf_id", "section_index", "section_text", "created_at", "id"), ["pdf_id", "section_index"], [F.desc("created_at"), F.desc("id")])
    return lifecycle.compared(rows.where("version = 2"), rows.where("version = 1"), ["pdf_id", "section_index"], "section_text")


def _sample_sql(name: str) -> str:
    columns = {"audit_dup_active": "n pdf_id section_index", "audit_orphan_superseded": "id", "audit_section_parents": "missing reference row_id", "audit_stale_running": "id started_at", "audit_dup_current": "effective_date n person_key", "audit_cycle": "id loop_id"}[name].split()
    sample = ", ".join(f"coalesce({c}::VARCHAR, '-')" for c in columns)
    return f"SELECT '{name}' AS check_id, CAST(row_number() OVER (ORDER BY sample) AS INTEGER) AS sample_no, sample FROM (SELECT concat_ws('|', {sample}) AS sample FROM ({base.ORACLES[name]})) QUALIFY row_number() OVER (ORDER BY sample) <= 10"


SAMPLED = ("audit_dup_active", "audit_orphan_superseded", "audit_section_parents", "audit_stale_running", "audit_dup_current", "audit_cycle")


@query(" UNION ALL ".join(f"({_sample_sql(n)})" for n in SAMPLED))
def audit_samples(spark: SparkSession, folder: str) -> DataFrame:
    """A report: the first ten findings of some checks; the checks themselves give all."""
    return lifecycle.samples({n: base.QUERIES[n](spark, folder) for n in SAMPLED})


# --- features and exports -----------------------------------------------------------------------------------------------

_STRIP = base._STRIP


@query(f"""WITH g AS (SELECT candidate_record_id AS record_id, avg(change_rate) AS change_rate FROM ({base.ORACLES['change_rate']}) c JOIN gold_records g ON g.id = c.id WHERE candidate_record_id IS NOT NULL GROUP BY 1),
o AS (SELECT section_ref, count(*) AS n FROM raw_records WHERE coalesce(len(raw_fields), 0) = 0 GROUP BY 1)
SELECT v.record_id, s.subject_ref, v.fill_rate, v.suspicious_rate, coalesce(g.change_rate, 0.0) AS change_rate, coalesce(o.n, 0)::DOUBLE AS open_errors
FROM ({base.ORACLES['feature_vector']}) v JOIN ({base.ORACLES['subject_ref_hash']}) s USING (record_id) JOIN raw_records r USING (record_id) LEFT JOIN g USING (record_id) LEFT JOIN o ON o.section_ref = r.section_ref""")
def feature_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """All features of a record as a map, checked for their ranges, with a default for those that it lacks: the change rate is
    that of the gold rows made of it, open errors are records without fields in its section."""
    raw = table(spark, folder, "raw_records").select("record_id", "layout_id", "section_ref", "record_index", "raw_fields")
    ids = table(spark, folder, "gold_records").where("candidate_record_id is not null").select("id", F.col("candidate_record_id").alias("record_id"))
    changed = base.QUERIES["change_rate"](spark, folder).join(ids, "id").groupBy("record_id").agg(F.avg("change_rate").alias("change"))
    open_ = raw.where(F.coalesce(F.size("raw_fields"), F.lit(0)) <= 0).groupBy("section_ref").agg(F.count("*").cast("double").alias("open"))
    met = raw.join(changed, "record_id", "left").join(open_, "section_ref", "left")
    made = F.create_map(F.lit("fill_rate"), features.fill_rate(F.col("raw_fields")), F.lit("suspicious_rate"), features.suspicious_rate(F.col("raw_fields")), F.lit("change_rate"), F.col("change"), F.lit("open_errors"), F.col("open"))
    good, _ = features.quarantined(met.select("record_id", features.subject_ref(F.col("layout_id"), F.col("section_ref"), F.col("record_index")).alias("subject_ref"), made.alias("features")))
    return good.select("record_id", "subject_ref", *(features.feature(F.col("features"), c, 0.0).alias(c) for c in ("fill_rate", "suspicious_rate", "change_rate", "open_errors")))


@query(base._FLAT)
def export_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Public records as nested JSON, read back to the flat columns."""
    return sink.unnested(sink.nested(table(spark, folder, "gold_records")))


@query(f"""WITH f AS ({base._FLAT}) SELECT id, 'version' AS problem FROM f WHERE version IS NULL OR version < 1 UNION ALL SELECT id, 'person_value' FROM f WHERE person_value IS NULL
UNION ALL SELECT id, 'effective_date' FROM f WHERE effective_date IS NULL UNION ALL SELECT id, 'appointment_type' FROM f WHERE appointment_type IS NULL""")
def export_problems(spark: SparkSession, folder: str) -> DataFrame:
    return sink.broken_constraints(sink.flatten(table(spark, folder, "gold_records")))


# --- operations ---------------------------------------------------------------------------------------------------------


@query("""WITH c AS (SELECT job_type, floor(date_diff('day', DATE '1970-01-05', started_at::DATE) / 7.0) AS p, count(*) AS n FROM (SELECT DISTINCT * FROM jobs) WHERE started_at IS NOT NULL GROUP BY 1, 2)
SELECT job_type, count(*) AS n_periods, regr_slope(n::DOUBLE, p::DOUBLE) AS slope FROM c GROUP BY 1""")
def growth_slope(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.slope(table(spark, folder, "jobs").distinct(), ["job_type"], "started_at")


@query("""WITH b AS (SELECT job_type, count(*) FILTER (status <> 'running') AS n_ended, count(*) FILTER (status = 'failed') AS bad FROM (SELECT DISTINCT * FROM jobs) GROUP BY 1),
c AS (SELECT job_type, n_ended, CASE WHEN n_ended > 0 THEN bad / (n_ended * (1::DOUBLE - 0.95::DOUBLE)) END AS burn FROM b)
SELECT *, CASE WHEN burn >= 1 THEN 100 WHEN burn >= 0.8 THEN 80 WHEN burn >= 0.5 THEN 50 ELSE 0 END AS alert FROM c""")
def error_budget(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.budget_burn(table(spark, folder, "jobs").distinct(), ["job_type"], 0.95)


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY job_type ORDER BY started_at DESC, id DESC) AS n FROM (SELECT DISTINCT id, job_type, status, started_at FROM jobs WHERE status <> 'running'))
SELECT job_type, count(*) AS n_runs, bool_and(status = 'succeeded') AS all_succeeded FROM r WHERE n <= 5 GROUP BY 1""")
def last_runs(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.last_runs(table(spark, folder, "jobs").select("id", "job_type", "status", "started_at").distinct(), ["job_type"])


@query("""SELECT l.era_id, year(s.created_at) AS period, count(*) AS n, count(*) FILTER (s.status = 'parsed') AS n_passed, CAST(grouping(l.era_id) * 2 + grouping(year(s.created_at)) AS BIGINT) AS level
FROM personnel_sections s JOIN layouts l ON l.id = s.layout_id GROUP BY ROLLUP (l.era_id, year(s.created_at))""")
def benchmark_by_period(spark: SparkSession, folder: str) -> DataFrame:
    """Share of sections in use by layout and year, with totals."""
    eras = table(spark, folder, "layouts").select(F.col("id").alias("layout_id"), "era_id")
    rows = table(spark, folder, "personnel_sections").join(broadcast_if_small(eras), "layout_id").select("era_id", F.year("created_at").cast("long").alias("period"), "status")
    return rows.rollup("era_id", "period").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "parsed").alias("n_passed"), F.grouping_id().alias("level"))


#: Typography rules with a pattern and the field that they apply to (`*` for all).
SCOPED = [("*", "[ \\x{3000}]{2,}", " "), ("column_1", "[.。]$", ""), ("column_2", "^第([0-9]+)", "$1")]


@query(r"""WITH f AS (SELECT record_id, unnest(raw_fields) AS f FROM raw_records), v AS (SELECT record_id, f.name AS name, f.value AS raw, regexp_replace(f.value, '[ \x{3000}]{2,}', ' ', 'g') AS a FROM f)
SELECT record_id, name, CASE WHEN name = 'column_1' THEN regexp_replace(a, '[.。]$', '', 'g') WHEN name = 'column_2' THEN regexp_replace(a, '^第([0-9]+)', '\1', 'g') ELSE a END AS value FROM v""")
def scoped_typography(spark: SparkSession, folder: str) -> DataFrame:
    fields = table(spark, folder, "raw_records").select("record_id", F.explode("raw_fields").alias("f")).select("record_id", F.col("f.name").alias("name"), F.col("f.value").alias("value"))
    return lookup.scoped_patterns(fields, SCOPED, "name", "value")


@query(base.ORACLES["windowed_counts"])
def streamed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """windowed_counts() of a stream, its open windows included."""
    path, scratch = f"{folder.rstrip('/')}/events.parquet", Scratch(spark)
    stream = ingest.arrivals(spark, f"{path[:-1]}[t]", spark.read.parquet(path).schema)
    ingest.latest_counts(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"], f"{scratch.folder}/counts", f"{scratch.folder}/progress", delay="36500 days")
    return ingest.read_latest(spark, f"{scratch.folder}/counts", ["event_type"]).select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query(base.ORACLES["scd2_history"])
def streamed_versions(spark: SparkSession, folder: str) -> DataFrame:
    """scd2_history() of facts that arrive as a stream."""
    path, scratch = f"{folder.rstrip('/')}/gold_records.parquet", Scratch(spark)
    stream = ingest.arrivals(spark, f"{path[:-1]}[t]", spark.read.parquet(path).schema)
    ingest.append_facts(stream.select("id", "person_key", "effective_date", "created_at"), f"{scratch.folder}/facts", f"{scratch.folder}/progress")
    facts = spark.read.parquet(f"{scratch.folder}/facts").drop("batch").distinct().withColumnRenamed("created_at", "valid_from")
    chain = versions.chained(facts, ["person_key", "effective_date"], [F.col("valid_from"), F.col("id")])
    return chain.select("id", "valid_from", "valid_to", "superseded_by", "is_current")
