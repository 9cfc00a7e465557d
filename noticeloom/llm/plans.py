"""The pN queries of the problems on texts and names over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import broadcast_if_small
from ..sources.tables import table
from . import leaks, lookalike, mixture, names, quality

WITHHELD = "氏名非公表"


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """All values of raw_fields and all section texts: table_name, row_id, field_name, text."""
    fields = table(spark, folder, "raw_records").select(F.lit("raw_records").alias("table_name"), F.col("record_id").alias("row_id"), F.explode("raw_fields").alias("f"))
    fields = fields.select("table_name", "row_id", F.col("f.name").alias("field_name"), F.col("f.value").alias("text"))
    sections = table(spark, folder, "personnel_sections").select(F.lit("personnel_sections").alias("table_name"), F.col("id").alias("row_id"), F.lit("section_text").alias("field_name"), F.col("section_text").alias("text"))
    return fields.unionByName(sections)


def _variants(spark: SparkSession, folder: str) -> DataFrame:
    persons = table(spark, folder, "gold_records").select(F.lit("person").alias("kind"), F.col("person_key").alias("name")).where(F.col("name") != WITHHELD)
    items = table(spark, folder, "knowledge_items").select("category", "item_key", "canonical_value")
    columns = items.where("category = 'layout' and canonical_value = 'organization'").select(F.col("item_key").alias("key")).distinct()
    fields = table(spark, folder, "raw_records").select("layout_id", F.explode("raw_fields").alias("f")).select(F.concat_ws(".", "layout_id", "f.name").alias("key"), F.col("f.value").alias("name"))
    units = fields.join(broadcast_if_small(columns), "key").select(F.lit("organisation").alias("kind"), "name")
    # a dictionary of ranks, which may stand before a name
    ranks = [r.item_key for r in items.where("category = 'rank'").select("item_key").distinct().toLocalIterator()]
    return names.variants(persons.unionByName(units), titles=ranks)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.pairs(_variants(spark, folder))


def p1_spellings(spark: SparkSession, folder: str) -> DataFrame:
    """Every spelling that has variants, with the smallest spelling of its person or organisation."""
    return _variants(spark, folder)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.unified(_texts(spark, folder)).where("stand_in").select("table_name", "row_id", "field_name").distinct()


def p3_canonical(spark: SparkSession, folder: str) -> DataFrame:
    """Every text in its one form."""
    return lookalike.unified(_texts(spark, folder)).select("table_name", "row_id", "field_name", "canonical")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaked(table(spark, folder, "documents"), table(spark, folder, "eval_items")).select("doc_id", "item_id")


def p6_leaked_items(spark: SparkSession, folder: str) -> DataFrame:
    """For each leaked item the number of documents that hold it in exact passages, of those that hold it as a whole but
    edited beyond that, and the largest share found."""
    found = leaks.matches(table(spark, folder, "documents"), table(spark, folder, "eval_items"))
    exact = F.col("share") >= leaks.SHARE
    return found.groupBy("item_id").agg(F.count_if(exact).alias("n_documents"), F.count_if(~exact).alias("n_edited"), F.max("share").alias("share"))


def p7_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """The drawn documents with their sizes and numbers of copies."""
    return mixture.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets")).drawn


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares reached beside the targets."""
    return mixture.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets")).report


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.kinds(table(spark, folder, "documents"), table(spark, folder, "doc_labels"))
    return scored.where("kind <> 'prose'").select("doc_id", "kind").distinct()


def p8_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return quality.statistics(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_spellings, p3_found, p3_canonical, p6_found, p6_leaked_items, p7_mixture, p7_shares, p8_found, p8_statistics)}

_W = quality.WORD.replace("'", "''")
ORACLES = {
    "p8_statistics": rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '{_W}') AS words, regexp_replace(text, '{quality.BLANKS}', '', 'g') AS dense,
  list_filter(string_split(text, chr(10)), lambda x: length(regexp_replace(x, '{quality.BLANKS}', '', 'g')) > 0) AS lines FROM t),
c AS (SELECT word FROM (SELECT unnest(list_distinct(words)) AS word FROM w) GROUP BY word HAVING count(*) >= {quality.COMMON} * (SELECT count(*) FROM t)),
a AS (SELECT list(word) AS common FROM c)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CASE WHEN len(words) > 0 THEN length(array_to_string(words, ''))::DOUBLE / len(words) ELSE 0 END AS mean_word_length,
  CASE WHEN length(dense) > 0 THEN length(regexp_replace(dense, '{quality.LETTERS}', '', 'g'))::DOUBLE / length(dense) ELSE 0 END AS symbol_share,
  CASE WHEN len(lines) > 0 THEN len(list_filter(lines, lambda x: regexp_matches(regexp_replace(x, '[ \t\r\x{{3000}}]+$', ''), '{quality.END}')))::DOUBLE / len(lines) ELSE 0 END AS line_end_share,
  CASE WHEN len(words) > 0 THEN len(list_filter(words, lambda x: list_contains(coalesce(common, []), x)))::DOUBLE / len(words) ELSE 0 END AS common_word_share
FROM w CROSS JOIN a""",
}
