"""Text, layouts, sections, fields, dictionaries and validation."""

import datetime as dt
import unicodedata

import pytest
from pyspark.sql import functions as F

from noticeloom.functions import scoring, text
from noticeloom.operators import extract, layout, lookup, resume, versions


def one(df, *columns):
    return df.select(*columns).first()


def test_lines_know_unicode_space(spark):
    t = "　 a　b \x85 c\x1cd\r\n\r\n \t\ne"
    df = spark.createDataFrame([(t,), (None,), ("",)], "t string").select(text.lines(F.col("t")).alias("l"))
    assert [r.l for r in df.collect()] == [["a　b", "c", "d", "e"], [], []]
    cut = spark.createDataFrame([("a　　b  c d\t \te",)], "t string").select(text.columns(F.col("t")).alias("c")).first().c
    assert [(x.name, x.value) for x in cut] == [("column_1", "a"), ("column_2", "b"), ("column_3", "c d"), ("column_4", "e")]


def test_bands_and_scores(spark):
    df = spark.createDataFrame([(0.9,), (0.75,), (0.5,), (0.4999,), (None,)], "s double")
    assert [r.b for r in df.select(scoring.band(F.col("s")).alias("b")).collect()] == ["verified", "high", "medium", "low", "low"]
    mode = spark.createDataFrame([([90, 0, 0, 90, 5],), ([],)], "v array<int>").select(layout.first_seen_mode(F.col("v")).alias("m")).collect()
    assert [r.m for r in mode] == [90, None]


RULES = [(0, "first", [("h", "header_pattern", "H", 0.4), ("f", "footer_pattern", "F", 0.2), ("p", "min_page_count", "2", 0.2), ("q", "min_page_count", "x", 0.2)]), (1, "second", [("h", "header_pattern", "H", 0.62), ("g", "footer_pattern", "G", 0.38)])]


def test_layout_thresholds(spark):
    manifest = spark.createDataFrame(RULES, f"ordinal int, layout_id string, rules {layout.RULES}")
    pages = [(1, 0, "H1\nx"), (1, 1, "y\nF2"), (2, 0, "H"), (3, 0, "nothing"), (4, 0, None), (5, 0, "a\n"), (5, 1, "b\nF")]
    found = layout.evidence(spark.createDataFrame(pages, "doc_id int, page_index int, text string"))
    seen = {r.doc_id: r for r in found.collect()}
    assert (seen[1].page_count, seen[1].header, seen[1].footer, seen[1].mean_lines) == (2, "H1", "F2", 2.0)
    assert (seen[4].header, seen[4].footer, seen[4].mean_chars) == (None, None, 0.0)
    got = {r.doc_id: r for r in layout.detect(found, manifest).collect()}
    assert (got[1].layout_id, got[1].score, got[1].warnings) == ("first", 0.8, [])
    assert (got[2].layout_id, got[2].warnings) == ("second", [])
    assert (got[3].layout_id, got[3].score, got[3].band, got[3].warnings) == (None, 0.0, "low", ["NO_MATCH"])
    assert (got[5].layout_id, got[5].warnings) == (None, ["LOW_CONFIDENCE"])
    assert {r.warnings[0] for r in layout.detect(found, manifest.limit(0)).collect()} == {"NO_MATCH"}


def test_weights_without_header_still_match(spark):
    rules = [(True, 0.2), (True, 0.2), (True, 0.2), (False, 0.4)]
    df = spark.createDataFrame([(rules,)], "r array<struct<matched:boolean,weight:double>>")
    assert one(df, scoring.weighted_score(F.col("r")).alias("s")).s >= scoring.LAYOUT_MATCH


def test_sections_and_records(spark):
    pages = spark.createDataFrame([(1, " T \n\n a  b \n c \n"), (2, "one"), (3, "two\nlines"), (4, " \n"), (5, None)], "id int, text string")
    got = {r.id: r for r in extract.sections(pages, keep=0.0).collect()}
    assert [got[i].section_score for i in range(1, 6)] == [1.0, 0.3, 0.3, 0.0, 0.0]
    assert (got[1].header, got[1].body_lines, got[1].footer, got[2].header, got[2].footer, got[2].body_lines) == ("T", ["a  b"], "c", "one", "one", [])
    assert [r.id for r in extract.sections(pages).collect()] == [1]
    rows = extract.records(extract.sections(pages)).collect()
    assert [(r.record_index, [x.value for x in r.raw_fields]) for r in rows] == [(1, ["a", "b"])]


ITEM = "id long, category string, item_key string, canonical_value string, effective_from date, effective_to date, ordinal int"
D = dt.date


def items(spark):
    rows = [
        (1, "layout", "L.column_1", "name", None, None, 1), (2, "layout", "L.column_2", "rank", None, None, 2), (3, "layout", "L.column_3", "organization", None, None, 3),
        (4, "typography", "廣", "広", None, None, 4), (5, "alias", "広田", "広田太郎", None, None, 5), (6, "rank", "1佐", "一等佐官", D(2010, 1, 1), D(2020, 1, 1), 6),
        (7, "rank", "1佐", "一等佐", D(2020, 1, 1), None, 7), (8, "organization", "本部", "中央本部", None, None, 8), (9, "organization", "本部", "後の本部", None, None, 9),
    ]
    return spark.createDataFrame(rows, ITEM)


def test_normalization_reaches_the_worked_score(spark):
    raw = [(1, "L", [("column_1", "廣田"), ("column_2", "１佐"), ("column_3", "本部"), ("column_4", "備考")]), (2, "L", [("column_4", "x")]), (3, "L", [("column_1", None)]), (4, "L", [])]
    records = spark.createDataFrame(raw, "record_id long, layout_id string, raw_fields array<struct<name:string,value:string>>")
    got = {r.record_id: r for r in lookup.normalize(records, items(spark), F.lit("2015-06-01").cast("date"), keep=0.0).collect()}
    assert set(got) == {1, 2}
    assert [(f.name, f.value) for f in got[1].normalized_fields] == [("column_1", "広田太郎"), ("column_2", "一等佐官"), ("column_3", "中央本部"), ("column_4", "備考")]
    assert (got[1].score, got[1].band, got[1].applied) == (0.825, "high", [4, 5, 6, 8])
    later = lookup.normalize(records, items(spark), F.lit("2020-01-01").cast("date")).collect()
    assert [(r.record_id, r.normalized_fields[1].value) for r in later] == [(1, "一等佐")]


def test_validation(spark):
    raw = [(1, "L", [("column_2", "a"), ("column_3", "q"), ("column_9", "z")]), (2, "L", [("column_2", "b"), ("column_1", "n")]), (3, "L", [("column_9", "z")])]
    records = spark.createDataFrame(raw, "record_id long, layout_id string, raw_fields array<struct<name:string,value:string>>")
    allowed = spark.createDataFrame([("rank", "a"), ("rank", "c"), ("rank", "a")], "semantic string, value string")
    got = {r.record_id: (r.status, r.score, r.errors, r.warnings) for r in lookup.validate(lookup.fields(records, items(spark)), allowed).collect()}
    assert got == {1: ("passed", 1.0, 0, 1), 2: ("failed", 0.5, 1, 0), 3: ("passed", 0.5, 0, 1)}


def test_nfkc(spark):
    values = ["ｶﾞ", "Ⅳ", "plain", None, ""]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(text.nfkc(F.col("v")).alias("n"))
    assert [r.n for r in df.collect()] == [None if v is None else unicodedata.normalize("NFKC", v) for v in values]


def test_overlaps(spark):
    rows = [(1, "k", D(2010, 1, 1), D(2012, 1, 1)), (2, "k", D(2011, 12, 31), None), (3, "k", D(2012, 1, 1), D(2012, 1, 1)), (4, "k", None, D(2010, 1, 1)), (5, "j", None, None), (5, "j", None, None)]
    df = spark.createDataFrame(rows, "id long, k string, effective_from date, effective_to date")
    assert [(r.id, r.earlier_id) for r in lookup.overlaps(df, ["k"]).collect()] == [(2, 1)]


def test_versions(spark):
    rows = [(1, "p", 10), (2, "p", 20), (3, "p", 20), (4, "q", 5), (5, "q", None)]
    df = spark.createDataFrame(rows, "id long, person string, valid_from int")
    order = [F.col("valid_from"), F.col("id")]
    got = {r.id: (r.superseded_by, r.valid_to, r.is_current) for r in versions.chained(df, ["person"], order).collect()}
    assert got == {1: (2, 20, False), 2: (3, 20, False), 3: (None, None, True), 5: (4, 5, False), 4: (None, None, True)}
    after = spark.createDataFrame([("p", 7)], "person string, version int")
    assert {r.id: r.version for r in versions.numbered(df, ["person"], order, after).collect()} == {1: 8, 2: 9, 3: 10, 5: 1, 4: 2}
    assert sorted(r.id for r in versions.snapshot(versions.chained(df, ["person"], order), F.lit(15)).collect()) == [1, 4]
    assert sorted(r.id for r in versions.latest(df, ["person"], [F.desc("valid_from"), F.desc("id")]).collect()) == [3, 4]
    new = versions.unseen(df, spark.createDataFrame([("p",)], "key string"), F.col("person"), [F.col("id")])
    assert [r.id for r in new.collect()] == [4]


def test_type2_ignores_repeats(spark):
    df = spark.createDataFrame([("k", "a", 1), ("k", "a", 2), ("k", "b", 3), ("k", "a", 4), ("j", None, 1), ("j", None, 2)], "k string, v string, t int")
    got = sorted((r.k, r.v or "", r.effective_from, r.effective_to) for r in versions.type2(df, ["k"], ["v"], F.col("t"), [F.col("t")]).collect())
    assert got == [("j", "", 1, None), ("k", "a", 1, 3), ("k", "a", 4, None), ("k", "b", 3, 4)]


def test_resume_and_outcome(spark):
    sections = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    records = spark.createDataFrame([(1, True), (1, True), (2, True), (2, False), (None, False)], "section_ref long, final boolean")
    assert {r.section: (r.action, r.n_pending) for r in resume.classify(sections, records).collect()} == {1: ("skip", 0), 2: ("rerun", 1), 3: ("extract", 0)}
    events = spark.createDataFrame([(1, 2, 0, None, 1), (1, 0, 1, "late", 3), (1, 0, 1, "early", 2), (2, 1, 0, None, 1)], "doc int, p int, f int, e string, t int")
    assert {r.doc: (r.processed, r.failed, r.first_error, r.status) for r in resume.outcome(events, ["doc"], "p", "f", "e", ["t"]).collect()} == {1: (2, 2, "early", "failed"), 2: (1, 0, None, "validated")}
    legal = spark.createDataFrame([("a", "b")], "state_from string, state_to string")
    moves = spark.createDataFrame([("a", "b", 1), ("b", "a", 2)], "state_from string, state_to string, n int")
    assert [r.n for r in resume.illegal(moves, legal).collect()] == [2]


@pytest.mark.parametrize("closed, want", [(False, [1]), (True, [1, 2])])
def test_interval_ends(spark, closed, want):
    df = spark.createDataFrame([(1, D(2020, 1, 1), None), (2, None, D(2020, 1, 1)), (3, D(2020, 1, 2), None)], "id int, a date, b date")
    assert [r.id for r in df.where(lookup.in_force(F.col("a"), F.col("b"), F.lit("2020-01-01").cast("date"), closed)).orderBy("id").collect()] == want
