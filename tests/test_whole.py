"""Queries answer for every row of their tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from noticeloom.operators import audit, layout, lookup
from noticeloom.plans import core, reference

WITHHELD = "氏名非公表"
GOLD = (
    "id long, candidate_record_id long, person_key string, effective_date date, appointment_type string, fields string, version int,"
    " is_current int, superseded_by long, valid_from timestamp_ntz, valid_to timestamp_ntz, created_at timestamp_ntz"
)


def gold_row(i, person, created, **other):
    day, at = dt.date(2019, 4, 1), dt.datetime(2019, 4, created)
    row = {"candidate_record_id": i, "appointment_type": "transfer", "fields": "{}", "version": 1, "is_current": 1, "superseded_by": None, "valid_to": None}
    row |= {"id": i, "person_key": person, "effective_date": day, "valid_from": at, "created_at": at} | other
    return tuple(row[c.split()[0]] for c in GOLD.split(", "))


def stored(spark, folder, rows):
    spark.createDataFrame(rows, GOLD).write.parquet(f"{folder}/gold_records.parquet")
    return str(folder)


def test_withheld_and_missing_names_get_versions(spark, tmp_path):
    rows = [gold_row(1, WITHHELD, 1), gold_row(2, WITHHELD, 2), gold_row(3, "a", 3), gold_row(4, None, 4), gold_row(5, None, 5)]
    folder = stored(spark, tmp_path, rows + rows[:1])
    assert {r.id: r.version for r in reference.next_version(spark, folder).collect()} == {1: 1, 2: 2, 3: 1, 4: 1, 5: 2}
    assert {r.id: (r.superseded_by, r.is_current) for r in reference.scd2_history(spark, folder).collect()} == {1: (2, False), 2: (None, True), 3: (None, True), 4: (5, False), 5: (None, True)}
    assert {r.id for r in reference.scd2_as_of(spark, folder).collect()} == {2, 3, 5}


def test_export_hash_tells_every_exported_column(spark, tmp_path):
    base = gold_row(1, "a", 1, fields='{"rank":{"value":"x","raw":"y"}}')
    others = [
        base,
        gold_row(1, "a", 1, fields='{"rank":{"value":"z","raw":"y"}}'),
        gold_row(1, "a", 1, fields='{"rank":{"value":"x","raw":"y"},"organization":{"value":"o","raw":"o"}}'),
        gold_row(1, "a", 1, fields='{"rank":{"value":"x","raw":"y"}}', version=2),
        gold_row(1, "a", 1, fields='{"rank":{"value":"x","raw":"y"}}', is_current=0),
        gold_row(1, "b", 1, fields='{"rank":{"value":"x","raw":"y"}}'),
    ]
    hashes = {reference.export_content_hash(spark, stored(spark, tmp_path / str(i), [row])).first().content_hash for i, row in enumerate(others)}
    assert len(hashes) == len(others)


def test_p2_found_numbers_the_nested_sets(spark, tmp_path, monkeypatch):
    made, nested_sets = [], core.hierarchy.nested_sets
    monkeypatch.setattr(core.hierarchy, "nested_sets", lambda *a, **k: made.append(nested_sets(*a, **k)) or made[-1])
    up = {1: 2, 2: 3, 3: None, 4: 3, 5: 99, 6: 7, 7: 6, 8: 6}
    folder = stored(spark, tmp_path, [gold_row(i, "a", 1, superseded_by=p) for i, p in up.items()])
    got = {r.id: (r.root_id, r.depth) for r in core.p2_found(spark, folder).collect()}
    assert got == {1: (3, 2), 2: (3, 1), 4: (3, 1), 5: (5, 0), 6: (6, -1), 7: (6, -1), 8: (6, -1)}
    assert {r.id: r.n_descendants for r in made[0].where("lo is not null").collect()} == {1: 0, 2: 1, 3: 3, 4: 0, 5: 0}


def test_every_overlap_is_counted(spark):
    D = dt.date
    rows = [(1, "k", None, None), (2, "k", D(2011, 1, 1), D(2012, 1, 1)), (3, "k", D(2011, 6, 1), D(2013, 1, 1)), (4, "k", D(2012, 1, 1), None), (5, "k", D(2012, 1, 1), D(2012, 1, 1)), (6, "j", None, None)]
    df = spark.createDataFrame(rows + rows[:1], "id long, k string, effective_from date, effective_to date")
    assert {r.id: r.n_earlier for r in lookup.overlap_counts(df, ["k"]).collect()} == {2: 1, 3: 2, 4: 2}


def test_every_newer_row_is_counted(spark):
    at = lambda d: dt.datetime(2020, 1, d)
    rows = [(1, 1, "parsed", at(1)), (2, 1, "superseded", at(1)), (3, 1, "superseded", at(2)), (4, 1, "superseded", at(3)), (5, 1, "parsed", at(2)), (6, 2, "parsed", at(9)), (7, 2, "superseded", None)]
    df = spark.createDataFrame(rows, "id long, doc long, status string, released timestamp_ntz")
    assert {r.id_active: r.n_newer for r in audit.newer_counts(df, ["doc"], F.col("status") == "parsed", "released").collect()} == {1: 2, 5: 1}


def test_font_rules_score(spark):
    rules = [("h", "header_pattern", "H", 0.5), ("m", "font_name_contains", "Mincho", 0.5)]
    manifest = lambda r: spark.createDataFrame([(0, "a", r)], f"ordinal int, layout_id string, rules {layout.RULES}")
    pages = spark.createDataFrame([(1, 0, "H", ["Gothic"]), (1, 1, "x", ["MS-Mincho", None]), (2, 0, "H", ["Gothic"]), (3, 0, "H", None)], "doc_id int, page_index int, text string, fonts array<string>")
    score = lambda found: {r.doc_id: (r.layout_id, r.score) for r in layout.detect(found, manifest(rules)).collect()}
    assert score(layout.evidence(pages)) == {1: ("a", 1.0), 2: (None, 0.5), 3: (None, 0.5)}
    assert score(layout.evidence(pages.drop("fonts"))) == {1: (None, 0.5), 2: (None, 0.5), 3: (None, 0.5)}
    with pytest.raises(ValueError):
        layout.detect(layout.evidence(pages), manifest([("z", "colour", "red", 1.0)]))


def test_every_category_is_versioned(spark, tmp_path):
    at = lambda d: dt.datetime(2020, 1, d)
    rows = [(1, "rank", "k", "a", at(1)), (2, "organization", "k", "b", at(2)), (3, "rank", "k", "a", at(3)), (4, "rank", "k", "c", at(4)), (4, "rank", "k", "c", at(4))]
    spark.createDataFrame(rows, "id long, category string, item_key string, canonical_value string, created_at timestamp_ntz").write.parquet(str(tmp_path / "knowledge_items.parquet"))
    got = {(r.category, r.canonical_value, r.effective_from, r.effective_to) for r in reference.type2_upsert(spark, str(tmp_path)).collect()}
    assert got == {("rank", "a", at(1), at(4)), ("rank", "c", at(4), None), ("organization", "b", at(2), None)}


def test_an_event_far_away_does_not_unfold_every_year(spark, monkeypatch):
    from noticeloom.operators import asof

    made, keep = [], asof.Scratch.keep
    monkeypatch.setattr(asof.Scratch, "keep", lambda self, df: made.append(keep(self, df)) or made[-1])
    at = dt.datetime(2020, 1, 1)
    items = spark.createDataFrame([(i, f"k{i}", "v", dt.date(2000, 1, 1), None, at) for i in range(20)], "id long, k string, v string, a date, b date, known timestamp_ntz")
    events = spark.createDataFrame([(i, f"k{i}", dt.date(9999, 12, 31) if i == 3 else dt.date(2021, 5, 5), at) for i in range(20)], "e long, k string, day date, at timestamp_ntz")
    got = asof.as_known(events, items, key=("k", "k"), event_date="day", event_known="at", item_id="id", item_value="v", valid=("a", "b"), item_known="known")
    assert {(r.e, r.item_id) for r in got.collect()} == {(i, i) for i in range(20)}
    assert made[0].count() == 20


def test_a_cluster_must_name_a_shared_folder():
    from types import SimpleNamespace

    from noticeloom.runtime import scratch_folder

    session = lambda master, shared: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: shared), sparkContext=SimpleNamespace(master=master))
    assert scratch_folder(session("spark://h:7077", "s3://x/y/")) == "s3://x/y"
    for master in ("spark://h:7077", "local-cluster[3,2,3000]", "yarn"):
        with pytest.raises(RuntimeError):
            scratch_folder(session(master, None))


def test_json_array_of_any_size(spark, tmp_path):
    import json

    from noticeloom.sinks import export

    rows = spark.range(0, 1000, 1, 7).selectExpr("id", "if(id % 2 = 0, null, concat('\"', id)) as t")
    export.write_json_array(rows, str(tmp_path / "a.json"))
    back = json.loads((tmp_path / "a.json").read_text())
    assert sorted((x["id"], x["t"]) for x in back if x["t"]) == [(i, f'"{i}') for i in range(1, 1000, 2)] and len(back) == 1000
    export.write_json_array(rows.limit(0), str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text()) == [] and len(list(tmp_path.glob("*.parts-*"))) == 0


def test_content_hash_escapes_its_bars(spark):
    from noticeloom.sinks import export

    h = lambda *row: export.content_hash(spark.createDataFrame([row], "a string, b string")).first().content_hash
    assert len({h("x|y", "z"), h("x", "y|z"), h("x\\", "y"), h("x\\|", "y"), h(None, "y"), h("\\N", "y")}) == 6


def test_sequence_checksum_follows_the_order(spark):
    import hashlib

    from noticeloom.operators import features

    df = spark.createDataFrame([(2, "b", "y"), (1, "a", None)], "n int, t string, u string")
    got = features.sequence_checksum(df, [F.col("t"), F.col("u")], ["n"]).first()
    assert (got.n, got.checksum) == (2, hashlib.sha256(b"a\0\0b\0y\0").hexdigest())
