"""Life cycle, documents, exports and settings: every query against its SQL, and odd input."""

import datetime as dt
import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from noticeloom import settings
from noticeloom.operators import documents, extract, features, layout, lifecycle, lookup, metrics
from noticeloom.plans import operations
from noticeloom.sinks import export
from noticeloom.sources import tables
from noticeloom.streaming import ingest

from test_queries import FOLDER, duck, plain  # noqa: F401


@pytest.mark.parametrize("name", sorted(operations.ORACLES))
def test_query_equals_sql(spark, duck, name):  # noqa: F811
    want = duck.execute(operations.ORACLES[name]).fetchdf()
    got = operations.QUERIES[name](spark, FOLDER).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda pdf: Counter(tuple(map(plain, r)) for r in pdf[columns].itertuples(index=False, name=None))
    assert rows(got) == rows(want)


def test_stages_carry_their_first_failure(spark):
    df = spark.createDataFrame([(1, None, None), (2, "bad", "worse"), (3, None, "late"), (None, None, None)], "id long, a string, b string")
    ran = lifecycle.run_stages(df, [("section", F.col("a")), ("document", F.col("b"))])
    assert {r.id: (r.failed_stage, r.error) for r in ran.collect()} == {1: (None, None), 2: ("section", "bad"), 3: ("document", "late"), None: (None, None)}
    events = lifecycle.stage_events(ran, ["section", "document"], "id").where("id in (1, 2)").orderBy("id", "stage_index").collect()
    assert [r.event for r in events] == ["completed", "completed", "failed", "skipped"]
    assert [tuple(r) for r in lifecycle.failures(ran, "id").collect()] == [(2, "section", "bad")]


def test_three_grains(spark):
    docs = spark.createDataFrame([(1, False), (2, False), (3, True), (4, False)], "document long, failed boolean")
    sections = spark.createDataFrame([(1, 10, False), (1, 11, False), (2, 20, True), (9, 90, True)], "document long, section long, failed boolean")
    records = spark.createDataFrame([(10, False), (10, False), (11, True), (None, True)], "section long, failed boolean")
    got = {r.document: (r.n_sections, r.n_records, r.n_failed, r.status) for r in lifecycle.coordinated(docs, sections, records).collect()}
    assert got == {1: (2, 3, 1, "failed"), 2: (1, 0, 1, "failed"), 3: (0, 0, 1, "failed"), 4: (0, 0, 0, "validated")}


def test_states_patches_and_ledgers(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    checked = spark.createDataFrame([(1, True), (1, True), (2, True), (2, False), (9, True)], "id long, passed boolean")
    assert {r.id: r.state for r in lifecycle.states(ids(1, 2, 3, 4, 4), ids(1, 2, 3), checked, "id").collect()} == {1: "passed", 2: "failed", 3: "normalized", 4: "raw", 9: "lost"}
    rows = spark.createDataFrame([(1, "a", 5), (2, "b", None)], "id long, s string, n int")
    patches = spark.createDataFrame([(1, None, 7), (1, "z", None), (8, "q", 1)], rows.schema)
    assert sorted(tuple(r) for r in lifecycle.patched(rows, patches, "id", ("s", "n")).collect()) == [(1, "z", 7), (2, "b", None)]
    with pytest.raises(ValueError):
        lifecycle.patched(rows, patches, "id", ("s",))
    events = spark.createDataFrame([(1, "running", 1), (1, "failed", 3), (1, "succeeded", 5), (2, "running", 2), (3, "failed", 4), (3, "running", 6)], "id long, status string, at int")
    assert {r.id: (r.status, r.started_at, r.finished_at) for r in lifecycle.ledger(events, "id", ["at"]).collect()} == {1: ("succeeded", 1, 3), 2: ("running", 2, None), 3: ("running", 4, None)}
    stored, new = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id long, v string, n int"), spark.createDataFrame([(1, "c", 1), (3, "d", 0), (None, "e", 9), (2, "old", 0)], "id long, v string, n int")
    assert sorted(tuple(r) for r in lifecycle.upserted(stored, new, "id", ["n"]).collect()) == [(1, "c", 1), (2, "b", 1), (3, "d", 0)]
    assert [tuple(r) for r in lifecycle.unregistered(stored.select("id").unionByName(ids(7, 7)), ids(1), ["id"]).orderBy("id").collect()] == [(2,), (7,)]
    assert {r.id: r.change for r in lifecycle.compared(stored, new, ["id"], "v").collect()} == {1: "changed", 2: "changed", 3: "added", None: "added"}


def test_deliveries_close_open_rows(spark):
    d = lambda n: dt.date(2020, 1, n)
    rows = [(1, "k", "a", "f", None, None, 1), (2, "k", "a", "f", d(2), None, 2), (3, "k", "a", "g", d(9), None, 3), (4, "k", "b", "g", None, None, 4), (5, "k", "b", "g", None, None, 5), (6, "k", "c", "g", None, d(8), 6), (7, "k", "c", "g", None, None, 7), (8, "j", None, "f", None, None, 1)]
    df = spark.createDataFrame(rows, "id long, k string, v string, f string, effective_from date, effective_to date, day int")
    got = {r.id: (r.effective_from, r.effective_to) for r in lifecycle.delivered(df, ["k"], ["v", "f"], [F.col("day")], F.make_date(F.lit(2020), F.lit(2), F.col("day"))).collect()}
    assert got == {1: (None, d(9)), 3: (d(9), dt.date(2020, 2, 4)), 4: (None, dt.date(2020, 2, 6)), 6: (None, d(8)), 7: (None, None), 8: (None, None)}


def test_documents(spark):
    pages = [(1, "ab", 0, 1), (1, None, 90, 3), (2, "", 450, 2), (2, "", -90, 0), (3, "text", 0, 0), (5, "", 0, 0), (7, "", 0, 0)]
    p = spark.createDataFrame(pages, "doc_id long, text string, rotation int, image_count int")
    files = [(1, 1, "1.4", False, False), (2, 60 << 20, "1.4", False, False), (3, 1, "1.4", False, False), (4, 1, None, False, True), (5, 1, "9", True, False), (6, 1, "1.7", False, False), (7, None, "1.4", False, False)]
    f = spark.createDataFrame(files, "doc_id long, size long, version string, encrypted boolean, broken boolean")
    got = {r.doc_id: (r.page_count, r.text_length, r.image_count, r.rotation_count, r.warnings, r.score, r.band) for r in documents.analysed(f, p).collect()}
    assert got[1] == (2, None, 1, 0, ["UNKNOWN_ENCODING"], 0.6, "medium")
    assert got[2] == (2, 0, 2, 2, ["IMAGE_ONLY", "LARGE_FILE"], 0.6, "medium")
    assert got[3] == (1, 4, 0, 0, [], 1.0, "verified") and got[6] == (0, 0, 0, 0, [], 1.0, "verified")
    assert got[4] == (0, 0, 0, 0, ["BROKEN", "UNSUPPORTED_VERSION"], 0.0, "low") and got[5][4] == ["ENCRYPTED", "UNSUPPORTED_VERSION"] and got[7][4] == ["IMAGE_ONLY"]


def test_layout_candidates_and_pages(spark):
    manifest = spark.createDataFrame([(0, "a", [("h", "header_pattern", "H", 0.5), ("m", "font_name_contains", "Mincho", 0.5)]), (1, "b", [("h", "header_pattern", "H", 1.0)])], f"ordinal int, layout_id string, rules {layout.RULES}")
    pages = spark.createDataFrame([(1, 0, "H", ["MS-Mincho"], 90, 2.0, 4.0), (1, 1, "x", ["B", "MS-Mincho"], 0, 4.0, 4.0), (1, 2, "x", [], 360, 3.0, 1.0), (1, 3, "x", None, 450, 3.0, 1.0), (2, 0, "H", [], 0, 1.0, 1.0)], "doc_id int, page_index int, text string, fonts array<string>, rotation int, width double, height double")
    got = [(r.doc_id, r.place, r.layout_id, r.score, r.matched, r.failed) for r in layout.candidates(layout.evidence(pages), manifest).orderBy("doc_id", "place").collect()]
    assert got == [(1, 1, "a", 1.0, ["h", "m"], []), (1, 2, "b", 1.0, ["h"], []), (2, 1, "b", 1.0, ["h"], []), (2, 2, "a", 0.5, ["h"], ["m"])]
    seen = {r.doc_id: (r.page_count, r.mean_width, r.mean_height, r.rotated_pages, r.dominant_rotation, r.fonts) for r in layout.page_features(pages).collect()}
    assert seen == {1: (4, 3.0, 2.5, 2, 90, ["B", "MS-Mincho"]), 2: (1, 1.0, 1.0, 0, 0, [])}
    assert layout.page_features(pages.limit(0)).count() == 0


def test_zipped_features_and_patterns(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [1, 2]), (2, [], [])], "id int, x array<string>, y array<int>")
    assert [tuple(r) for r in extract.zipped(df, "x", "y").collect()] == [(1, 0, "a", 1), (1, 1, "b", 2)]
    with pytest.raises(Exception, match="unequal"):
        extract.zipped(df.select("id", "x", F.array(F.lit(1)).alias("y")), "x", "y").collect()
    rows = spark.createDataFrame([(1, {"fill_rate": 0.5, "n": 9.0}), (2, {"fill_rate": 1.5}), (3, {"fill_rate": None})], "id int, features map<string,double>")
    good, bad = features.quarantined(rows)
    assert sorted(r.id for r in good.collect()) == [1, 3] and [(r.id, r.outside) for r in bad.collect()] == [(2, {"fill_rate": 1.5})]
    assert {r.id: r.v for r in rows.select("id", features.feature(F.col("features"), "fill_rate", -1.0).alias("v")).collect()} == {1: 0.5, 2: 1.5, 3: -1.0}
    named = spark.createDataFrame([([("a", "1"), ("b", "2")], [("b", None), ("a", "x"), ("a", "y")]), ([("a", "1")], [])], "x array<struct<name:string,value:string>>, y array<struct<name:string,value:string>>")
    assert [r.s for r in named.select(features.same_keys(F.col("x"), F.col("y")).alias("s")).collect()] == [True, False]
    values = spark.createDataFrame([("a", "x--y"), ("b", "x--y"), ("b", None)], "f string, v string")
    assert [r.v for r in lookup.scoped_patterns(values, [("*", "-+", "-"), ("b", "^x", "z")], "f", "v").collect()] == ["x-y", "z-y", None]


def test_operations_numbers(spark):
    at = lambda day: dt.datetime(2020, 1, 6) + dt.timedelta(days=day)
    jobs = spark.createDataFrame([(i, "k", "failed" if i == 3 else "succeeded", at(d)) for i, d in enumerate([0, 7, 8, 14, 15, 16])] + [(9, "k", "running", at(20)), (10, "o", "running", None)], "id long, kind string, status string, started_at timestamp_ntz")
    assert {r.kind: (r.n_periods, r.slope) for r in metrics.slope(jobs.where("status <> 'running'"), ["kind"], "started_at").collect()} == {"k": (3, 1.0)}
    burn = {r.kind: (r.n_ended, r.burn and round(r.burn, 6), r.alert) for r in metrics.budget_burn(jobs, ["kind"], 0.75).collect()}
    assert burn == {"k": (6, round(1 / 1.5, 6), 50), "o": (0, None, 0)}
    assert [(r.n_runs, r.all_succeeded) for r in metrics.last_runs(jobs, ["kind"], 2).collect()] == [(2, True)] and not metrics.last_runs(jobs, ["kind"], 3).first().all_succeeded


GOLD = "id long, person_key string, effective_date date, appointment_type string, fields string, version int, is_current int, superseded_by long"


def test_exports_gate_and_ledger(spark, tmp_path):
    gold = spark.createDataFrame([(7, "田", dt.date(2020, 1, 2), "t", '{"rank":{"value":"v","raw":null}}', 1, 1, None), (8, None, None, "t", "{}", 0, 0, 7)], GOLD)
    one = json.loads(export.nested(gold).where("id = 'gold-00000007'").first().json)
    assert one["rank"] == {"value": "v", "raw": None} and one["confidence"] == {"score": 1.0, "band": "verified"} and one["source_pdf"]["source_url"] is None
    flat = export.flatten(gold)
    assert sorted(map(str, export.unnested(export.nested(gold)).collect())) == sorted(map(str, flat.collect()))
    assert {(r.id, r.problem) for r in export.broken_constraints(flat).collect()} == {("gold-00000008", p) for p in ("person_value", "effective_date", "version")}
    row = export.export(flat, "json_array", str(tmp_path / "x.json"), str(tmp_path / "runs"), "2026-01-01 00:00:00").first()
    export.export(flat, "csv", str(tmp_path / "c"), str(tmp_path / "runs"), "2026-01-02 00:00:00")
    assert row.record_count == 2 and [r.format for r in export.recent_exports(spark, str(tmp_path / "runs"), 1).collect()] == ["csv"]
    with pytest.raises(ValueError):
        export.export(flat, "xls", "x", "y", "z")
    findings = lambda n: spark.createDataFrame([("a", "error", n), ("b", "warning", 5)], "check_id string, severity string, n long")
    with pytest.raises(ValueError, match="a"):
        export.publish_if_clean(spark, findings(1), str(tmp_path / "c"), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
    export.publish_if_clean(spark, findings(0), str(tmp_path / "c"), str(tmp_path / "out"))
    assert (tmp_path / "out").exists()


def test_samples_are_the_first_of_each_check(spark):
    got = lifecycle.samples({"x": spark.range(100, 150), "none": spark.range(0)}, 3).collect()
    assert [(r.check_id, r.sample_no, r.sample) for r in got] == [("x", 1, "100"), ("x", 2, "101"), ("x", 3, "102")]


def test_tables_are_created_once(spark, tmp_path):
    tables.create(spark, str(tmp_path), {"t": "id long, at timestamp_ntz"})
    spark.createDataFrame([(1, None)], "id long, at timestamp_ntz").write.mode("append").parquet(str(tmp_path / "t.parquet"))
    tables.create(spark, str(tmp_path), {"t": "id long, at timestamp_ntz"})
    assert tables.table(spark, str(tmp_path), "t").count() == 1


def test_a_late_correction_takes_its_place(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame([(i, "p", dt.datetime(2020, 1, d)) for i, d in x], "id long, person string, created_at timestamp_ntz")
    rows((1, 1), (2, 9)).write.parquet(str(tmp_path / "in"))
    stream = lambda: ingest.arrivals(spark, str(tmp_path / "in"), rows((1, 1)).schema)
    ingest.append_facts(stream(), str(tmp_path / "facts"), str(tmp_path / "cp"))
    rows((3, 5)).write.mode("append").parquet(str(tmp_path / "in"))
    ingest.append_facts(stream(), str(tmp_path / "facts"), str(tmp_path / "cp"))
    from noticeloom.operators import versions

    got = versions.chained(spark.read.parquet(str(tmp_path / "facts")).drop("batch"), ["person"], [F.col("created_at")], since="created_at").collect()
    assert {r.id: r.superseded_by for r in got} == {1: 3, 3: 2, 2: None}


def test_settings_precedence(tmp_path):
    defaults = {"folder": "x", "limit": 3, "strict": False, "ftp": {"host": None, "port": 21}}
    (tmp_path / ".env").write_text("# note\nexport NOTICELOOM_FOLDER='f'\nNOTICELOOM_LIMIT=5\nNOTICELOOM_FTP__PORT=22\nNOTICELOOM_STRICT=\n")
    env = {"NOTICELOOM_LIMIT": "7", "NOTICELOOM_FOLDER": "", "NOTICELOOM_FTP__HOST": "h", "NOTICELOOM_STRICT": "true"}
    got = settings.load(defaults, {"limit": None, "ftp": {"port": 9}}, env, str(tmp_path / ".env"))
    assert got == {"folder": "f", "limit": 7, "strict": True, "ftp": {"host": "h", "port": 9}}
    assert settings.load(defaults, {"limit": 1}, {}) == defaults | {"limit": 1}
    with pytest.raises(ValueError):
        settings.load(defaults, {"other": 1}, {})
    assert os.environ.get("NOTICELOOM_LIMIT") is None
