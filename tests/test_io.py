"""Sources, sinks and streams."""

import csv
import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from noticeloom.sinks import export
from noticeloom.sources import files
from noticeloom.streaming import ingest

GOLD = "id long, person_key string, effective_date date, appointment_type string, fields string, version int, is_current int, superseded_by long"


def gold(spark):
    rows = [(7, "田,中", dt.date(2020, 1, 2), "transfer", '{"name":{"value":"n","raw":"r"},"rank":null,"org":{"value":"u","raw":null}}', 2, 1, None), (8, 'q"x', None, None, "{}", 1, 0, 7)]
    return spark.createDataFrame(rows, GOLD)


def test_flat_export_and_files(spark, tmp_path):
    flat = export.flatten(gold(spark))
    assert flat.columns == export.COLUMNS and len(flat.columns) == 21
    a, b = flat.orderBy("id").collect()
    assert (a.id, a.person_raw, a.rank_value, a.organization_value, a.is_current, a.superseded_by) == ("gold-00000007", "r", None, "u", True, None)
    assert (b.superseded_by, b.effective_date, b.is_current) == ("gold-00000007", None, False)
    export.write_csv(flat.orderBy("id"), str(tmp_path / "c"), one_file=True)
    raw = next((tmp_path / "c").glob("*.csv")).read_bytes()
    assert raw.count(b"\r\n") == 3
    back = list(csv.DictReader(raw.decode().splitlines()))
    assert (back[0]["person_value"], back[0]["is_current"], back[0]["rank_value"]) == ("田,中", "True", "")
    export.write_json(flat, str(tmp_path / "j"))
    lines = [json.loads(x) for p in (tmp_path / "j").glob("*.json") for x in p.read_text().splitlines()]
    assert len(lines) == 2 and all(len(x) == 21 for x in lines)
    export.write_parquet(flat.limit(0), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).columns == export.COLUMNS
    assert len(json.loads(export.json_array(flat).first().json)) == 2


def test_content_hash_is_of_content(spark):
    flat = export.flatten(gold(spark))
    h = lambda d: tuple(export.content_hash(d).first())
    assert h(flat) == h(flat.orderBy(F.desc("id")).repartition(3)) and h(flat) != h(flat.limit(1)) != h(flat.unionByName(flat))
    assert h(flat.limit(0))[0] == 0
    made = export.artifact(flat, "csv", "2026-01-01 00:00:00", "x").first()
    assert (made.record_count, made.checksum) == h(flat)


def test_publish_keeps_what_was_there(spark, tmp_path):
    for n in ("1", "2", "3"):
        (tmp_path / f"s{n}").mkdir()
        (tmp_path / f"s{n}" / "f").write_text(n)
        export.publish(spark, str(tmp_path / f"s{n}"), str(tmp_path / "out"))
    assert (tmp_path / "out" / "f").read_text() == "3" and (tmp_path / "out.bak" / "f").read_text() == "2"
    with pytest.raises(FileNotFoundError):
        export.publish(spark, str(tmp_path / "none"), str(tmp_path / "out"))


def test_stored_files(spark, tmp_path):
    for name, body in {"a.pdf": b"%PDF-1.4\nrest", "b.pdf": b"%PDF-9.9", "c.pdf": b"%PDF-", "d.pdf": b" %PDF-1.4"}.items():
        (tmp_path / name).write_bytes(body)
    found = files.stored(spark, str(tmp_path))
    got = {r.file_name: r for r in found.collect()}
    assert [(got[n].version, got[n].warnings) for n in ("a.pdf", "b.pdf", "c.pdf", "d.pdf")] == [("1.4", []), ("9.9", ["UNSUPPORTED_VERSION"]), ("unknown", ["UNSUPPORTED_VERSION"]), ("unknown", ["UNSUPPORTED_VERSION"])]
    assert got["a.pdf"].content_hash == hashlib.sha256(b"%PDF-1.4\nrest").hexdigest()
    assert files.pages(found).where("error is not null").count() == 4


def test_manifests_and_dictionaries(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "m" / "b").mkdir(parents=True)
    (tmp_path / "m" / "b" / "manifest.yaml").write_text("era_id: B\nversion: 2\nrules:\n- {rule_id: r, kind: header_pattern, value: H, weight: 1}\n")
    assert [(r.layout_id, r.version, r.rules[0].weight) for r in files.manifests(spark, str(tmp_path / "m")).collect()] == [("B", 2, 1.0)]
    (tmp_path / "m" / "b" / "manifest.yaml").write_text("era_id: B\nversion: 2\nrules: []\n")
    with pytest.raises(ValueError):
        files.manifests(spark, str(tmp_path / "m"))
    (tmp_path / "k" / "ranks").mkdir(parents=True)
    (tmp_path / "k" / "layout_notes" / "deep").mkdir(parents=True)
    (tmp_path / "k" / "ranks" / "x.yaml").write_text("items:\n- {item_key: a, canonical_value: b, effective_from: 2020-01-01, provenance_source: p}\n- {item_key: 3, canonical_value: d, effective_to: '2021-01-01', provenance_source: p, version: 2}\n")
    (tmp_path / "k" / "layout_notes" / "deep" / "y.yaml").write_text("items:\n- {item_key: L.column_1, canonical_value: name, provenance_source: p}\n")
    got = [tuple(r) for r in files.dictionary(spark, str(tmp_path / "k")).orderBy("id").collect()]
    assert got == [(1, "rank", "ranks/x.yaml", "a", "b", dt.date(2020, 1, 1), None, "p", 1, 1), (2, "rank", "ranks/x.yaml", "3", "d", None, dt.date(2021, 1, 1), "p", 2, 2), (3, "layout", "layout_notes/deep/y.yaml", "L.column_1", "name", None, None, "p", 1, 3)]
    for bad in ("- a\n", "items: {a: 1}\n", "items:\n- {item_key: a, canonical_value: b}\n", "items:\n- a\n"):
        (tmp_path / "k" / "ranks" / "x.yaml").write_text(bad)
        with pytest.raises(ValueError):
            files.dictionary(spark, str(tmp_path / "k"))
    with pytest.raises(FileNotFoundError):
        files.dictionary(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        files.fetch("file:///etc/passwd")


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"text {i % 7}", dt.datetime(2020, 1, 1 + i % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, text string, ts timestamp")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = lambda: ingest.arrivals(spark, str(tmp_path / "in"), df.schema, 1)
    ingest.drain(ingest.first_seen(stream(), "text", "ts"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [f"text {i}" for i in range(7)]
    spark.createDataFrame([(99, "text 3", dt.datetime(2020, 1, 3)), (98, "new", dt.datetime(2020, 1, 3))], df.schema).write.mode("append").parquet(str(tmp_path / "in"))
    ingest.drain(ingest.first_seen(stream(), "text", "ts"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 8
    seen = []
    ingest.versions(stream(), lambda batch, i: seen.append(batch.count()), str(tmp_path / "cp2"))
    assert sum(seen) == 42
    whole = ingest.arrivals(spark, str(tmp_path / "in"), df.schema)
    ingest.drain(ingest.counts(whole, "ts", [], "1 day", "1 day"), str(tmp_path / "n"), str(tmp_path / "cp3"))
    assert {r.start.day: r.n for r in spark.read.parquet(str(tmp_path / "n")).collect()} == {1: 8, 2: 8, 3: 10}  # the rest is still open


def test_fonts_of_a_page():
    class Ref:
        def __init__(self, base):
            self.base = base

        def get_object(self):
            return {"/BaseFont": self.base} if self.base else {}

    page = {"/Resources": {"/Font": {"/F1": Ref("/MS-Mincho"), "/F2": Ref("/Arial"), "/F3": Ref(None), "/F4": Ref("/Arial"), "/F5": 3}}}
    assert files._fonts(page) == ["Arial", "MS-Mincho"] and files._fonts({}) == [] and files._fonts({"/Resources": {}}) == []
