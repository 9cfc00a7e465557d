"""Each check with a clean and a dirty table, metrics and features."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from noticeloom.operators import audit, features, metrics

T = lambda d, h=0: dt.datetime(2020, 1, d, h)
S = "id long, doc long, place int, status string, released timestamp_ntz"


def test_active_sections(spark):
    dirty = spark.createDataFrame([(1, 1, 0, "parsed", T(1)), (2, 1, 0, "parsed", T(2)), (3, 2, 0, "parsed", T(1)), (4, 2, 0, "superseded", T(3)), (5, 3, 0, "superseded", T(1))], S)
    clean = spark.createDataFrame([(1, 1, 0, "parsed", T(2)), (2, 1, 0, "superseded", T(1)), (3, 1, 1, "parsed", T(1))], S)
    keys, active = ["doc", "place"], F.col("status") == "parsed"
    checks = [
        (lambda d: audit.duplicated(d.where(active), keys), [(1, 0, 2)]),
        (lambda d: audit.newer_not_active(d, keys, active, "released"), [(3, 4)]),
        (lambda d: audit.without_sibling(d, keys, ~active, active).select("id"), [(5,)]),
    ]
    for check, found in checks:
        assert [tuple(r) for r in check(dirty).collect()] == found
        assert check(clean).count() == 0
        assert check(dirty.limit(0)).count() == 0


def test_references(spark):
    parent = spark.createDataFrame([(1, "x"), (2, "y")], "id long, era string")
    child = spark.createDataFrame([(10, 1, "x"), (11, 3, "x"), (12, None, "x"), (13, 2, "x")], "row long, ref long, mine string")
    assert [r.row for r in audit.dangling(child, "ref", parent).collect()] == [11]
    assert [r.row for r in audit.mismatched(child, "ref", parent, "id", F.col("era") != F.col("mine")).collect()] == [13]
    assert audit.dangling(child.where("row = 10"), "ref", parent).count() == 0
    log = spark.createDataFrame([("a", 1), ("a", 9), ("b", 2), ("b", 1), ("c", 1), (None, 1)], "t string, r long")
    got = audit.dangling_by_kind(log, "t", "r", {"a": parent, "b": parent.where("id = 2")})
    assert sorted((r.t or "", r.r) for r in got.collect()) == [("", 1), ("a", 9), ("b", 1), ("c", 1)]


def test_jobs(spark):
    jobs = spark.createDataFrame([(1, "running", T(1), None), (2, "running", T(3, 1), None), (3, "failed", T(1), None), (4, "running", T(3), T(3, 5)), (5, "succeeded", T(1), T(2))], "id long, status string, started_at timestamp_ntz, finished_at timestamp_ntz")
    assert [r.id for r in audit.stale(jobs, F.lit("2020-01-04 00:00:00").cast("timestamp_ntz")).orderBy("id").collect()] == [1]
    assert [r.id for r in audit.contradictory(jobs).orderBy("id").collect()] == [3, 4]
    assert [(r.n_ended, r.success_rate) for r in metrics.success_rate(jobs.withColumn("k", F.lit(1)), ["k"]).collect()] == [(2, 0.5)]
    assert jobs.where("id = 5").select(metrics.elapsed_ms(F.col("started_at"), F.col("finished_at")).alias("e")).first().e == 86400000


def test_cycles_and_rollup(spark):
    rows = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, 5), (5, None)], "id long, up long")
    assert sorted(tuple(r) for r in audit.cycles(rows, "id", "up").collect()) == [(1, 1), (2, 1), (3, 1)]
    assert audit.cycles(rows.where("id > 3"), "id", "up").count() == 0
    counts = lambda *n: spark.createDataFrame([("a", "error", n[0]), ("b", "warning", n[1])], "check_id string, severity string, n long")
    assert [tuple(audit.rollup(counts(*n)).first()) for n in ((0, 0), (0, 2), (1, 2))] == [(0, 0), (2, 1), (3, 2)]


def test_growth_and_next_run(spark):
    rows = spark.createDataFrame([(T(1),), (T(2),), (dt.datetime(2020, 2, 1),), (None,)], "t timestamp_ntz")
    assert [(r.n, r.change) for r in metrics.growth(rows, "t").orderBy("period").collect()] == [(2, None), (1, -0.5)]
    times = spark.createDataFrame([(T(1),), (T(1, 5),), (T(3),)], "t timestamp_ntz")
    runs = times.select(metrics.next_run(F.col("t"), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"), 86400).cast("timestamp_ntz").alias("r")).collect()
    assert [r.r for r in runs] == [T(1), T(2), T(3)]


def test_quantiles_are_exact(spark):
    rows = spark.createDataFrame([("a", float(v)) for v in (1, 1, 2, 7, 9, 9, 30)] + [("b", 4.0), ("c", None)], "k string, v double")
    got = {r.k: (r.n, r.mid, r.high) for r in metrics.quantiles(rows, ["k"], F.col("v"), {"mid": 0.5, "high": 0.95}).collect()}
    assert got["a"][:2] == (7, 7.0) and abs(got["a"][2] - 23.7) < 1e-9 and got["b"] == (1, 4.0, 4.0) and "c" not in got


def test_features(spark):
    fields = [("a", "x"), ("b", " 　"), ("c", None), ("d", "�")]
    df = spark.createDataFrame([(fields,), ([],)], "f array<struct<name:string,value:string>>")
    assert [tuple(r) for r in df.select(features.fill_rate(F.col("f")), features.suspicious_rate(F.col("f"))).collect()] == [(0.5, 0.25), (0.0, 0.0)]
    changed = spark.createDataFrame([([("a", "a"), ("a", None), (None, None)],)], "f array<struct<value:string,raw:string>>")
    assert changed.select(features.change_rate(F.col("f")).alias("c")).first().c == 1 / 3
    want = int.from_bytes(hashlib.sha256(b"L:-:3").digest()[:8], "big") & (1 << 63) - 1
    assert spark.range(1).select(features.subject_ref(F.lit("L"), F.lit(None), F.lit(3)).alias("s")).first().s == want
    rates = spark.createDataFrame([({"a_rate": 1.5, "b_rate": 1.0, "other": 9.0},)], "m map<string,double>")
    assert rates.select(features.in_range(F.col("m")).alias("m")).first().m == {"a_rate": 1.5}
