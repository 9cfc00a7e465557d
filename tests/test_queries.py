"""Every query with SQL against DuckDB over whole tables, where the test data is at hand."""

import math
import os
from collections import Counter

import pytest

import __spark_entry__ as entry
from noticeloom.plans import core, reference

FOLDER = os.environ.get("NOTICELOOM_DATA", "/root/testdata/sf0.001")
TABLES = "pdfs layouts parser_versions personnel_sections raw_records gold_records knowledge_items jobs documents events eval_items doc_labels mix_targets deleted_rows".split()


def plain(v):
    if v is None or str(v) in ("NaT", "<NA>", "nan"):
        return None
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else None
    if hasattr(v, "isoformat"):
        return v.isoformat().replace("T", " ").replace(" 00:00:00", "")
    return v if isinstance(v, (str, bool)) else round(float(v), 9)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.exists(f"{FOLDER}/gold_records.parquet"):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted({**core.ORACLES, **reference.ORACLES}))
def test_query_equals_sql(spark, duck, name):
    if name in ("audit_rollup", "audit_counts"):
        pytest.skip("repeats every check")
    query, sql = {**core.QUERIES, **reference.QUERIES}[name], {**core.ORACLES, **reference.ORACLES}[name]
    want = duck.execute(sql).fetchdf()
    df = query(spark, FOLDER)
    got = df.toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda pdf: Counter(tuple(map(plain, r)) for r in pdf[columns].itertuples(index=False, name=None))
    assert rows(got) == rows(want)


def test_entry_point(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    if os.path.exists("/root/testdata/sf0.001"):
        assert entry.entry(spark).count() > 0
