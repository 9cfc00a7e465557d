import datetime as dt

import pytest

from noticeloom.operators import references

T = lambda d: dt.datetime(2020, 1, d)


def test_one_column_with_times(spark):
    parent = spark.createDataFrame([(1, T(5)), (1, T(2)), (2, T(9)), (3, None), (None, T(1))], "id long, since timestamp")
    rows = [(10, 1, T(2), "a"), (11, 1, T(1), "b"), (12, 2, T(8), None), (13, 3, T(1), "c"), (14, 4, T(9), "d"), (15, None, T(1), "e"), (16, 2, None, "f"), (14, 4, T(9), "d")]
    child = spark.createDataFrame(rows, "row long, ref long, at timestamp, reason string")
    got = sorted((r.row, r.reason) for r in references.orphans(child, parent, [("ref", "id")], times=("at", "since")).collect())
    assert got == [(11, "later"), (12, "later"), (14, "missing"), (14, "missing")]
    assert "reason_in" in references.orphans(child, parent, [("ref", "id")]).columns


@pytest.mark.parametrize("match, want", [("simple", {3}), ("partial", {3, 5}), ("full", {3, 4, 5, 6})])
def test_composite_keys(spark, match, want):
    parent = spark.createDataFrame([("x", 1), ("y", 2), (None, 1)], "a string, b int")
    child = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "x", 2), (4, "x", None), (5, "z", None), (6, None, 2), (7, None, None)], "id int, a string, b int")
    assert {r.id for r in references.orphans(child, parent, [("a", "a"), ("b", "b")], match=match).collect()} == want


def test_empty_sides(spark):
    child = spark.createDataFrame([(1, 5)], "id long, ref long")
    none = spark.createDataFrame([], "id long, ref long")
    assert references.orphans(child, none.select("id"), [("ref", "id")]).count() == 1
    assert references.orphans(none, child, [("ref", "id")]).count() == 0
    with pytest.raises(ValueError):
        references.orphans(child, none, [("ref", "id")], match="some")
