import datetime as dt
import random

import pytest

from noticeloom.operators import asof

EVENTS = "gold_id long, org string, day date, at timestamp_ntz, item_id string"
ITEMS = "id long, item_key string, value string, since date, until date, known timestamp_ntz"


def run(events, items, **options):
    return asof.as_known(events, items, key=("org", "item_key"), event_date="day", event_known="at", item_id="id", item_value="value", valid=("since", "until"), item_known="known", **options)


def brute(event, items):
    _, org, day, at, _ = event
    if None in (org, day, at):
        return None
    fit = [x for x in items if x[0] is not None and x[1] == org and x[5] is not None and (x[3] is None or x[3] <= day) and (x[4] is None or day < x[4]) and x[5] <= at]
    return max(fit, key=lambda x: (x[3] or dt.date.min, x[5], x[0]))[0] if fit else None


def made(seed, n):
    r = random.Random(seed)
    day = lambda: dt.date(2012, 1, 1) + dt.timedelta(r.randrange(3000))
    time = lambda: dt.datetime(2011, 1, 1) + dt.timedelta(hours=r.randrange(80000))
    maybe = lambda x, p=0.15: None if r.random() < p else x
    items = [(i, maybe(r.choice("ab"), 0.03), f"v{i}", maybe(day()), maybe(day(), 0.4), maybe(time(), 0.03)) for i in range(n)]
    events = [(i, maybe(r.choice("abc"), 0.05), maybe(day(), 0.05), maybe(time(), 0.05), "own") for i in range(4 * n)]
    return events, items


@pytest.mark.parametrize("seed, months, changes, limit", [(1, 12, 256, 8 << 20), (2, 3, 2, 0)])
def test_against_brute_force(spark, monkeypatch, seed, months, changes, limit):
    monkeypatch.setattr(asof, "CHANGES_PER_SNAPSHOT", changes)
    events, items = made(seed, 60)
    got = run(spark.createDataFrame(events + events[:3], EVENTS), spark.createDataFrame(items + items[:5], ITEMS), months=months, broadcast_bytes=limit)
    assert got.columns == ["gold_id", "org", "day", "at", "item_id_in", "item_id", "item_value"]
    rows = got.collect()
    assert len(rows) == len(events) + 3
    want = {e[0]: brute(e, items) for e in events}
    assert {r.gold_id: r.item_id for r in rows} == want
    assert all(r.item_value == (None if r.item_id is None else f"v{r.item_id}") for r in rows)


def test_empty(spark):
    events, items = made(3, 5)
    e, i = spark.createDataFrame(events, EVENTS), spark.createDataFrame(items, ITEMS)
    assert run(e, i.limit(0)).where("item_id is null").count() == len(events)
    assert run(e.limit(0), i).count() == 0


def test_a_year_of_many_changes(spark):
    at = dt.datetime(2020, 1, 1)
    items = [(i, "a", f"v{i}", dt.date(2019, 1, 1), None, at + dt.timedelta(minutes=i)) for i in range(1500)]
    events = [(i, "a", dt.date(2020, 5, 5), at + dt.timedelta(minutes=i, seconds=30), "") for i in (0, 3, 700, 1499, 9000)]
    got = {r.gold_id: r.item_id for r in run(spark.createDataFrame(events, EVENTS), spark.createDataFrame(items, ITEMS)).collect()}
    assert got == {0: 0, 3: 3, 700: 700, 1499: 1499, 9000: 1499}
