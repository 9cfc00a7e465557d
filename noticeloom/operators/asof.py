"""Attributes as known at event time.

Attribute rows have a validity [valid_from, valid_to) and the time they became known. They are turned into as-known
snapshots, one for each key, year of validity and period of knowledge, plus the log of what became known within the
period. An event meets the snapshot that precedes it and replays only the changes known by its own time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import BROADCAST_BYTES, Scratch, apart, broadcast_if_small

#: Length of a period of knowledge, and the number of changes after which a new snapshot is taken within a period.
PERIOD_MONTHS = 12
CHANGES_PER_SNAPSHOT = 256

#: States that travel in one row.
STATES_PER_ROW = 16

_SEGMENT = "struct<day_from:date,day_to:date,item_id:bigint,item_value:string,item_from:date,item_known:timestamp_ntz>"
_CHANGE = "struct<item_id:bigint,item_value:string,item_from:date,item_to:date,item_known:timestamp_ntz>"
_STATE = f"key string, year int, starts timestamp_ntz, ends timestamp_ntz, states array<struct<starts:timestamp_ntz,ends:timestamp_ntz,snapshot:array<{_SEGMENT}>,changes:array<{_CHANGE}>>>"


def _period(column: Column, months: int) -> Column:
    return F.floor((F.year(column) * 12 + F.month(column) - 1) / months).cast("int")


def _period_start(period: int, months: int) -> dt.datetime:
    year, month = divmod(period * months, 12)
    return dt.datetime(max(1, min(year, 9999)), month + 1, 1)


class _Timeline:
    """What holds on each day of one year, as far as it is known: the item with the latest start, of equal starts the
    one known last, then the greatest id (items arrive in order of becoming known and id)."""

    def __init__(self, year: int):
        self.first = dt.date(year, 1, 1)
        self.days = (dt.date(year, 12, 31) - self.first).days + 1
        self.start = np.full(self.days, -(1 << 40))
        self.item = np.full(self.days, -1)
        self.items: list[tuple] = []

    def add(self, item: tuple) -> None:
        _, _, begins, ends, _ = item
        lo = max(0, (begins - self.first).days) if begins else 0
        hi = min(self.days, (ends - self.first).days) if ends else self.days
        if lo < hi:
            rank = begins.toordinal() if begins else -1
            wins = self.start[lo:hi] <= rank
            self.start[lo:hi][wins], self.item[lo:hi][wins] = rank, len(self.items)
            self.items.append(item)
            if len(self.items) > 4 * self.days:  # forget what no day shows any more
                used, inverse = np.unique(self.item, return_inverse=True)
                self.items = [self.items[i] for i in used if i >= 0]
                self.item = inverse - int(used[0] < 0)

    def segments(self) -> list[dict]:
        cuts = np.flatnonzero(np.diff(self.item)) + 1
        out = []
        for lo, hi in zip([0, *cuts], [*cuts, self.days]):
            if (i := self.item[lo]) >= 0:
                x = self.items[i]
                until = None if hi == self.days and self.first.year == dt.MAXYEAR else self.first + dt.timedelta(int(hi))
                out.append({"day_from": self.first + dt.timedelta(int(lo)), "day_to": until, "item_id": x[0], "item_value": x[1], "item_from": x[2], "item_known": x[4]})
        return out


def _states(months: int):
    """Sorted items to snapshots and change logs, in one pass that holds one year of one key at a time. A state is a
    snapshot and what became known after it, until the end of the period of its changes; the last has no end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, line, period, starts, changes, states, rows = None, None, 0, None, [], [], []

        def close(ends: dt.datetime | None) -> None:
            nonlocal changes, starts
            states.append({"starts": starts, "ends": ends, "snapshot": line.segments(), "changes": [dict(zip(("item_id", "item_value", "item_from", "item_to", "item_known"), c)) for c in changes]})
            for c in changes:
                line.add(c)
            changes, starts = [], ends
            if len(states) == STATES_PER_ROW or ends is None:
                rows.append({"key": group[0], "year": group[1], "starts": states[0]["starts"], "ends": ends, "states": list(states)})
                states.clear()

        for pdf in batches:
            for key, year, at, *item in zip(pdf.key, pdf.year, pdf.period, pdf.item_id, pdf.item_value, pdf.item_from, pdf.item_to, pdf.item_known):
                item = (int(item[0]), item[1], None if pd.isna(item[2]) else item[2], None if pd.isna(item[3]) else item[3], pd.Timestamp(item[4]).to_pydatetime())
                if (key, year) != group:
                    if group:
                        close(None)
                    group, line, period = (key, year), _Timeline(int(year)), int(at)
                    starts = _period_start(period, months)
                elif at != period:
                    close(_period_start(period + 1, months))
                    period = int(at)
                elif len(changes) >= CHANGES_PER_SNAPSHOT and item[4] > changes[-1][4]:
                    close(item[4])
                changes.append(item)
                if len(rows) >= 500:
                    yield pd.DataFrame(rows)
                    rows.clear()
        if group:
            close(None)
        if rows:
            yield pd.DataFrame(rows)

    return run


def as_known(events: DataFrame, items: DataFrame, *, key: tuple[str, str], event_date: str, event_known: str, item_id: str, item_value: str, valid: tuple[str, str], item_known: str, months: int = PERIOD_MONTHS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """All rows of `events` with item_id and item_value of the item in force at event_date (valid[0] <= date < valid[1],
    null = unbounded) as far as it was known at event_known; null where there is none.

    key: (event column, item column). Of several items the latest start counts (null = earliest), then the one known
    last, then the greatest id. Items with null key, id or time of becoming known are never known; identical rows count
    once; validity that ends before it begins never holds. Events with null key, date or time get nulls. Columns of
    `events` named item_id or item_value come out as item_id_in and item_value_in. States are made for the years in which
    events of a key fall, and only for those; days outside the years 1 to 9999 have no item.
    """
    spark = events.sparkSession
    whole = dict(zip(events.columns, apart(events, ["item_id", "item_value"]).columns))
    rows = events.select(F.struct("*").alias("row"), F.col(key[0]).cast("string").alias("key"), F.col(event_date).cast("date").alias("on"), F.col(event_known).cast("timestamp_ntz").alias("at"))
    usable = rows.where("key is not null and on is not null and at is not null")
    scratch = Scratch(spark)
    asked_for = usable.groupBy("key", F.year("on").alias("year")).agg(F.max(_period(F.col("at"), months)).alias("newest")).where("year between 1 and 9999")
    known = items.select(F.col(key[1]).cast("string").alias("key"), F.col(item_id).cast("long").alias("item_id"), F.col(item_value).cast("string").alias("item_value"), F.col(valid[0]).cast("date").alias("item_from"), F.col(valid[1]).cast("date").alias("item_to"), F.col(item_known).cast("timestamp_ntz").alias("item_known"))
    known = known.where("key is not null and item_id is not null and item_known is not null and (item_from is null or item_to is null or item_from < item_to)").distinct()
    known = known.withColumn("period", _period(F.col("item_known"), months))
    yearly = known.join(asked_for, "key").where("period <= newest and (item_from is null or year(item_from) <= year) and (item_to is null or year <= year(item_to))").drop("newest")
    states = yearly.repartition("key", "year").sortWithinPartitions("key", "year", "item_known", "item_id").mapInPandas(_states(months), _STATE)
    states = broadcast_if_small(scratch.keep(states), broadcast_bytes)
    asked = rows.withColumn("year", F.year("on"))
    holds = lambda starts, ends: (starts <= F.col("at")) & (ends.isNull() | (F.col("at") < ends))
    met = asked.join(states.select(*(F.col(c).alias(f"s_{c}") for c in states.columns)), (F.col("key") == F.col("s_key")) & (F.col("year") == F.col("s_year")) & holds(F.col("s_starts"), F.col("s_ends")), "left")
    met = met.withColumn("s", F.try_element_at(F.filter("s_states", lambda x: holds(x["starts"], x["ends"])), F.lit(1)))
    order = lambda x: F.struct(F.coalesce(F.datediff(x["item_from"], F.lit("1970-01-01")), F.lit(-(1 << 30))), x["item_known"], x["item_id"], x["item_value"])
    then = F.transform(F.filter("s.snapshot", lambda x: (x["day_from"] <= F.col("on")) & (x["day_to"].isNull() | (F.col("on") < x["day_to"]))), order)
    since = F.transform(F.filter("s.changes", lambda x: (x["item_known"] <= F.col("at")) & (x["item_from"].isNull() | (x["item_from"] <= F.col("on"))) & (x["item_to"].isNull() | (F.col("on") < x["item_to"]))), order)
    best = F.array_max(F.concat(then, since))
    return met.select("row", best.alias("best")).select(*(F.col("row")[c].alias(new) for c, new in whole.items()), F.col("best.item_id").alias("item_id"), F.col("best.item_value").alias("item_value"))
