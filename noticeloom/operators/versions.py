"""Versioned facts: numbering, chains, snapshots, type-2 dictionaries and the latest row of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W


def numbered(facts: DataFrame, keys: list[str], order: list[Column], after: DataFrame | None = None) -> DataFrame:
    """`facts` with `version`: 1, 2, ... within the keys in the given order, continuing after the greatest version that
    `after` (keys, version) has."""
    own = F.row_number().over(W.Window.partitionBy(*keys).orderBy(*order))
    if after is None:
        return facts.withColumn("version", own)
    top = after.groupBy(*keys).agg(F.max("version").alias("__top"))
    return facts.withColumn("version", own).join(top, keys, "left").withColumn("version", F.col("version") + F.coalesce("__top", F.lit(0))).drop("__top")


def chained(facts: DataFrame, keys: list[str], order: list[Column], id_col: str = "id", since: str = "valid_from") -> DataFrame:
    """`facts` with superseded_by, valid_to and is_current set from the successor within the keys."""
    w = W.Window.partitionBy(*keys).orderBy(*order)
    return facts.withColumns({"superseded_by": F.lead(id_col).over(w), "valid_to": F.lead(since).over(w), "is_current": F.lead(id_col).over(w).isNull()})


def snapshot(facts: DataFrame, at: Column, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Rows that stood at `at`: [start, end), a null end being open. The range reaches the scan."""
    return facts.where((F.col(start) <= at) & (F.col(end).isNull() | (F.col(end) > at)))


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order, which should end in a unique column."""
    return rows.withColumn("__n", F.row_number().over(W.Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def type2(deliveries: DataFrame, keys: list[str], value: list[str], since: Column, order: list[Column]) -> DataFrame:
    """keys, value, effective_from and effective_to of a dictionary built from deliveries: a delivery that repeats the
    open value changes nothing, any other closes it at its own start."""
    w = W.Window.partitionBy(*keys).orderBy("effective_from", *order)
    rows = deliveries.withColumn("effective_from", since)
    now, before = F.struct(*value), F.lag(F.struct(*value)).over(w)
    kept = rows.withColumn("__same", now.eqNullSafe(before) & F.lag(F.lit(1)).over(w).isNotNull()).where(~F.col("__same"))
    return kept.withColumn("effective_to", F.lead("effective_from").over(w)).select(*keys, *value, "effective_from", "effective_to")


def supersede(versions: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """`versions` with `new_status`: parsed for the newest of its keys, superseded for the rest, in one rewrite."""
    n = F.row_number().over(W.Window.partitionBy(*keys).orderBy(*order))
    return versions.withColumn("new_status", F.when(n == 1, "parsed").otherwise("superseded"))


def unseen(new: DataFrame, known: DataFrame | None, key: Column, order: list[Column]) -> DataFrame:
    """Rows of `new` whose key is not among `known` (column key), one for each key: the first in the given order."""
    rows = new.withColumn("__key", key)
    if known is not None:
        rows = rows.join(known.select(F.col("key").alias("__key")).distinct(), "__key", "left_anti")
    return latest(rows, ["__key"], order).drop("__key")
