"""Integrity checks. Each returns its findings, one row for each; a roll-up turns counts into a severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..runtime import broadcast_if_small
from . import hierarchy

SEVERITY = {"error": 2, "warning": 1}


def duplicated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys and n of keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def newer_not_active(rows: DataFrame, keys: list[str], active: Column, released: str, id_col: str = "id") -> DataFrame:
    """Active rows beside an inactive row of the same keys released later: id_active, id_newer (the one released last)."""
    a = rows.where(active).select(*keys, F.col(id_col).alias("id_active"), F.col(released).alias("__a"))
    b = rows.where(~active).groupBy(*keys).agg(F.max(F.struct(F.col(released).alias("at"), F.col(id_col).alias("id"))).alias("__b"))
    return a.join(b, keys).where(F.col("__b.at") > F.col("__a")).select("id_active", F.col("__b.id").alias("id_newer"))


def newer_counts(rows: DataFrame, keys: list[str], active: Column, released: str, id_col: str = "id") -> DataFrame:
    """id_active, n_newer: how many inactive rows of the same keys were released later than each row of newer_not_active()."""
    whole = rows.where(F.col(released).isNotNull()).dropna(subset=keys).select(*keys, F.col(id_col).alias("id_active"), F.col(released).alias("__at"), active.alias("__active"))
    since = W.Window.partitionBy(*keys).orderBy(F.desc("__at")).rangeBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    idle = F.when(~F.col("__active"), 1).otherwise(0)
    counted = whole.withColumn("n_newer", F.sum(idle).over(since) - F.sum(idle).over(W.Window.partitionBy(*keys, "__at")))
    return counted.where(F.col("__active") & (F.col("n_newer") > 0)).select("id_active", "n_newer")


def without_sibling(rows: DataFrame, keys: list[str], lone: Column, sibling: Column) -> DataFrame:
    """Rows for which `lone` holds and no row of the same keys has `sibling`."""
    return rows.where(lone).join(rows.where(sibling).select(*keys).distinct(), keys, "left_anti")


def dangling(child: DataFrame, column: str, parent: DataFrame, key: str = "id") -> DataFrame:
    """Rows of `child` with a value in `column` that `parent` does not have; null is no reference."""
    known = parent.select(F.col(key).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(broadcast_if_small(known), column, "left_anti")


def dangling_by_kind(child: DataFrame, kind: str, column: str, parents: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """References whose table is named by another column: one anti-join for each table, rows of unknown tables included."""
    out = child.where(~F.col(kind).isin(list(parents)) | F.col(kind).isNull())
    for name, parent in parents.items():
        out = out.unionByName(dangling(child.where(F.col(kind) == name), column, parent, key).select(*child.columns))
    return out


def mismatched(child: DataFrame, ref: str, parent: DataFrame, key: str, differ: Column) -> DataFrame:
    """Pairs of child and parent for which `differ` holds."""
    return child.join(parent, F.col(ref) == F.col(key)).where(differ)


def stale(jobs: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Running jobs begun more than so many hours before `now`."""
    return jobs.where((F.col("status") == "running") & (F.col("started_at") < now - F.make_dt_interval(hours=F.lit(hours))))


def contradictory(jobs: DataFrame) -> DataFrame:
    """Jobs that run and have ended, or do neither."""
    return jobs.where((F.col("status") == "running") == F.col("finished_at").isNotNull())


def cycles(rows: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """id and smallest id of the loop, for rows on a loop or leading into one."""
    return hierarchy.roots_and_depths(rows, id_col, parent_col).where("depth = -1").select("id", F.col("root_id").alias("loop_id"))


def rollup(counts: DataFrame) -> DataFrame:
    """findings and exit_code over (check_id, severity, n): 2 if any error was found, 1 if any warning, else 0."""
    code = F.max(F.when(F.col("n") == 0, 0).when(F.col("severity") == "error", 2).otherwise(1))
    return counts.agg(F.sum("n").cast("long").alias("findings"), F.coalesce(code, F.lit(0)).alias("exit_code"))
