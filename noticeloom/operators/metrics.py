"""Counts, rates, durations and growth of operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W


def elapsed_ms(start: Column, end: Column) -> Column:
    return (F.unix_micros(F.to_timestamp(end)) - F.unix_micros(F.to_timestamp(start))) / 1000


def success_rate(jobs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_ended and rate of success among those that ended (null if none did)."""
    return jobs.groupBy(*keys).agg(F.count_if(F.col("status") != "running").alias("n_ended"), F.count_if(F.col("status") == "succeeded").alias("n_ok")).select(*keys, "n_ended", F.when(F.col("n_ended") > 0, F.col("n_ok") / F.col("n_ended")).alias("success_rate"))


def quantiles(rows: DataFrame, keys: list[str], value: Column, points: dict[str, float]) -> DataFrame:
    """keys, n and exact interpolated quantiles of `value`, named as in points. Equal values are counted first and then
    walked in order, so that no task holds a whole group."""
    counted = rows.withColumn("__v", value).where("__v is not null").groupBy(*keys, "__v").agg(F.count("*").alias("__c"))
    up_to = F.sum("__c").over(W.Window.partitionBy(*keys).orderBy("__v").rowsBetween(W.Window.unboundedPreceding, 0))
    walked = counted.withColumn("__to", up_to).join(counted.groupBy(*keys).agg(F.sum("__c").alias("n")), keys)
    at = {name: p * (F.col("n") - 1) for name, p in points.items()}
    ends = [F.min(F.when(F.col("__to") > f(x), F.col("__v"))).alias(f"__{name}_{f.__name__}") for name, x in at.items() for f in (F.floor, F.ceil)]
    found = walked.groupBy(*keys, "n").agg(*ends)
    between = lambda name, x: F.col(f"__{name}_floor") + (F.col(f"__{name}_ceil") - F.col(f"__{name}_floor")) * (x - F.floor(x))
    return found.select(*keys, "n", *(between(name, x).alias(name) for name, x in at.items()))


def growth(rows: DataFrame, time: str, unit: str = "month") -> DataFrame:
    """period, n and change against the period before (null for the first). The window runs over the counted periods."""
    counted = rows.where(F.col(time).isNotNull()).groupBy(F.date_trunc(unit, time).cast("date").alias("period")).agg(F.count("*").alias("n"))
    before = F.lag("n").over(W.Window.orderBy("period"))
    return counted.withColumn("change", (F.col("n") - before) / before)


def next_run(now: Column, anchor: Column, seconds: int) -> Column:
    """The first time at or after `now` that lies whole intervals after `anchor`."""
    gap = F.unix_timestamp(F.to_timestamp(now)) - F.unix_timestamp(F.to_timestamp(anchor))
    return F.timestamp_seconds(F.unix_timestamp(F.to_timestamp(anchor)) + F.greatest(F.lit(0), F.ceil(gap / seconds)) * seconds)


def paired_durations(events: DataFrame, keys: list[str], kind: str, time: str, start: str, end: str) -> DataFrame:
    """keys and elapsed_ms of each `end` event that directly follows a `start` event of the same keys in time; ends sort
    after starts of the same moment."""
    w = W.Window.partitionBy(*keys).orderBy(time, (F.col(kind) == end).cast("int"))
    rows = events.where(F.col(kind).isin(start, end)).withColumns({"__was": F.lag(kind).over(w), "__from": F.lag(time).over(w)})
    return rows.where((F.col(kind) == end) & (F.col("__was") == start)).select(*keys, elapsed_ms(F.col("__from"), F.col(time)).alias("elapsed_ms"))


def health(jobs: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """keys, last start, last success and hours since that success (null if there was none)."""
    ok = F.max(F.when(F.col("status") == "succeeded", F.col("finished_at")))
    out = jobs.groupBy(*keys).agg(F.max("started_at").alias("last_start"), ok.alias("last_success"))
    return out.withColumn("hours_since", elapsed_ms(F.col("last_success"), now) / 3.6e6)


def slope(rows: DataFrame, keys: list[str], time: str, unit: str = "week") -> DataFrame:
    """keys, n_periods and slope: by how much the count of a period grows from one to the next, by least squares over the
    periods that have rows; null for a single one."""
    days = {"day": 1, "week": 7}[unit]
    period = F.floor(F.datediff(F.col(time), F.lit("1970-01-05").cast("date")) / days)
    counted = rows.where(F.col(time).isNotNull()).groupBy(*keys, period.alias("p")).agg(F.count("*").alias("n"))
    return counted.groupBy(*keys).agg(F.count("*").alias("n_periods"), F.regr_slope(F.col("n").cast("double"), F.col("p").cast("double")).alias("slope"))


def budget_burn(jobs: DataFrame, keys: list[str], target: float) -> DataFrame:
    """keys, n_ended, burn (failures as a share of those that the target allows) and alert: 50, 80 or 100, the highest per
    cent reached, else 0. Null burn where nothing ended."""
    out = jobs.groupBy(*keys).agg(F.count_if(F.col("status") != "running").alias("n_ended"), F.count_if(F.col("status") == "failed").alias("bad"))
    burn = F.when(F.col("n_ended") > 0, F.col("bad") / (F.col("n_ended") * (1 - target)))
    alert = F.when(burn >= 1, 100).when(burn >= 0.8, 80).when(burn >= 0.5, 50).otherwise(0)
    return out.select(*keys, "n_ended", burn.alias("burn"), alert.alias("alert"))


def last_runs(jobs: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """keys, n_runs and all_succeeded over the last `n` ended runs of each key."""
    w = W.Window.partitionBy(*keys).orderBy(F.desc("started_at"), F.desc("id"))
    last = jobs.where("status <> 'running'").withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n)
    return last.groupBy(*keys).agg(F.count("*").alias("n_runs"), F.every(F.col("status") == "succeeded").alias("all_succeeded"))
