"""Work on records over its life: stages that carry their failures, three grains of outcome, states, patches and ledgers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

#: Stages whose failures become learning rows; a failure of the document as a whole does not.
RECORDED = ("layout", "section", "field", "normalize", "validate")


def run_stages(rows: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """`rows` with failed_stage and error: the first stage, in order, whose column is a message, and that message; both null
    if every stage went through. Later stages are not looked at; a failed row is carried on, never thrown."""
    first = F.coalesce(*(F.when(error.isNotNull(), F.struct(F.lit(name).alias("stage"), error.alias("error"))) for name, error in stages))
    return rows.withColumn("__f", first).withColumns({"failed_stage": F.col("__f.stage"), "error": F.col("__f.error")}).drop("__f")


def stage_events(ran: DataFrame, stages: list[str], key: str) -> DataFrame:
    """key, stage_index, stage, event of rows of run_stages(): completed before the failure, failed at it, skipped behind."""
    at = F.coalesce(F.array_position(F.array(*map(F.lit, stages)), F.col("failed_stage")), F.lit(len(stages) + 1))
    numbered = ran.select(key, at.alias("__at"), F.posexplode(F.array(*map(F.lit, stages))).alias("stage_index", "stage"))
    place = F.col("stage_index") + 1
    event = F.when(place < F.col("__at"), "completed").when(place == F.col("__at"), "failed").otherwise("skipped")
    return numbered.select(key, "stage_index", "stage", event.alias("event"))


def failures(ran: DataFrame, key: str, recorded: tuple[str, ...] = RECORDED) -> DataFrame:
    """key, stage, error of the failed rows whose stage is recorded for learning."""
    return ran.where(F.col("failed_stage").isin(*recorded)).select(key, F.col("failed_stage").alias("stage"), "error")


def coordinated(documents: DataFrame, sections: DataFrame, records: DataFrame) -> DataFrame:
    """document, n_sections, n_records, n_failed and status of every row of `documents` (document, failed), by what became
    of its sections (document, section, failed) and their records (section, failed). Failures stay with their own grain; a
    document failed if anything of it did."""
    of_section = records.groupBy("section").agg(F.count("*").alias("n"), F.count_if("failed").alias("bad"))
    met = sections.join(of_section, "section", "left").groupBy("document").agg(F.count("*").alias("n_sections"), F.sum(F.coalesce("n", F.lit(0))).alias("n_records"), F.sum(F.coalesce("bad", F.lit(0)) + F.col("failed").cast("int")).alias("bad"))
    out = documents.join(met, "document", "left")
    bad = F.coalesce("bad", F.lit(0)) + F.col("failed").cast("int")
    return out.select("document", F.coalesce("n_sections", F.lit(0)).alias("n_sections"), F.coalesce("n_records", F.lit(0)).alias("n_records"), bad.alias("n_failed"), F.when(bad > 0, "failed").otherwise("validated").alias("status"))


def pending(sections: DataFrame, records: DataFrame, section: str = "id", ref: str = "section_ref") -> DataFrame:
    """The rows of `records` that a second run takes up: not `final`, of a section that is still there."""
    return records.where(~F.col("final")).join(sections.select(F.col(section).alias(ref)).distinct(), ref, "left_semi")


def states(raw: DataFrame, normalized: DataFrame, validated: DataFrame, key: str) -> DataFrame:
    """key and state: what is stored of each key in three tables, merged; the furthest step counts. validated: key, passed.
    A key without its raw row comes out as `lost`; repeated rows count once, and a key failed if any of its rows did."""
    a, b = raw.select(key).distinct().withColumn("__raw", F.lit(True)), normalized.select(key).distinct().withColumn("__norm", F.lit(True))
    c = validated.groupBy(key).agg(F.every("passed").alias("__ok"))
    merged = a.join(b, key, "full").join(c, key, "full")
    state = F.when(F.col("__raw").isNull(), "lost").when(F.col("__ok"), "passed").when(~F.col("__ok"), "failed").when(F.col("__norm"), "normalized").otherwise("raw")
    return merged.select(key, state.alias("state"))


def patched(rows: DataFrame, patches: DataFrame, key: str, allowed: tuple[str, ...]) -> DataFrame:
    """`rows` with the values of `patches` where those are not null. A patch of a column that is not allowed is an error; a
    patch of no row is ignored; of several patches of a row the greatest value of each column counts."""
    columns = [c for c in patches.columns if c != key]
    if unknown := [c for c in columns if c not in allowed]:
        raise ValueError(f"not to be patched: {unknown}")
    one = patches.groupBy(key).agg(*(F.max(c).alias(f"__{c}") for c in columns))
    return rows.join(one, key, "left").select(*(F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns))


def ledger(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """key, status, started_at, finished_at, n_events of a log of starts and ends (key, status, at and the columns of
    `order`): the last status, the first time, and the first time at which it was not running."""
    place = F.struct(*order)
    ended = F.col("status") != "running"
    out = events.groupBy(key).agg(F.max_by("status", place).alias("status"), F.min("at").alias("started_at"), F.min(F.when(ended, F.col("at"))).alias("finished_at"), F.count("*").alias("n_events"))
    return out.withColumn("finished_at", F.when(F.col("status") != "running", F.col("finished_at")))


def unregistered(definitions: DataFrame, registered: DataFrame, keys: list[str]) -> DataFrame:
    """The different keys of `definitions` that `registered` does not hold; registration only ever inserts."""
    return definitions.select(*keys).dropna().distinct().join(registered.select(*keys).distinct(), keys, "left_anti")


def upserted(stored: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """`stored` and `new` with one row for each key, the last in `order`, of equal ones the new one. Null keys are left out."""
    both = stored.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1))).where(F.col(key).isNotNull())
    return both.groupBy(key).agg(F.max_by(F.struct(*(c for c in stored.columns if c != key)), F.struct(*order, "__new")).alias("b")).select(key, "b.*").select(*stored.columns)


def delivered(deliveries: DataFrame, keys: list[str], value: list[str], order: list[Column], day: Column, start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """A dictionary as deliveries build it one after the other: keys, value, id, effective_from, effective_to.

    A delivery that repeats the open row (same value) changes nothing. Any other is inserted as it is and closes the open row
    at its own start, or on the day of its delivery if it has none. A row is open while it has no end.
    """
    w = W.Window.partitionBy(*keys).orderBy(*order)
    same = F.struct(*value).eqNullSafe(F.lag(F.struct(*value)).over(w)) & F.lag(F.lit(1)).over(w).isNotNull()
    rows = deliveries.withColumn("__day", day).withColumn("__run", F.when(same, 0).otherwise(1))
    rows = rows.withColumn("__run", F.sum("__run").over(w.rowsBetween(W.Window.unboundedPreceding, 0)))
    in_run = W.Window.partitionBy(*keys, "__run").orderBy(*order).rowsBetween(W.Window.unboundedPreceding, -1)
    kept = rows.withColumn("__open", F.coalesce(F.max(F.col(end).isNull()).over(in_run), F.lit(False))).where(~F.col("__open"))
    closed = F.coalesce(F.lead(start).over(w), F.lead("__day").over(w))
    return kept.withColumn("__closed", closed).select(*keys, *value, "id", start, F.coalesce(F.col(end), F.col("__closed")).alias(end))


def compared(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys and change (added, removed, changed, same) of two runs over the same scope, one row a key in each."""
    a, b = old.select(*keys, F.col(value).alias("__a"), F.lit(True).alias("__old")), new.select(*keys, F.col(value).alias("__b"), F.lit(True).alias("__new"))
    change = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").when(F.col("__a").eqNullSafe(F.col("__b")), "same").otherwise("changed")
    return a.join(b, keys, "full").select(*keys, change.alias("change"))


def samples(found: dict[str, DataFrame], most: int = 10) -> DataFrame:
    """check_id, sample_no, sample: the first `most` findings of each check, as text, in the order of the text. A report: the
    findings themselves are the whole."""
    parts = []
    for name, df in found.items():
        text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(df.columns)))
        ranked = df.select(text.alias("sample")).orderBy("sample").limit(most)
        parts.append(ranked.select(F.lit(name).alias("check_id"), F.row_number().over(W.Window.partitionBy(F.lit(1)).orderBy("sample")).alias("sample_no"), "sample"))
    return reduce(DataFrame.unionByName, parts)
