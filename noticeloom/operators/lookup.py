"""Dictionaries with validity: lookup, normalisation of fields and validation against allowed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions import scoring, text
from ..runtime import broadcast_if_small

# The category of the dictionary that holds the values of a field.
CATEGORY = {"name": "alias", "rank": "rank", "organization": "organization", "position": "position"}


def in_force(start: Column, end: Column, at: Column, closed_end: bool = False) -> Column:
    """Whether [start, end) holds at `at`, null being unbounded; with closed_end, [start, end]."""
    before = at <= end if closed_end else at < end
    return (start.isNull() | (start <= at)) & (end.isNull() | before)


def effective(items: DataFrame, at: Column, categories: list[str] | None = None) -> DataFrame:
    """The items in force at one time, of some categories."""
    out = items.where(in_force(F.col("effective_from"), F.col("effective_to"), at))
    return out.where(F.col("category").isin(categories)) if categories is not None else out


def newest(items: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key the item with the latest start, then the greatest id."""
    rest = [c for c in items.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.coalesce(F.col("effective_from"), F.lit("0001-01-01").cast("date")), F.col("id")))
    return items.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def overlaps(items: DataFrame, keys: list[str]) -> DataFrame:
    """keys, id, earlier_id: each item that begins before an earlier one of its keys has ended, with the earlier item that
    ends last (null = never, then the greatest id). Intervals that end before they begin cover nothing; repeated ids count
    once. One pass over sorted rows, however many overlap."""
    start, end = F.coalesce("effective_from", F.lit("0001-01-01").cast("date")), F.coalesce("effective_to", F.lit("9999-12-31").cast("date"))
    rows = items.dropDuplicates(["id"]).select(*keys, "id", start.alias("s"), end.alias("e")).where("s < e")
    before = W.Window.partitionBy(*keys).orderBy("s", "id").rowsBetween(W.Window.unboundedPreceding, -1)
    met = rows.withColumn("last", F.max(F.struct("e", "id")).over(before)).where(F.col("last.e") > F.col("s"))
    return met.select(*keys, "id", F.col("last.id").alias("earlier_id"))


def overlap_counts(items: DataFrame, keys: list[str]) -> DataFrame:
    """keys, id, n_earlier: how many earlier items of its keys each row of overlaps() overlaps. Items and order as there:
    the items begun before it less those ended by its start, in one pass over sorted starts and ends."""
    start, end = F.coalesce("effective_from", F.lit("0001-01-01").cast("date")), F.coalesce("effective_to", F.lit("9999-12-31").cast("date"))
    rows = items.dropDuplicates(["id"]).select(*keys, "id", start.alias("s"), end.alias("e")).where("s < e")
    begun, ended = F.struct(F.col("s").alias("at"), F.lit(1).alias("open")), F.struct(F.col("e").alias("at"), F.lit(-1).alias("open"))
    turns = rows.select(*keys, "id", F.explode(F.array(begun, ended)).alias("t")).select(*keys, "id", "t.*")
    before = W.Window.partitionBy(*keys).orderBy("at", "open", "id").rowsBetween(W.Window.unboundedPreceding, -1)
    return turns.withColumn("n_earlier", F.sum("open").over(before)).where("open = 1 and n_earlier > 0").select(*keys, "id", "n_earlier")


def typography(value: Column, rules: list[tuple[int, str, str]]) -> Column:
    """(value, ids): all replacements of (id, key, canonical) in order, each on the outcome of the one before, and the ids
    of those whose key was there. The rules are a short list of the dictionary."""
    if not rules:
        return F.struct(value.alias("value"), F.array().cast("array<long>").alias("ids"))
    table = F.array(*(F.struct(F.lit(i).cast("long").alias("id"), F.lit(k).alias("key"), F.lit(v).alias("to")) for i, k, v in rules))
    begin = F.struct(value.alias("value"), F.array().cast("array<long>").alias("ids"))
    return F.aggregate(table, begin, lambda s, r: F.when(F.contains(s["value"], r["key"]), F.struct(F.replace(s["value"], r["key"], r["to"]).alias("value"), F.concat(s["ids"], F.array(r["id"])).alias("ids"))).otherwise(s))


def fields(records: DataFrame, items: DataFrame, record: str = "record_id", layout: str = "layout_id") -> DataFrame:
    """One row for each field of raw_fields: record, place, name, raw, semantic (what the layout says the column holds)."""
    meaning = items.where("category = 'layout'").groupBy(F.col("item_key").alias("__key")).agg(F.min_by("canonical_value", "ordinal").alias("semantic"))
    rows = records.select(record, layout, F.posexplode("raw_fields").alias("place", "f")).select(record, layout, "place", F.col("f.name").alias("name"), F.col("f.value").alias("raw"))
    return rows.withColumn("__key", F.concat_ws(".", F.col(layout), F.col("name"))).join(broadcast_if_small(meaning), "__key", "left").drop("__key")


def normalize(records: DataFrame, items: DataFrame, at: Column, record: str = "record_id", layout: str = "layout_id", keep: float = scoring.KEEP) -> DataFrame:
    """record, normalized_fields, score, band and applied ids of the records that score at least `keep`.

    A value is brought to its compatibility form, then through the typography rules in the order of the dictionary, then
    looked up in the category of its semantic name; of these and of what a column means, the first item in force at `at` counts. Fields that come out empty are
    left out; repeated records count once. Score of a record: mean over its fields of 1.0 (looked up), 0.6 (typography) or 0.3 (as it was).
    """
    valid = items.where(in_force(F.col("effective_from"), F.col("effective_to"), at))
    rules = [(r.id, r.item_key, r.canonical_value) for r in valid.where("category = 'typography'").dropDuplicates(["id"]).orderBy("ordinal", "id").toLocalIterator()]
    kind = F.create_map(*(F.lit(x) for pair in CATEGORY.items() for x in pair))
    rows = fields(records.dropDuplicates([record]), valid, record, layout).withColumn("t", typography(text.nfkc(F.col("raw")), rules)).where("t.value <> ''")
    words = valid.where(F.col("category").isin(list(CATEGORY.values()))).groupBy(F.col("category").alias("c"), F.col("item_key").alias("k")).agg(F.min_by(F.struct("canonical_value", "id"), F.struct("ordinal", "id")).alias("hit"))
    coded = rows.withColumn("c", F.try_element_at(kind, F.col("semantic"))).withColumn("k", F.col("t.value"))
    met = coded.join(broadcast_if_small(words), ["c", "k"], "left")
    method = F.when(F.col("hit").isNotNull(), "category").when(F.size("t.ids") > 0, "typography").otherwise("identity")
    score = F.when(method == "category", 1.0).when(method == "typography", 0.6).otherwise(0.3)
    one = F.struct("place", "name", F.coalesce("hit.canonical_value", "t.value").alias("value"), "raw", score.alias("score"), F.concat("t.ids", F.when(F.col("hit").isNotNull(), F.array("hit.id")).otherwise(F.array().cast("array<long>"))).alias("ids"))
    grouped = met.groupBy(record).agg(F.array_sort(F.collect_list(one)).alias("f"))
    mean = scoring.ordered_mean(F.transform("f", lambda x: x["score"]))
    out = grouped.select(record, F.transform("f", lambda x: F.struct(x["name"].alias("name"), x["value"].alias("value"), x["raw"].alias("raw"))).alias("normalized_fields"), mean.alias("score"), scoring.band(mean).alias("band"), F.flatten(F.transform("f", lambda x: x["ids"])).alias("applied"))
    return out.where(F.col("score") >= keep)


def validate(values: DataFrame, allowed: DataFrame, record: str = "record_id") -> DataFrame:
    """record, status, score, errors and warnings of fields(): a field without a semantic name is a warning, one whose
    semantic name has allowed values and holds another is an error.

    allowed: semantic, value. score = share of checkable fields without error, 0.5 if none is checkable; failed if any
    errs. A null value of a constrained field is an error.
    """
    ok = allowed.distinct().withColumn("ok", F.lit(True))
    bound = allowed.select("semantic").distinct().withColumn("bound", F.lit(True))
    met = values.join(broadcast_if_small(bound), "semantic", "left").join(broadcast_if_small(ok.withColumnRenamed("value", "raw")), ["semantic", "raw"], "left")
    bad = F.col("bound").isNotNull() & F.col("ok").isNull()
    grouped = met.groupBy(record).agg(F.count("semantic").alias("checkable"), F.count_if(bad).alias("errors"), F.count_if(F.col("semantic").isNull()).alias("warnings"))
    score = F.when(F.col("checkable") == 0, 0.5).otherwise((F.col("checkable") - F.col("errors")) / F.col("checkable"))
    return grouped.select(record, F.when(F.col("errors") > 0, "failed").otherwise("passed").alias("status"), score.alias("score"), "errors", "warnings")


def scoped_patterns(rows: DataFrame, rules: list[tuple[str, str, str]], scope: str, value: str) -> DataFrame:
    """`rows` with `value` rewritten by the rules (scope, pattern, replacement) of its scope, in order; scope `*` holds for
    all. The rules are a short list of the dictionary and go into the plan."""
    out = F.col(value)
    for where, pattern, to in rules:
        done = F.regexp_replace(out, F.lit(pattern), F.lit(to))
        out = done if where == "*" else F.when(F.col(scope) == where, done).otherwise(out)
    return rows.withColumn(value, out)
