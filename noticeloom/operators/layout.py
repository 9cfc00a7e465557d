"""Which known layout a document follows: evidence from its pages, weighted rules, a winner and warnings."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scoring, text

RULES = "array<struct<rule_id:string,kind:string,value:string,weight:double>>"
# The kinds of rules.
KINDS = ("header_pattern", "footer_pattern", "min_page_count", "font_name_contains")


def evidence(pages: DataFrame, doc: str = "doc_id", index: str = "page_index", body: str = "text") -> DataFrame:
    """One row for each document of `pages`: page_count, mean_chars, mean_lines, mean_blocks, header, footer.

    header is the first line of the first page, footer the last line of the last; null where that page is blank. Means
    are over all pages. Where pages have `fonts` (array of names), so has the result: the names of all pages, each once. One
    exchange by document, to which every page brings counts and two lines.
    """
    named = ["fonts"] if "fonts" in pages.columns else []
    found = text.lines(F.col(body))
    page = pages.select(doc, F.col(index).alias("__i"), F.length(F.coalesce(F.col(body), F.lit(""))).alias("chars"), F.size(found).alias("lines"), F.size(text.blocks(F.col(body))).alias("blocks"), text.first(found).alias("first"), text.last(found).alias("last"), *named)
    return page.groupBy(doc).agg(
        F.count("*").alias("page_count"),
        F.avg("chars").alias("mean_chars"),
        F.avg("lines").alias("mean_lines"),
        F.avg("blocks").alias("mean_blocks"),
        F.min_by("first", "__i").alias("header"),
        F.max_by("last", "__i").alias("footer"),
        *(F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in named),
    )


def first_seen_mode(values: Column) -> Column:
    """The most frequent element of an array, of equally frequent ones the first seen; null for an empty array."""
    counts = F.transform(F.array_distinct(values), lambda v: F.struct(F.size(F.filter(values, lambda x: x == v)).alias("n"), (-F.array_position(values, v)).alias("at"), v.alias("v")))
    return F.array_max(counts)["v"]


def _matched(rule: Column, page_count: Column, header: Column, footer: Column, fonts: Column) -> Column:
    within = lambda where: F.coalesce(F.contains(where, rule["value"]), F.lit(False))
    any_font = F.coalesce(F.exists(fonts, within), F.lit(False))
    return F.when(rule["kind"] == "header_pattern", within(header)).when(rule["kind"] == "footer_pattern", within(footer)).when(rule["kind"] == "min_page_count", F.coalesce(page_count >= rule["value"].try_cast("int"), F.lit(False))).when(rule["kind"] == "font_name_contains", any_font).otherwise(F.lit(False))


def _known(layouts: DataFrame) -> Column:
    manifest = [{"ordinal": r.ordinal, "layout_id": r.layout_id, "rules": [x.asDict() for x in r.rules]} for r in layouts.toLocalIterator()]
    if unknown := {r["kind"] for m in manifest for r in m["rules"]} - set(KINDS):
        raise ValueError(f"unknown kinds of rules: {sorted(unknown, key=str)}")
    return F.from_json(F.lit(json.dumps(manifest)), f"array<struct<ordinal:int,layout_id:string,rules:{RULES}>>")


def candidates(found: DataFrame, layouts: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, place (from 1, best first, of equal ones the first ordinal), layout_id, score, matched and failed (ids of rules in
    their order) of every layout for each document of evidence(). Layouts and errors as in detect()."""
    fonts = F.col("fonts") if "fonts" in found.columns else F.array().cast("array<string>")

    def scored(one: Column) -> Column:
        tried = F.transform(one["rules"], lambda r: F.struct(_matched(r, F.col("page_count"), F.col("header"), F.col("footer"), fonts).alias("matched"), r["weight"].alias("weight"), r["rule_id"].alias("id")))
        ids = lambda hit: F.transform(F.filter(tried, lambda r: r["matched"] == hit), lambda r: r["id"])
        return F.struct(scoring.weighted_score(tried).alias("score"), (-one["ordinal"]).alias("first"), one["layout_id"].alias("layout_id"), ids(True).alias("matched"), ids(False).alias("failed"))

    ordered = found.select(doc, F.posexplode(F.sort_array(F.transform(_known(layouts), scored), asc=False)).alias("place", "c"))
    return ordered.select(doc, (F.col("place") + 1).alias("place"), "c.layout_id", "c.score", "c.matched", "c.failed")


def page_features(pages: DataFrame, doc: str = "doc_id", index: str = "page_index") -> DataFrame:
    """doc, page_count, mean_width, mean_height, rotated_pages, dominant_rotation (the most frequent, of equally frequent ones
    the first seen) and fonts (each once, sorted) of pages (width, height, rotation, fonts). Rotations are counted before they
    are compared, so that a document's pages need not meet."""
    turned = pages.select(doc, F.col(index).alias("__i"), "width", "height", F.pmod("rotation", F.lit(360)).alias("rotation"), "fonts")
    part = turned.groupBy(doc, "rotation").agg(F.count("*").alias("n"), F.min("__i").alias("first"), F.sum("width").alias("w"), F.sum("height").alias("h"))
    order = F.struct(F.col("n"), -F.col("first"))
    whole = part.groupBy(doc).agg(F.sum("n").alias("page_count"), (F.sum("w") / F.sum("n")).alias("mean_width"), (F.sum("h") / F.sum("n")).alias("mean_height"), F.sum(F.when(F.col("rotation") != 0, F.col("n")).otherwise(0)).alias("rotated_pages"), F.max_by("rotation", order).alias("dominant_rotation"))
    names = turned.select(doc, F.explode("fonts").alias("font")).distinct().groupBy(doc).agg(F.array_sort(F.collect_list("font")).alias("fonts"))
    return whole.join(names, doc, "left").withColumn("fonts", F.coalesce("fonts", F.array().cast("array<string>")))


def detect(found: DataFrame, layouts: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The best layout of each document of evidence(): layout_id (null below the threshold), score, band, warnings.

    layouts: ordinal, layout_id, rules (array of rule_id, kind, value, weight), a manifest read from files; it goes into the
    plan as a constant, so that every document is scored where it is. The highest score wins, of equal ones the first
    ordinal. Without a layout the score is 0.0 and the warning NO_MATCH. Without `fonts` in `found` no font rule matches; a
    rule of an unknown kind is an error.
    """
    known = _known(layouts)
    fonts = F.col("fonts") if "fonts" in found.columns else F.array().cast("array<string>")

    def scored(one: Column) -> Column:
        tried = F.transform(one["rules"], lambda r: F.struct(_matched(r, F.col("page_count"), F.col("header"), F.col("footer"), fonts).alias("matched"), r["weight"].alias("weight")))
        return F.struct(scoring.weighted_score(tried).alias("score"), (-one["ordinal"]).alias("first"), one["layout_id"].alias("layout_id"))

    top = found.withColumn("c", F.sort_array(F.transform(known, scored), asc=False))
    best, second = text.first(F.col("c")), F.try_element_at("c", F.lit(2))
    score = F.coalesce(best["score"], F.lit(0.0))
    hit = score >= scoring.LAYOUT_MATCH
    warnings = F.array_compact(F.array(F.when(hit & (score - second["score"] < scoring.LAYOUT_MARGIN), "AMBIGUOUS"), F.when((score >= scoring.LAYOUT_LOW) & ~hit, "LOW_CONFIDENCE"), F.when(score < scoring.LAYOUT_LOW, "NO_MATCH")))
    return top.select(doc, F.when(hit, best["layout_id"]).alias("layout_id"), score.alias("score"), scoring.band(score).alias("band"), warnings.alias("warnings"))
