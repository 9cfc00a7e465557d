"""Scores and their bands. Sums run in order, so that thresholds fall as left-to-right addition lets them fall."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower ends of the bands, thresholds and scores.
BANDS = (("verified", 0.9), ("high", 0.75), ("medium", 0.5))
LAYOUT_MATCH, LAYOUT_LOW, LAYOUT_MARGIN = 0.6, 0.3, 0.05
KEEP = 0.5
FIELD_SCORES = {"category": 1.0, "typography": 0.6, "identity": 0.3}


def band(score: Column) -> Column:
    """verified, high, medium or low; low for null."""
    out = F.when(score >= BANDS[0][1], BANDS[0][0])
    for name, least in BANDS[1:]:
        out = out.when(score >= least, name)
    return out.otherwise("low")


def ordered_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def ordered_mean(values: Column) -> Column:
    """Mean of an array in its order, 0.0 for an empty one."""
    return F.when(F.size(values) > 0, ordered_sum(values) / F.size(values)).otherwise(0.0)


def weighted_score(rules: Column) -> Column:
    """Weight of matched rules / weight of all, of an array of (matched, weight); 0.0 if the weights sum to nothing."""
    all_ = ordered_sum(F.transform(rules, lambda r: r["weight"]))
    hit = ordered_sum(F.transform(F.filter(rules, lambda r: r["matched"]), lambda r: r["weight"]))
    return F.when(all_ > 0, hit / all_).otherwise(0.0)


def section_score(lines: Column) -> Column:
    """0.0 without a line, 0.3 without a body (fewer than three lines), else 1.0."""
    return F.when(F.size(lines) == 0, 0.0).when(F.size(lines) < 3, 0.3).otherwise(1.0)


def extraction_score(fields: Column) -> Column:
    """0.0 without a column, 0.4 with one, else 1.0."""
    return F.when(F.size(fields) == 0, 0.0).when(F.size(fields) == 1, 0.4).otherwise(1.0)
