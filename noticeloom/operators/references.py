"""References to records that do not exist.

A reference is a key of one or more columns that may be null in part. References are grouped by which of their columns
are null, and each group is held against the referenced table on its non-null columns only.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import apart, broadcast_if_small

MATCHES = ("simple", "partial", "full")


def orphans(child: DataFrame, parent: DataFrame, keys: list[tuple[str, str]], match: str = "simple", times: tuple[str, str] | None = None) -> DataFrame:
    """Rows of `child` whose reference has no row in `parent`, with `reason`.

    keys: pairs (child column, parent column). times: (child column, parent column); a referenced row dated strictly
    later than the referring row does not count (of repeated parents the earliest counts; a null date on either side is
    never later). match, as in the SQL standard, for references that are null in part: simple - such a reference is
    satisfied; partial - its non-null columns must match some row; full - it is an orphan (reason `mixed nulls`). A
    reference that is null in all columns is satisfied under each. Reasons: `missing`, `later`, `mixed nulls`. Other
    columns of `child` are kept, one named reason as reason_in; repeated rows are kept.
    """
    if match not in MATCHES:
        raise ValueError(f"match must be one of {MATCHES}")
    mine = [f"__k{i}" for i in range(len(keys))]
    named = apart(child, ["reason"])
    now = dict(zip(child.columns, named.columns))
    child, keys, times = named, [(now[c], p) for c, p in keys], times and (now[times[0]], times[1])
    refs = child.select("*", *(F.col(c).alias(k) for (c, _), k in zip(keys, mine)), (F.col(times[0]) if times else F.lit(None).cast("timestamp")).alias("__at"))
    known = parent.select(*(F.col(p).alias(k) for (_, p), k in zip(keys, mine)), (F.col(times[1]) if times else F.lit(None).cast("timestamp")).alias("__from"))
    found = []
    for nulls in product((False, True), repeat=len(keys)):
        if all(nulls) or any(nulls) and match == "simple":
            continue
        group = refs
        for k, null in zip(mine, nulls):
            group = group.where(F.col(k).isNull() if null else F.col(k).isNotNull())
        if any(nulls) and match == "full":
            found.append(group.select(*child.columns, F.lit("mixed nulls").alias("reason")))
            continue
        on = [k for k, null in zip(mine, nulls) if not null]
        # an undated parent counts as having been there always: it sorts before every date
        there = known.dropna(subset=on).groupBy(*on).agg(F.min("__from").alias("__from"), F.max(F.col("__from").isNull()).alias("__always"))
        found.append(group.join(broadcast_if_small(there.select(*on)), on, "left_anti").select(*child.columns, F.lit("missing").alias("reason")))
        if times:  # only what has a parent, and one that was not always there
            met = group.where("__at is not null").join(broadcast_if_small(there.where(~F.col("__always"))), on).where("__from > __at")
            found.append(met.select(*child.columns, F.lit("later").alias("reason")))
    if not found:
        return child.select("*", F.lit("missing").alias("reason")).limit(0)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
