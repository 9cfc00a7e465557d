"""Features of records, and keys and checksums derived from them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

SUSPICIOUS = "[\\x{FFFD}\\x{0}]"


def _share(items: Column, test) -> Column:
    return F.when(F.size(items) > 0, F.size(F.filter(items, test)) / F.size(items)).otherwise(0.0)


def fill_rate(fields: Column) -> Column:
    """Share of (name, value) fields whose value is not blank; 0.0 without fields."""
    return _share(fields, lambda f: f["value"].isNotNull() & (text.strip(f["value"]) != ""))


def suspicious_rate(fields: Column) -> Column:
    """Share of fields that hold a replacement character or a NUL."""
    return _share(fields, lambda f: F.coalesce(f["value"].rlike(SUSPICIOUS), F.lit(False)))


def change_rate(fields: Column) -> Column:
    """Share of (value, raw) fields whose value is not the raw one; null differs from a value."""
    return _share(fields, lambda f: ~f["value"].eqNullSafe(f["raw"]))


def subject_ref(*parts: Column) -> Column:
    """The first 63 of the first 64 bits of the SHA-256 of the parts joined with colons (null is `-`), without the sign."""
    digest = F.sha2(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)), 256)
    whole = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    return (whole % F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("long")


def checksum(*parts: Column) -> Column:
    return F.sha2(F.concat_ws(":", *parts), 256)


def in_range(rates: Column) -> Column:
    """The entries of a map of features, named *_rate or *_confidence, that are outside [0, 1]."""
    return F.map_filter(rates, lambda k, v: (k.endswith("_rate") | k.endswith("_confidence")) & ~v.between(0, 1))


def sequence_checksum(rows: DataFrame, parts: list[Column], order: list[str]) -> DataFrame:
    """n and checksum: one SHA-256 over all rows in their order, each part ended by a NUL; null parts count as empty. A
    digest of a sequence is sequential, so one task reads the sorted rows as a stream and holds none of them."""
    ended = F.concat(*(F.concat(F.coalesce(p, F.lit("")), F.lit("\0")) for p in parts))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = hashlib.sha256(), 0
        for pdf in batches:
            n += len(pdf)
            for text in pdf["text"]:
                total.update(text.encode("utf-8", "surrogatepass"))
        yield pd.DataFrame({"n": [n], "checksum": [total.hexdigest()]})

    texts = rows.select(*order, ended.alias("text")).repartition(1).sortWithinPartitions(*order).select("text")
    return texts.mapInPandas(digest, "n long, checksum string")


def feature(vector: Column, name: str, default: float) -> Column:
    """A feature of a map, or the default where it is missing or null."""
    return F.coalesce(F.try_element_at(vector, F.lit(name)), F.lit(default))


def quarantined(rows: DataFrame, vector: str = "features") -> tuple[DataFrame, DataFrame]:
    """Rows whose rates and confidences are all within [0, 1], and the others with `outside`, the entries that are not."""
    told = rows.withColumn("outside", in_range(F.col(vector)))
    return told.where(F.size("outside") == 0).drop("outside"), told.where(F.size("outside") > 0)


def same_keys(a: Column, b: Column) -> Column:
    """Whether two arrays of (name, value) have the same set of names."""
    names = lambda x: F.array_sort(F.array_distinct(F.transform(x, lambda f: f["name"])))
    return names(a).eqNullSafe(names(b))
