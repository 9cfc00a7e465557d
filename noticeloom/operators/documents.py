"""Documents as a whole: totals over pages, warnings and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import LARGE, VERSIONS

#: Warnings under which a text of no length says nothing about images.
DEGRADED = ("BROKEN", "ENCRYPTED", "UNKNOWN_ENCODING")


def totals(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, page_count, text_length, image_count, rotation_count of pages (text, rotation, image_count): what cannot be read
    counts as nothing, and one unreadable page (null text) makes the text's length unknown (null)."""
    readable = F.col("text").isNotNull()
    out = pages.groupBy(doc).agg(
        F.count("*").alias("page_count"),
        F.sum(F.when(readable, F.length("text"))).alias("__chars"),
        F.coalesce(F.sum(F.when(readable, F.col("image_count"))), F.lit(0)).alias("image_count"),
        F.count_if(readable & (F.pmod("rotation", F.lit(360)) != 0)).alias("rotation_count"),
        F.every(readable).alias("__whole"),
    )
    return out.select(doc, "page_count", F.when(F.col("__whole"), F.col("__chars")).alias("text_length"), "image_count", "rotation_count")


def warnings(size: Column, version: Column, encrypted: Column, broken: Column, page_count: Column, text_length: Column) -> Column:
    """The warnings of a document in order of their names. A text of no length means images only, unless the document could
    not be read anyway."""
    unknown = (page_count > 0) & text_length.isNull()
    found = F.array_compact(F.array(F.when(broken, "BROKEN"), F.when(encrypted, "ENCRYPTED"), F.when(unknown, "UNKNOWN_ENCODING")))
    images = ~F.arrays_overlap(found, F.array(*map(F.lit, DEGRADED))) & (page_count > 0) & (F.coalesce(text_length, F.lit(0)) == 0)
    more = F.array_compact(F.array(F.when(images, "IMAGE_ONLY"), F.when(size > LARGE, "LARGE_FILE"), F.when(~F.coalesce(version.isin(*VERSIONS), F.lit(False)), "UNSUPPORTED_VERSION")))
    return F.array_sort(F.array_union(found, more))


def confidence(found: Column) -> Column:
    """(score, band): 0.0 low for a broken document, 0.6 medium with any warning, else 1.0 verified."""
    made = lambda score, band: F.struct(F.lit(score).alias("score"), F.lit(band).alias("band"))
    return F.when(F.array_contains(found, "BROKEN"), made(0.0, "low")).when(F.size(found) > 0, made(0.6, "medium")).otherwise(made(1.0, "verified"))


def analysed(files: DataFrame, pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """All rows of `files` (doc, size, version, encrypted, broken) with totals(), warnings, score and band. A file without
    pages has none of everything."""
    met = files.join(totals(pages, doc), doc, "left")
    met = met.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("page_count", "image_count", "rotation_count")}).withColumn("text_length", F.when(F.col("page_count") == 0, F.lit(0)).otherwise(F.col("text_length")))
    found = met.withColumn("warnings", warnings(*(F.col(c) for c in ("size", "version", "encrypted", "broken", "page_count", "text_length"))))
    return found.withColumn("__c", confidence(F.col("warnings"))).withColumns({"score": F.col("__c.score"), "band": F.col("__c.band")}).drop("__c")
