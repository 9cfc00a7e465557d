"""From pages to sections and from sections to records of positioned columns. No exchange: each row stands alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scoring, text


def sections(pages: DataFrame, body: str = "text", keep: float = scoring.KEEP) -> DataFrame:
    """All columns of `pages` with header, footer, body_lines, section_text and section_score, where the score is at
    least `keep`. With one line, header and footer are that line; null and blank pages score 0.0."""
    found = text.lines(F.col(body))
    out = pages.withColumn("__lines", found).withColumns({
        "header": text.first(F.col("__lines")),
        "footer": text.last(F.col("__lines")),
        "body_lines": F.when(F.size("__lines") > 2, F.slice("__lines", F.lit(2), F.size("__lines") - 2)).otherwise(F.expr("array()").cast("array<string>")),
        "section_text": F.array_join("__lines", "\n"),
        "section_score": scoring.section_score(F.col("__lines")),
    })
    return out.where(F.col("section_score") >= keep).drop("__lines")


def records(sections: DataFrame, body: str = "section_text", pattern: str | None = None, keep: float = scoring.KEEP) -> DataFrame:
    """One row for each line of a section that has columns enough: all columns of `sections` with record_index (the line's
    place from 0 among those not blank, heading included), raw_fields and extraction_score."""
    cut = (lambda x: text.columns(x, pattern)) if pattern else text.columns
    out = sections.select("*", F.posexplode(text.lines(F.col(body))).alias("record_index", "__line")).withColumn("raw_fields", cut(F.col("__line"))).drop("__line")
    return out.withColumn("extraction_score", scoring.extraction_score(F.col("raw_fields"))).where(F.col("extraction_score") >= keep)


def section_records(found: DataFrame, detected: DataFrame, doc: str = "doc_id", index: str = "page_index") -> DataFrame:
    """The rows of sections() of documents whose layout was found, with layout_id, section_label (the header) and page_range
    (JSON [page, page]). Documents of no layout yield nothing."""
    known = detected.where(F.col("layout_id").isNotNull()).select(doc, "layout_id")
    page = F.col(index).cast("string")
    return found.where("section_text <> ''").join(known, doc).withColumns({"section_label": F.col("header"), "page_range": F.concat(F.lit("["), page, F.lit(","), page, F.lit("]"))})


def zipped(rows: DataFrame, left: str, right: str) -> DataFrame:
    """One row for each position of the arrays `left` and `right` of a row, with both elements; arrays of unequal length are
    an error."""
    pairs = F.when(F.size(left) == F.size(right), F.arrays_zip(left, right)).otherwise(F.raise_error(F.lit("arrays of unequal length")))
    rest = [c for c in rows.columns if c not in (left, right)]
    return rows.select(*rest, F.posexplode(pairs).alias("position", "__p")).select(*rest, "position", F.col(f"__p.{left}").alias(left), F.col(f"__p.{right}").alias(right))
