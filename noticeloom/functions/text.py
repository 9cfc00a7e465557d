"""Text expressions: lines, columns and signatures, with the white space of Unicode and not only of ASCII."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# White space beyond ASCII, and the signs that end a line.
BLANK = r"[ \t\n\r\f\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
LINE_END = r"\r\n|[\n\r\f\x{0B}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"


def strip(text: Column) -> Column:
    """Without white space at both ends; F.trim knows the space only."""
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def lines(text: Column) -> Column:
    """The stripped lines that are not blank; none for null."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), LINE_END), strip), lambda x: x != "")


def blocks(text: Column) -> Column:
    """Pieces between empty lines that are not blank."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n\n"), lambda x: strip(x) != "")


def first(items: Column) -> Column:
    return F.try_element_at(items, F.lit(1))


def last(items: Column) -> Column:
    return F.when(F.size(items) > 0, F.try_element_at(items, F.lit(-1)))


def columns(line: Column, pattern: str = f"{BLANK}{{2,}}") -> Column:
    """Pieces of a line between matches of `pattern`, blank ones dropped, as (name, value) named column_1, column_2, ..."""
    pieces = F.filter(F.split(strip(line), pattern), lambda x: strip(x) != "")
    return F.transform(pieces, lambda x, i: F.struct(F.concat(F.lit("column_"), (i + 1).cast("string")).alias("name"), x.alias("value")))


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def nfkc(text: Column) -> Column:
    """Compatibility form. There is no built-in for it, so Python sees the text, and nothing else of the row."""
    return _nfkc(text)
