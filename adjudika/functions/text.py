"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adjudika.schemas import LONG_TEXT_FIELDS, LONG_TEXT_LIMIT

# Unicode white space (the (?U) flag brings in NBSP and the like) plus the four separator control characters.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def collapse(c: Column) -> Column:
    """Runs of white space become one space, ends trimmed; NULL stays NULL and ``''`` stays ``''``."""
    return F.trim(F.regexp_replace(c, WHITESPACE, " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_text(c: Column) -> Column:
    """``collapse``, with an empty input read as missing. White space alone gives ``''``, not NULL."""
    return collapse(blank_to_null(c))


def preview(c: Column, length: int) -> Column:
    return F.substring(c, 1, length)


def normalize_strings(df: DataFrame) -> DataFrame:
    """Collapse every string column; the long free-text fields are cut after that."""
    out = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            c = collapse(c)
            if field.name in LONG_TEXT_FIELDS:
                c = F.substring(c, 1, LONG_TEXT_LIMIT)
        out.append(c.alias(field.name))
    return df.select(*out)
