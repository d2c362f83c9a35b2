"""Money parsing. Two rules exist on purpose: the page rule drops foreign characters, the cleaning rule does not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adjudika.functions.text import blank_to_null

MONEY_TYPE = "decimal(15,2)"

# Spellings of a decimal number (digit groups may be joined by "_"), or of an infinity / not-a-number. Java would also
# take suffixes such as "1d", so the shape is tested before the cast.
_NUMBER = (
    r"(?i)^[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?$|^[+-]?(inf|infinity|nan)$"
)


def double_or_null(c: Column) -> Column:
    trimmed = F.trim(c)
    return F.when(trimmed.rlike(_NUMBER), F.replace(trimmed, F.lit("_"), F.lit("")).try_cast("double"))


def parse_amount(c: Column) -> Column:
    """Page rule: keep digits, comma and dot, then read as a number (``1 234 567,89 DH`` gives 1234567.89)."""
    kept = F.regexp_replace(c, "[^0-9,.]", "")
    return blank_to_null(F.replace(kept, F.lit(","), F.lit("."))).try_cast("double")


def clean_amount(c: Column) -> Column:
    """Cleaning rule: only the comma is replaced, so inner spaces or a currency make the value missing."""
    return double_or_null(F.replace(c, F.lit(","), F.lit(".")))


def money(c: Column) -> Column:
    """Typed amount; a value that does not fit becomes NULL."""
    return c.try_cast(MONEY_TYPE)


def zero_as_null(c: Column) -> Column:
    """0 and NULL both read as "no amount"."""
    return F.when(c != 0, c)
