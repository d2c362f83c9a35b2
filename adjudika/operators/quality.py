"""Record checks. Rows are labelled, never lost: good rows and quarantined rows together are the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adjudika.functions import clean_amount, normalize_strings
from adjudika.schemas import AMOUNT_FIELDS, ENUMS, MAX_LENGTH, NOT_NULL, REQUIRED_FIELDS, TABLES

MISSING = "missing_required_field"
DUPLICATE = "duplicate"
DATABASE = "database_error"


def _first_true(checks: list[tuple[str, Column]]) -> Column:
    """Name of the first failing check, NULL when none fails."""
    if not checks:
        return F.lit(None).cast("string")
    return F.coalesce(*(F.when(bad, F.lit(name)) for name, bad in checks))


def is_missing(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(True)
    c = F.col(name)
    return (c.isNull() | (c == "")) if isinstance(df.schema[name].dataType, T.StringType) else c.isNull()


def _label(df: DataFrame, reason: str, field: Column) -> DataFrame:
    """Set ``_reason`` / ``_field`` where a check fails; an earlier label stands."""
    if "_reason" not in df.columns:
        df = df.withColumns({"_reason": F.lit(None).cast("string"), "_field": F.lit(None).cast("string")})
    return df.withColumn("_new", F.when(F.col("_reason").isNull(), field)).withColumns({
        "_reason": F.coalesce("_reason", F.when(F.col("_new").isNotNull(), F.lit(reason))),
        "_field": F.coalesce("_field", "_new"),
    }).drop("_new")


def check_required(df: DataFrame, kind: str) -> DataFrame:
    """Label rows that lack a required field; an empty text counts as missing, white space does not."""
    return _label(df, MISSING, _first_true([(f, is_missing(df, f)) for f in REQUIRED_FIELDS[kind]]))


def check_storable(df: DataFrame, kind: str) -> DataFrame:
    """Label rows that the typed table would refuse: NULL where none is allowed, a value outside its enum, a text that
    is too long, an amount that does not fit."""
    checks: list[tuple[str, Column]] = []
    for name in NOT_NULL[kind]:
        checks.append((name, F.col(name).isNull() if name in df.columns else F.lit(True)))
    for field in TABLES[kind]:
        if field.name not in df.columns:
            continue
        c = F.col(field.name)
        if field.name in ENUMS:
            checks.append((field.name, c.isNotNull() & ~c.isin(*ENUMS[field.name])))
        if field.name in MAX_LENGTH:
            checks.append((field.name, F.length(c) > MAX_LENGTH[field.name]))
        if isinstance(field.dataType, T.DecimalType):
            checks.append((field.name, c.isNotNull() & c.try_cast(field.dataType).isNull()))
    return _label(df, DATABASE, _first_true([(n, F.coalesce(bad, F.lit(False))) for n, bad in checks]))


def clean_record(df: DataFrame) -> DataFrame:
    """Collapse white space in every text column, cut the long ones, read text amounts as numbers."""
    text_amounts = [f.name for f in df.schema if f.name in AMOUNT_FIELDS and isinstance(f.dataType, T.StringType)]
    cleaned = normalize_strings(df)
    return cleaned.withColumns({n: clean_amount(F.col(n)) for n in text_amounts}) if text_amounts else cleaned


def good(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_reason").isNull()).drop("_reason", "_field")


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_reason").isNotNull())


def as_table(df: DataFrame, kind: str) -> DataFrame:
    """Exactly the typed columns of the table, absent ones as NULL."""
    return df.select(*(
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in TABLES[kind]
    ))


def blank_not_null(df: DataFrame, kind: str) -> DataFrame:
    """How many rows hold ``''`` in a text column that may not be NULL: stored, but worth a look."""
    names = [n for n in NOT_NULL[kind] if n in df.columns and isinstance(df.schema[n].dataType, T.StringType)]
    return df.agg(*(F.count_if(F.col(n) == "").alias(n) for n in names))
