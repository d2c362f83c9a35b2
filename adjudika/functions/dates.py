"""Date parsing and rendering. Results are zone-free, so the session zone never shifts a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"[\s\x1c-\x1f]"
_DAY, _MONTH, _YEAR, _CLOCK = r"(\d{1,2})", r"(\d{1,2})", r"((?!0000)\d{4})", r"(\d{1,2}:\d{1,2})"

# Accepted spellings.
DMY_SLASH = "d/m/Y"
YMD_DASH = "Y-m-d"
DMY_DASH = "d-m-Y"
DMY_DASH_TIME = "d-m-Y H:M"
DMY_SLASH_TIME = "d/m/Y H:M"

# Pattern of each spelling, and which part each of its groups is.
_SHAPES = {
    DMY_SLASH: (f"{_DAY}/{_MONTH}/{_YEAR}", "dmY"),
    YMD_DASH: (f"{_YEAR}-{_MONTH}-{_DAY}", "Ymd"),
    DMY_DASH: (f"{_DAY}-{_MONTH}-{_YEAR}", "dmY"),
    DMY_DASH_TIME: (f"{_DAY}-{_MONTH}-{_YEAR}{_SPACE}+{_CLOCK}", "dmYT"),
    DMY_SLASH_TIME: (f"{_DAY}/{_MONTH}/{_YEAR}{_SPACE}+{_CLOCK}", "dmYT"),
}
_MARK = "\x01"


def _first_of(c: Column, spellings) -> Column:
    """Zone-free time of the one spelling that fits, NULL if none does or the day does not exist.

    A single regular expression rewrites every accepted spelling to ``mark Y-m-d [H:M]``, so the input expression is
    evaluated once. What stands after the mark is cast; a text that was not rewritten has no mark and gives NULL. (A mark
    in the input is rewritten too, to a mark that no date follows.)
    """
    parts = {"Y": "", "m": "", "d": "", "T": ""}
    group = 0
    for spelling in spellings:
        for part in _SHAPES[spelling][1]:
            group += 1
            parts[part] += f"${group}"
    shapes = "|".join(_SHAPES[s][0] for s in spellings)
    rewritten = F.regexp_replace(
        c, f"(?U)^{_SPACE}*(?:{shapes}){_SPACE}*$|{_MARK}", f"{_MARK}{parts['Y']}-{parts['m']}-{parts['d']} {parts['T']}")
    return F.split_part(rewritten, F.lit(_MARK), F.lit(2)).try_cast("timestamp_ntz")


def parse_datetime(c: Column) -> Column:
    return _first_of(c, (DMY_SLASH, YMD_DASH, DMY_DASH_TIME))


def parse_date(c: Column) -> Column:
    return _first_of(c, (DMY_SLASH, YMD_DASH)).cast("date")


def iso_deadline(raw: Column, spellings=(DMY_SLASH, YMD_DASH, DMY_DASH, DMY_SLASH_TIME)) -> Column:
    """ISO date when one spelling fits, else the raw text."""
    return F.coalesce(F.date_format(_first_of(raw, spellings), "yyyy-MM-dd"), raw)


def deadline_from_cells(cells: list[Column]) -> Column:
    """First cell that looks like a date of this century's twenties, as an ISO date if it parses; ``''`` if none."""
    texts = F.array(*(F.coalesce(c, F.lit("")) for c in cells))
    dated = F.filter(texts, lambda x: x.rlike("[/:-]") & x.rlike("202|20/"))
    return iso_deadline(F.coalesce(F.get(dated, F.lit(0)), F.lit("")))


def iso_or_blank(c: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` with the fraction only when there is one; NULL gives ``''``."""
    micros = F.date_format(c, "SSSSSS")
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.coalesce(F.when(micros != "000000", F.concat(whole, F.lit("."), micros)).otherwise(whole), F.lit(""))


def month_bucket(c: Column) -> Column:
    return F.date_trunc("month", c)


def utc_iso_seconds(instant: Column | None = None) -> Column:
    """UTC stamp such as ``2025-01-31T08:00:00+00:00``. ``instant`` must be a zone-free UTC time."""
    if instant is None:
        instant = F.to_utc_timestamp(F.localtimestamp().cast("timestamp"), F.current_timezone())
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def casablanca_today(utc_now: Column | None = None) -> Column:
    """Calendar day at the portal. ``utc_now`` is a zone-free UTC time; without it the clock is read."""
    if utc_now is None:
        return F.convert_timezone(None, F.lit("Africa/Casablanca"), F.localtimestamp()).cast("date")
    return F.convert_timezone(F.lit("UTC"), F.lit("Africa/Casablanca"), utc_now).cast("date")
