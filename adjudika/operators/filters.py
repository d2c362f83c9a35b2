"""Optional predicates. An argument that is empty, zero or None adds no condition."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudika.session import cut_lineage


def contains_ci(column: str, term: str, literal: bool = False) -> Column:
    """Case-insensitive "contains". ``%`` and ``_`` in the term are wildcards unless ``literal``."""
    if literal:
        for special in ("\\", "%", "_"):
            term = term.replace(special, f"\\{special}")
    return F.col(column).ilike(f"%{term}%")


def equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == value) if value else df


def contains(df: DataFrame, column: str, term: str | None, literal: bool = False) -> DataFrame:
    return df.filter(contains_ci(column, term, literal)) if term else df


def between(df: DataFrame, column: str, low=None, high=None, whole_end_day: bool = False) -> DataFrame:
    """Inclusive range. On a timestamp column an end *day* means its midnight, unless ``whole_end_day``."""
    kind = df.schema[column].dataType.simpleString()
    cast = kind if kind in ("date", "timestamp", "timestamp_ntz") else None

    def bound(v) -> Column:
        return F.lit(str(v)).cast(cast) if cast else F.lit(v)

    if low:
        df = df.filter(F.col(column) >= bound(low))
    if high and whole_end_day and isinstance(high, dt.date):
        df = df.filter(F.col(column) < bound(high + dt.timedelta(days=1)))
    elif high:
        df = df.filter(F.col(column) <= bound(high))
    return df


def any_present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where at least one of the columns is non-empty."""
    keep = F.lit(False)
    for c in columns:
        keep = keep | (F.coalesce(F.col(c), F.lit("")) != "")
    return df.filter(keep)


def search_window(df: DataFrame, today: Column, published: str = "date_publication", opening: str = "date_limite",
                  back_days: int = 180, ahead_days: int = 183) -> DataFrame:
    """Published in the last ``back_days`` and opening in the next ``ahead_days``, both ends included."""
    return df.filter(
        F.col(published).cast("date").between(F.date_sub(today, back_days), today)
        & F.col(opening).cast("date").between(today, F.date_add(today, ahead_days)))


def page(df: DataFrame, newest: str, tiebreak: list[str], limit: int = 100, offset: int = 0,
         max_limit: int = 1000) -> DataFrame:
    """One page, newest first. The tie-break makes the order total, so pages never overlap."""
    if not 1 <= limit <= max_limit:
        raise ValueError(f"limit must lie between 1 and {max_limit}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    ordered = df.orderBy(F.desc(newest), *tiebreak)
    return (ordered.offset(offset) if offset else ordered).limit(limit)


def page_after(df: DataFrame, newest: str, tiebreak: list[str], cursor: dict | None = None, limit: int = 100, max_limit: int = 1000) -> DataFrame:
    """The page that follows the row whose sort values ``cursor`` holds (None: the first page), in the order of ``page``.

    The cursor becomes a filter that the scan can use, so a late page costs as much as the first: no rows are sorted to be skipped. NULL
    dates come last, NULLs of the tie-break first, as Spark orders them. Sort values have to tell rows apart, or equal ones may be split.
    """
    if not 1 <= limit <= max_limit:
        raise ValueError(f"limit must lie between 1 and {max_limit}")
    if cursor is not None:
        def bound(name: str) -> Column:
            return F.lit(cursor[name]).cast(df.schema[name].dataType)

        at = F.col(newest)
        older = at.isNull() if cursor[newest] is None else (at < bound(newest)) | at.isNull()
        older = F.lit(False) if cursor[newest] is None else older
        same = at.eqNullSafe(bound(newest))
        after = F.lit(False)
        for name in reversed(tiebreak):
            c = F.col(name)
            greater = c.isNotNull() if cursor[name] is None else c > bound(name)
            after = F.coalesce(greater, F.lit(False)) | (c.eqNullSafe(bound(name)) & after)
        # The plain bound is what a scan can push down; where it holds, the rest decides.
        if cursor[newest] is not None:
            df = df.filter((at <= bound(newest)) | at.isNull())
        df = df.filter(F.coalesce(older, F.lit(False)) | (same & after))
    return df.orderBy(F.desc(newest), *tiebreak).limit(limit)


class Pages:
    """All pages of a list, in the order of ``page``: one after the other by iterating, or as one table by ``rows``."""

    def __init__(self, df: DataFrame, newest: str, tiebreak: list[str], limit: int, max_limit: int):
        if not 1 <= limit <= max_limit:
            raise ValueError(f"limit must lie between 1 and {max_limit}")
        self.df, self.newest, self.tiebreak, self.limit, self.max_limit = df, newest, tiebreak, limit, max_limit

    def __iter__(self):
        """Each page as a list of rows, found by the last row of the page before; a reader that stops early has read no further page.

        The first page is taken from the list as it is. Whoever asks for more has the list sorted and stored once, and a page costs the
        files that its cursor cannot rule out, not the whole list again.
        """
        cursor, source = None, self.df
        while True:
            rows = page_after(source, self.newest, self.tiebreak, cursor, self.limit, self.max_limit).collect()  # at most ``limit``
            if rows:
                yield rows
            if len(rows) < self.limit:
                return
            if cursor is None:
                source = cut_lineage(self.df.orderBy(F.desc(self.newest), *self.tiebreak), "pages")
            cursor = {name: rows[-1][name] for name in (self.newest, *self.tiebreak)}

    def rows(self) -> DataFrame:
        """The rows of all pages with ``rang``, the place in the list from 0 on, and ``page``: sorted once, in ranges, and no row passes the driver.

        Places are counted within each range; the ranges before a row, one number each, add up to the rest.
        """
        sorted_rows = self.df.orderBy(F.desc(self.newest), *self.tiebreak).withColumn("_at", F.monotonically_increasing_id())
        held = cut_lineage(sorted_rows, "pages")
        span = F.shiftright("_at", 33)  # the range's number; the lower bits count its rows
        sizes = held.groupBy(span.alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
        before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # one row a range
        starts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
        rang = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
        placed = held.withColumn("_range", span).join(F.broadcast(starts), "_range").withColumn("rang", rang)
        return placed.withColumn("page", F.floor(F.col("rang") / self.limit).cast("bigint")).select(*self.df.columns, "rang", "page")


def pages_of(df: DataFrame, newest: str, tiebreak: list[str], limit: int = 100, max_limit: int = 1000) -> Pages:
    """All pages of the list; see ``Pages``."""
    return Pages(df, newest, tiebreak, limit, max_limit)
