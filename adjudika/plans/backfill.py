"""Backfill of a year through the ingest, in groups of days, taken up again where it broke off.

The store's ledger holds every day that is done. A group's rows are stored by one ingest run, whose number is the group's first day; its days
are noted after it. If the job breaks off in between, the group is run again under the same number, which changes nothing, and its days
are noted then.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudika.plans.ingest import Ingest
from adjudika.plans.retention import year_calendar
from adjudika.sinks.ledger import APPLIED

DAY = "backfill"


def _number(day: dt.date) -> int:
    return day.year * 10_000 + day.month * 100 + day.day


@dataclass
class Backfill:
    """``records``: what the portal has, with its publication time in ``published``; rows without one belong to no day."""
    ingest: Ingest
    records: DataFrame
    published: str = "date_publication"
    days_per_run: int = 31

    def state(self, year: int) -> DataFrame:
        """Every day of the year: jour, done, and n, the records it brought (0 while it is open)."""
        done = self.ingest.store.ledger.runs().filter((F.col("kind") == DAY) & (F.col("state") == APPLIED)).select(
            F.to_date(F.col("lot_id").cast("string"), "yyyyMMdd").alias("jour"), F.lit(True).alias("done"), F.col("counters")["n"].alias("n"))
        calendar = year_calendar(self.ingest.store.spark, year)
        return calendar.join(done, "jour", "left").select("jour", F.coalesce("done", F.lit(False)).alias("done"), F.coalesce("n", F.lit(0)).alias("n"))

    def run(self, year: int, groups: int | None = None, now: Column | None = None) -> int:
        """Run the open days of the year, ``groups`` groups at most; returns how many groups ran."""
        open_days = sorted(r.jour for r in self.state(year).filter("not done").select("jour").collect())  # at most 366
        first = dt.date(year, 1, 1)
        ran = 0
        for _, days in groupby(open_days, lambda d: (d - first).days // self.days_per_run):
            if ran == groups:
                break
            self._group(list(days), now)
            ran += 1
        return ran

    def _group(self, days: list[dt.date], now: Column | None) -> None:
        # A range on the column itself reaches the scan; the list of days leaves out those that are done.
        low, high = (F.lit(str(d)).cast("timestamp_ntz") for d in (days[0], days[-1] + dt.timedelta(days=1)))
        day = F.col(self.published).cast("date")
        rows = self.records.filter((F.col(self.published) >= low) & (F.col(self.published) < high) & day.isin(days))
        self.ingest.run(rows, _number(days[0]), now)
        found = {r.jour: r.n for r in rows.groupBy(day.alias("jour")).agg(F.count(F.lit(1)).alias("n")).collect()}
        ledger = self.ingest.store.ledger
        seq = ledger.look(self.ingest.kind, _number(days[0])).seq
        ledger.note(*((DAY, _number(d), seq) for d in days), state=APPLIED, counters=[{"n": found.get(d, 0)} for d in days])
