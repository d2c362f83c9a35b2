"""The ledger of a store's runs: which were applied, in which order they began, and which broke off.

Each event is one small row. A run that was applied is not applied again, and every stored row carries the number of the run that wrote it
last, so a run that is repeated late cannot bring older values back. A store has one writer at a time; the ledger finds a writer that broke
off, it does not lock out a second one.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudika.session import path_exists

SCHEMA = "event bigint, kind string, lot_id bigint, seq bigint, state string, at timestamp_ntz, counters map<string,bigint>"
BEGUN, APPLIED, BROKEN = "begun", "applied", "broken"


@dataclass
class Run:
    """``seq``: the place among all runs of the store. ``counters`` is set if the run was applied before."""
    kind: str
    lot_id: int
    seq: int
    counters: dict[str, int] | None = None
    broken: list = field(default_factory=list)  # (kind, lot_id, seq) of runs that have begun and not ended


class RunLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._event = 0  # the number of the next event, as of the last look

    def events(self) -> DataFrame:
        if path_exists(self.spark, self.path):
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        return self.spark.createDataFrame([], SCHEMA)

    def runs(self) -> DataFrame:
        """The last state of every run: kind, lot_id, seq, state, at, counters, event."""
        rest = ("seq", "state", "at", "counters")
        return self.events().groupBy("kind", "lot_id").agg(F.max_by(F.struct(*rest, "event"), "event").alias("_r")).select("kind", "lot_id", "_r.*")

    def look(self, kind: str, lot_id: int) -> Run:
        """What the ledger knows about a run; a run that it does not know gets the next number."""
        mine = (F.col("kind") == kind) & (F.col("lot_id") == int(lot_id))
        # At most one row is mine, and runs that broke off are few.
        seen = self.runs().agg(
            F.max("seq").alias("top"), F.max("event").alias("event"), F.first(F.when(mine, F.struct("seq", "state", "counters")), ignorenulls=True).alias("mine"),
            F.collect_list(F.when(F.col("state") == BEGUN, F.struct("kind", "lot_id", "seq"))).alias("open")).first()
        seq = seen.mine.seq if seen.mine else (-1 if seen.top is None else seen.top) + 1
        self._event = 0 if seen.event is None else seen.event + 1
        done = dict(seen.mine.counters or {}) if seen.mine and seen.mine.state == APPLIED else None
        return Run(kind, int(lot_id), seq, done, [tuple(r) for r in seen.open])

    def note(self, *runs: tuple[str, int, int], state: str, counters: dict[str, int] | list[dict[str, int]] | None = None) -> None:
        """Append one event for each run (kind, lot_id, seq), with its counters; ``look`` comes before it."""
        if not runs:
            return
        first, now = self._event, dt.datetime.now()
        self._event += len(runs)
        each = counters if isinstance(counters, list) else [counters] * len(runs)
        rows = [(first + k, *run, state, now, own) for k, (run, own) in enumerate(zip(runs, each))]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
