"""Alerts over a stream of metric events: sliding rates and holds that live on across micro-batches and restarts.

Each task adds up its events per crawler and minute before they travel, so a burst or a busy crawler crosses the exchange as one row a minute
and Arrow batch. The state of a crawler holds the minutes that its longest window still needs, the number of active crawls and how
long each condition has held. An event-time timer wakes it when the watermark moves on, also if nothing happens any more: silence is what two of
the alerts are about. It emits edges only, where an alert starts or stops firing; they equal those of the batch form (``plans.monitoring``)
up to the watermark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from adjudika.session import ship_package

MINUTE_MS = 60_000
EDGES = "spider string, alerte string, t timestamp, bord string"
_STATE = "next bigint, minutes array<bigint>, counts array<bigint>, active bigint, held array<bigint>"


@dataclass(frozen=True)
class Rule:
    """Fires once its condition was true at every minute of the last ``hold`` minutes, both ends included.

    The condition: more than ``above`` events of the series in the ``window`` minutes before, or none of them if ``above`` is None; with
    ``while_active``, only while a crawl is active.
    """
    name: str
    metric: str
    window: int
    hold: int
    label: str | None = None
    above: float | None = None
    while_active: bool = False

    def holds(self, n: np.ndarray, active: np.ndarray) -> np.ndarray:
        true = n == 0 if self.above is None else n > self.above
        return true & (active > 0) if self.while_active else true


def alert_rules(errors_per_second: float = 0.1, limited: int = 5) -> list[Rule]:
    """The four alerts of the monitoring with their windows and holds in minutes."""
    return [
        Rule("no_items", "items_scraped_total", 3 * 1440, 60, "consultation"),
        Rule("error_rate", "spider_errors_total", 10, 15, above=errors_per_second * 600),
        Rule("rate_limited", "responses_total", 10, 5, "429", above=limited),
        Rule("stuck", "pages_scraped_total", 30, 30, while_active=True),
    ]


def _minutes(metrics: DataFrame, rules: list[Rule], watermark: str) -> DataFrame:
    """spider, at (a minute), and as an array one count a rule and the change of active crawls; a minute may come in several rows."""
    def of(rule: Rule):
        hit = F.col("metric") == rule.metric
        return F.when(hit & (F.col("label") == rule.label) if rule.label else hit, F.col("value")).otherwise(0.0)

    moves = F.when(F.col("metric") == "spider_started_total", F.col("value")).when(F.col("metric") == "spider_closed_total", -F.col("value")).otherwise(0.0)
    names = [f"c{k}" for k in range(len(rules) + 1)]
    chosen = metrics.select("spider", F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("at"),
                            *(c.cast("bigint").alias(n) for n, c in zip(names, [*map(of, rules), moves])))

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows.groupby(["spider", "at"], as_index=False)[names].sum()

    kinds = ", ".join(f"{n} bigint" for n in names)
    summed = chosen.mapInPandas(added, f"spider string, at timestamp, {kinds}")
    return summed.select("spider", "at", F.array(*names).alias("counts")).withWatermark("at", watermark)


class _Watch:
    """What one crawler's state becomes as minutes close."""

    def __init__(self, rules: list[Rule], start: int, held: tuple | None):
        self.rules, self.width = rules, len(rules) + 1
        if held is None:
            self.next, self.active = start, 0
            self.minutes, self.counts = np.zeros(0, np.int64), np.zeros((0, self.width), np.int64)
            self.runs = np.zeros(len(rules), np.int64)
        else:
            self.next, minutes, counts, self.active, runs = held
            self.minutes, self.counts = np.array(minutes, np.int64), np.array(counts, np.int64).reshape(-1, self.width)
            self.runs = np.array(runs, np.int64)

    def add(self, minutes: np.ndarray, counts: np.ndarray) -> None:
        every, place = np.unique(np.concatenate([self.minutes, minutes]), return_inverse=True)
        summed = np.zeros((len(every), self.width), np.int64)
        np.add.at(summed, place, np.concatenate([self.counts, counts]))
        self.minutes, self.counts = every, summed

    def advance(self, until: int) -> list[tuple[str, int, str]]:
        """Evaluate the minutes from the next one to ``until`` and return the edges (alert, minute, edge)."""
        edges = []
        while self.next <= until:  # in slices, so that a long silence needs no long array
            edges += self._slice(min(until, self.next + 10_000))
        longest = max(r.window for r in self.rules)
        keep = self.minutes >= self.next - 1 - longest
        self.minutes, self.counts = self.minutes[keep], self.counts[keep]
        return edges

    def _slice(self, until: int) -> list[tuple[str, int, str]]:
        steps = np.arange(self.next, until + 1)
        total = np.concatenate([np.zeros((1, self.width), np.int64), np.cumsum(self.counts, 0)])
        upto = np.searchsorted(self.minutes, steps)  # minutes before each step
        # ``active`` counts every change before the next step, also those of minutes that are no longer kept.
        entered = np.searchsorted(self.minutes, self.next - 1)
        active = self.active + total[upto, -1] - total[entered, -1]
        edges = []
        for k, rule in enumerate(self.rules):
            n = total[upto, k] - total[np.searchsorted(self.minutes, steps - rule.window), k]
            true = rule.holds(n, active)
            place = np.arange(len(steps))
            broken = np.maximum.accumulate(np.where(true, -1, place))
            run = np.where(broken < 0, self.runs[k] + place + 1, place - broken)
            firing = run > rule.hold
            before = np.append(self.runs[k] > rule.hold, firing[:-1])
            edges += [(rule.name, int(steps[i]), "debut" if firing[i] else "fin") for i in np.flatnonzero(firing != before)]
            self.runs[k] = run[-1]
        self.active, self.next = int(active[-1]), int(until) + 1
        return edges

    def state(self) -> tuple:
        return self.next, self.minutes.tolist(), self.counts.ravel().tolist(), self.active, self.runs.tolist()


def alert_edges(metrics: DataFrame, rules: list[Rule], start, watermark: str = "10 minutes") -> DataFrame:
    """``(spider, alerte, t, bord)``: where an alert starts (``debut``) or stops (``fin``) firing; append mode.

    ``metrics``: a stream of (ts, spider, metric, label, value); events of minutes that the watermark has passed are not counted. ``start``: the first minute
    that is evaluated, for every crawler; what happened before counts in windows and gauges.
    """
    first = int(pd.Timestamp(start).value // 10**6) // MINUTE_MS

    def watch(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = _Watch(rules, first, tuple(state.get) if state.exists else None)
        for rows in batches:
            if not len(rows):  # the timer
                continue
            at = rows["at"].to_numpy().astype("datetime64[ms]").astype(np.int64) // MINUTE_MS
            held.add(at, np.stack(rows["counts"].to_numpy()).astype(np.int64).reshape(len(at), held.width))
        now = state.getCurrentWatermarkMs()
        edges = held.advance(now // MINUTE_MS)
        state.update(held.state())
        state.setTimeoutTimestamp((now // MINUTE_MS + 1) * MINUTE_MS)
        yield pd.DataFrame({"spider": [key[0]] * len(edges), "alerte": [e[0] for e in edges],
                            "t": pd.to_datetime([e[1] * MINUTE_MS for e in edges], unit="ms"), "bord": [e[2] for e in edges]})

    ship_package(metrics.sparkSession)
    closed = _minutes(metrics, rules, watermark)
    return closed.groupBy("spider").applyInPandasWithState(watch, EDGES, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
