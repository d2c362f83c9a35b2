"""Running totals and sliding counts over evaluation steps.

Events are counted per step first, with partial sums before the exchange. A window then sees one row per step: 1 440 rows
per group and day at the usual minute step, however many events there were. A sliding window is a running total of what
enters and what leaves, so its length costs nothing: three days at a one-minute step is two changes per step, where a
sliding-window grouping would copy each event 4 320 times.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def span(**parts) -> dt.timedelta:
    return dt.timedelta(**parts)


def _seconds(length: dt.timedelta) -> int:
    return int(length.total_seconds())


def shift(ts: Column, length: dt.timedelta) -> Column:
    return ts + F.lit(length)


def step_floor(ts: Column, step: dt.timedelta) -> Column:
    """Start of the evaluation step a zone-free time falls in."""
    size = _seconds(step)
    passed = F.timestamp_diff("SECOND", F.expr(_EPOCH), ts)
    whole = passed - F.pmod(passed, F.lit(size))
    return F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), whole.cast("decimal(18,6)"))


DAY = dt.timedelta(days=1)


def _day(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def running_total(steps: DataFrame, by: list[str], at: str, values: list[str]) -> DataFrame:
    """Replace the changes in ``values`` by their inclusive running sums; ``at`` is unique per ``by``.

    Sums run on two levels, so that no task holds all of a group's time: within a day, and over the totals of the days before, one row a
    day and group. Both read the same exchange of ``steps``.
    """
    dated = steps.withColumn("_day", _day(F.col(at)))
    within = Window.partitionBy(*by, "_day").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*[f"_{b}" for b in by]).orderBy("_on_day").rowsBetween(Window.unboundedPreceding, -1)
    days = dated.groupBy(*by, "_day").agg(*(F.sum(v).alias(f"_{v}") for v in values)).withColumnRenamed("_day", "_on_day")
    days = days.withColumnsRenamed({b: f"_{b}" for b in by}).select(
        *(f"_{b}" for b in by), "_on_day", *(F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_{v}") for v in values))
    summed = dated.withColumns({v: F.sum(v).over(within) for v in values})
    same = [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by]
    joined = summed.join(days, [*same, F.col("_day") == F.col("_on_day")])
    return joined.withColumns({v: F.col(v) + F.col(f"_{v}") for v in values}).select(*steps.columns)


def timeline(groups: DataFrame, by: list[str], start: Column, end: Column, step: dt.timedelta) -> DataFrame:
    """Every evaluation time from ``start`` to ``end`` for every group: first the days, then the steps of each day."""
    distinct = groups.select(*by).distinct()
    if DAY % step:
        return distinct.select(*by, F.explode(F.sequence(start, end, F.lit(step))).alias("t"))
    days = distinct.select(*by, F.explode(F.sequence(_day(start), _day(end), F.lit(DAY))).alias("_d"), start.alias("_start"), end.alias("_end"))
    # ``start`` lies on a step, and a day holds whole steps, so each day's steps are those of one long sequence.
    offset = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.pmod(F.timestamp_diff("SECOND", F.col("_d"), F.col("_start")), F.lit(_seconds(step))).cast("decimal(18,6)"))
    first, last = F.greatest(F.col("_d") + offset, F.col("_start")), F.least(shift(F.col("_d"), DAY - step) + offset, F.col("_end"))
    return days.withColumns({"_first": first, "_last": last}).filter("_first <= _last").select(
        *by, F.explode(F.sequence("_first", "_last", F.lit(step))).alias("t"))


def sliding(counts: DataFrame, at: str, value: str, width: dt.timedelta, step: dt.timedelta, name: str) -> DataFrame:
    """Turn per-step counts into +n when a step enters a sliding window and -n when it leaves.

    ``at`` is the start of a step. The window [t - width, t) at evaluation time t holds that step from ``at + step`` to
    ``at + width``.
    """
    rest = [c for c in counts.columns if c not in (at, value)]
    moves = F.explode(F.array(
        F.struct(shift(F.col(at), step).alias("t"), F.col(value).alias(name)),
        F.struct(shift(F.col(at), width + step).alias("t"), (-F.col(value)).alias(name)),
    )).alias("_m")
    return counts.select(*rest, moves).select(*rest, "_m.*")


def on_timeline(spine: DataFrame, deltas: list[DataFrame], by: list[str], values: list[str]) -> DataFrame:
    """Value of each running series at every time of the spine.

    The spine enters as zero changes, so one aggregation and one running total serve all series. Changes before the
    spine starts still count.
    """
    zero = F.lit(0).cast("bigint")
    union = spine.select(*by, "t", *(zero.alias(v) for v in values), F.lit(True).alias("_on"))
    for d in deltas:
        filled = [(F.col(v).cast("bigint") if v in d.columns else zero).alias(v) for v in values]
        union = union.unionByName(d.select(*by, "t", *filled, F.lit(False).alias("_on")))
    steps = union.groupBy(*by, "t").agg(*(F.sum(v).alias(v) for v in values), F.bool_or("_on").alias("_on"))
    return running_total(steps, by, "t", values).filter("_on").drop("_on")


def held(condition: DataFrame, by: list[str], hold: dt.timedelta, step: dt.timedelta) -> DataFrame:
    """``(by, t, cond, firing)`` for a condition given at every step: it fires once it was true at each step of the
    last ``hold``, both ends included."""
    needed = _seconds(hold) // _seconds(step) + 1
    true = F.col("cond").cast("bigint")
    moves = F.explode(F.array(
        F.struct(F.col("t").alias("t"), true.alias("run"), F.col("cond").alias("cond")),
        F.struct(shift(F.col("t"), hold + step).alias("t"), (-true).alias("run"), F.lit(None).cast("boolean").alias("cond")),
    )).alias("_m")
    steps = condition.select(*by, moves).select(*by, "_m.*").groupBy(*by, "t").agg(
        F.sum("run").alias("run"), F.bool_or("cond").alias("cond"))
    return running_total(steps, by, "t", ["run"]).filter(F.col("cond").isNotNull()).select(
        *by, "t", "cond", (F.col("run") >= needed).alias("firing"))
