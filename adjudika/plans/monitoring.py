"""Alerts and dashboard over metric events, evaluated on a regular time line.

``rollup`` counts the events per series and evaluation step, with partial sums before the exchange, so a burst or a busy
crawler is no hot spot. It is the only pass over the events: every alert, gauge and panel reads the rollup, which is worth
storing. All sliding windows and holds are running totals over its steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudika.operators.running import held, on_timeline, shift, sliding, span, step_floor, timeline

MINUTE = span(minutes=1)
BY = ["spider"]


def rollup(metrics: DataFrame, step=MINUTE) -> DataFrame:
    """Increments per series and step: ``(spider, metric, label, at, n)``."""
    return metrics.groupBy("spider", "metric", "label", step_floor(F.col("ts"), step).alias("at")).agg(
        F.sum("value").cast("bigint").alias("n"))


def bounds(steps: DataFrame) -> tuple[Column, Column]:
    """First and last step of a rollup, as scalar subqueries."""
    return steps.agg(F.min("at")).scalar(), steps.agg(F.max("at")).scalar()


def is_metric(name: str, label: str | None = None) -> Column:
    hit = F.col("metric") == name
    return hit & (F.col("label") == label) if label else hit


def step_counts(steps: DataFrame, chosen: Column, by=BY) -> DataFrame:
    """Increments of the chosen series per group and step, ``(by, at, n)``."""
    return steps.filter(chosen).groupBy(*by, "at").agg(F.sum("n").alias("n"))


def active_changes(steps: DataFrame, step=MINUTE, by=BY) -> DataFrame:
    """Starts minus closes of each step, in effect from the end of that step."""
    sign = F.when(is_metric("spider_started_total"), 1).when(is_metric("spider_closed_total"), -1)
    moves = steps.filter(F.col("metric").isin("spider_started_total", "spider_closed_total"))
    return moves.groupBy(*by, shift(F.col("at"), step).alias("t")).agg(F.sum(sign * F.col("n")).alias("active"))


def active_gauge(steps: DataFrame, start: Column, end: Column, step=MINUTE, by=BY) -> DataFrame:
    """Active crawlers at every evaluation time."""
    return on_timeline(timeline(steps, by, start, end, step), [active_changes(steps, step, by)], by, ["active"])


def windowed(steps: DataFrame, chosen: Column, window, start: Column, end: Column, step=MINUTE, name="n",
             extra: tuple[DataFrame, ...] = (), extra_values: tuple[str, ...] = (), by=BY) -> DataFrame:
    """Events in ``[t - window, t)`` at every evaluation time, beside further running series."""
    moves = sliding(step_counts(steps, chosen, by), "at", "n", window, step, name)
    return on_timeline(timeline(steps, by, start, end, step), [moves, *extra], by, [name, *extra_values])


def alert(series: DataFrame, condition: Column, hold, step=MINUTE, by=BY) -> DataFrame:
    return held(series.withColumn("cond", condition), by, hold, step)


def no_items(steps, start, end, window=span(days=3), hold=span(hours=1), step=MINUTE) -> DataFrame:
    """No tender extracted in the window."""
    series = windowed(steps, is_metric("items_scraped_total", "consultation"), window, start, end, step)
    return alert(series, F.col("n") == 0, hold, step)


def error_rate(steps, start, end, per_second: float = 0.1, window=span(minutes=10), hold=span(minutes=15),
               step=MINUTE) -> DataFrame:
    """More errors per second than the limit, averaged over the window."""
    series = windowed(steps, is_metric("spider_errors_total"), window, start, end, step)
    return alert(series, F.col("n") / F.lit(window.total_seconds()) > per_second, hold, step)


def rate_limited(steps, start, end, more_than: int = 5, window=span(minutes=10), hold=span(minutes=5),
                 step=MINUTE) -> DataFrame:
    """Too many responses with status 429."""
    series = windowed(steps, is_metric("responses_total", "429"), window, start, end, step)
    return alert(series, F.col("n") > more_than, hold, step)


def stuck(steps, start, end, window=span(minutes=30), hold=span(minutes=30), step=MINUTE) -> DataFrame:
    """A crawler is active, but no page came in during the window."""
    series = windowed(steps, is_metric("pages_scraped_total"), window, start, end, step,
                      extra=(active_changes(steps, step),), extra_values=("active",))
    return alert(series, (F.col("n") == 0) & (F.col("active") > 0), hold, step)


def down(heartbeats: DataFrame, now: Column, limits: dict[str, float], default_minutes: float = 5,
         target: str = "spider") -> DataFrame:
    """Targets whose last heartbeat is older than their limit (minutes by target, else the default)."""
    limit = F.coalesce(*(F.when(F.col(target) == t, F.lit(m)) for t, m in limits.items()), F.lit(default_minutes)) \
        if limits else F.lit(default_minutes)
    last = heartbeats.groupBy(target).agg(F.max("ts").alias("dernier"))
    silent = F.timestamp_diff("SECOND", F.col("dernier"), now)
    return last.select(target, "dernier", silent.alias("silence_s"), (silent > limit * 60).alias("down"))


def dashboard(steps: DataFrame, start: Column, end: Column, step=MINUTE, window=span(minutes=5)) -> DataFrame:
    """Per evaluation time, over all crawlers: items so far, errors per second over the window, active crawlers."""
    by = ["portail"]
    whole = steps.withColumn("portail", F.lit("tous"))
    items = step_counts(whole, is_metric("items_scraped_total"), by).select(
        *by, shift(F.col("at"), step).alias("t"), F.col("n").alias("items"))
    series = windowed(whole, is_metric("spider_errors_total"), window, start, end, step, "errors",
                      (items, active_changes(whole, step, by)), ("items", "active"), by)
    return series.select("t", F.col("items").alias("total_items"),
                         (F.col("errors") / F.lit(window.total_seconds())).alias("errors_per_s"), "active")


def episodes(alerts: DataFrame, step=MINUTE, by=BY) -> DataFrame:
    """Firing intervals: an episode starts or ends where the firing flag changes between two steps of the time line.

    Both edges come from one aggregation: each firing step adds a start candidate at t and an end candidate at t + step,
    and where two neighbours meet they cancel.
    """
    firing = alerts.filter("firing")
    edges = firing.select(*by, F.explode(F.array(
        F.struct(F.col("t").alias("t"), F.lit(1).alias("d")),
        F.struct(shift(F.col("t"), step).alias("t"), F.lit(-1).alias("d")))).alias("_e")).select(*by, "_e.*")
    return edges.groupBy(*by, "t").agg(F.sum("d").alias("d")).filter(F.col("d") != 0).select(
        *by, "t", F.when(F.col("d") > 0, "debut").otherwise("fin").alias("bord"))
