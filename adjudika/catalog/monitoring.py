"""Alerts and dashboard series over the metric events.

The thresholds fit the given events, which are sparser than a portal crawl; the functions' defaults are the alert
rules' own values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudika.catalog import bindings_sql as B
from adjudika.catalog.registry import query
from adjudika.operators.running import span
from adjudika.plans import monitoring as M
from adjudika.session import cut_lineage
from adjudika.sources import driver_tables as D


def _series(counted: str, window_minutes: int) -> str:
    """Common table expressions up to ``w``: events in the window before each minute, per crawler."""
    return f"""{B.METRICS},
 b AS (SELECT date_trunc('minute', min(ts)) AS lo, date_trunc('minute', max(ts)) AS hi FROM metrics),
 spine AS (SELECT spider, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS t FROM (SELECT DISTINCT spider FROM metrics), b),
 c AS (SELECT spider, date_trunc('minute', ts) AS t, count(*) AS n FROM metrics WHERE {counted} GROUP BY ALL),
 a AS (SELECT spider, date_trunc('minute', ts) AS t, count(*) FILTER (WHERE metric = 'spider_started_total')
   - count(*) FILTER (WHERE metric = 'spider_closed_total') AS d FROM metrics GROUP BY ALL),
 s AS (SELECT spider, t, coalesce(n, 0) AS n, coalesce(d, 0) AS d FROM spine LEFT JOIN c USING (spider, t) LEFT JOIN a USING (spider, t)),
 w AS (SELECT spider, t,
   coalesce(sum(n) OVER (PARTITION BY spider ORDER BY t RANGE BETWEEN INTERVAL {window_minutes} MINUTE PRECEDING AND INTERVAL 1 MINUTE PRECEDING), 0) AS n,
   coalesce(sum(d) OVER (PARTITION BY spider ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MINUTE PRECEDING), 0) AS active
   FROM s)"""


def _alert_sql(counted: str, window_minutes: int, condition: str, hold_minutes: int) -> str:
    return f"""WITH {_series(counted, window_minutes)},
 f AS (SELECT spider, t, cond, sum(CASE WHEN cond THEN 1 ELSE 0 END) OVER (PARTITION BY spider ORDER BY t
   RANGE BETWEEN INTERVAL {hold_minutes} MINUTE PRECEDING AND CURRENT ROW) = {hold_minutes + 1} AS firing
   FROM (SELECT *, {condition} AS cond FROM w))"""


_DAILY_SQL = """ SELECT spider, date_trunc('day', t) AS jour, count(*) AS pas, count(*) FILTER (WHERE cond) AS vrais,
  count(*) FILTER (WHERE firing) AS actifs FROM f GROUP BY ALL"""


def _rollup(spark, sf_dir):
    """The rollup, stored so that bounds, groups and counts below read it and not the events."""
    return cut_lineage(M.rollup(D.metrics(spark, sf_dir)), "rollup")


def _daily(alerts):
    """Steps, true steps and firing steps per crawler and day."""
    return alerts.groupBy("spider", F.date_trunc("day", "t").alias("jour")).agg(
        F.count(F.lit(1)).alias("pas"), F.count_if("cond").alias("vrais"), F.count_if("firing").alias("actifs"))


_ITEMS = "metric = 'items_scraped_total' AND label = 'consultation'"
_ERRORS = "metric = 'spider_errors_total'"
_PAGES = "metric = 'pages_scraped_total'"
_LIMITED = "metric = 'responses_total' AND label = '429'"


@query("mon_no_items", _alert_sql(_ITEMS, 300, "n = 0", 60) + _DAILY_SQL)
def mon_no_items(spark, sf_dir):
    steps = _rollup(spark, sf_dir)
    return _daily(M.no_items(steps, *M.bounds(steps), window=span(hours=5)))


@query("mon_no_items_3_days", _alert_sql(_ITEMS, 4320, "n = 0", 60) + _DAILY_SQL)
def mon_no_items_3_days(spark, sf_dir):
    steps = _rollup(spark, sf_dir)
    return _daily(M.no_items(steps, *M.bounds(steps)))


@query("mon_error_rate", _alert_sql(_ERRORS, 60, "n / 3600.0 > 0.0005", 15) + _DAILY_SQL)
def mon_error_rate(spark, sf_dir):
    steps = _rollup(spark, sf_dir)
    return _daily(M.error_rate(steps, *M.bounds(steps), per_second=0.0005, window=span(hours=1)))


@query("mon_429", _alert_sql(_LIMITED, 240, "n > 1", 5) + _DAILY_SQL)
def mon_429(spark, sf_dir):
    steps = _rollup(spark, sf_dir)
    return _daily(M.rate_limited(steps, *M.bounds(steps), more_than=1, window=span(hours=4)))


@query("mon_stuck", _alert_sql(_PAGES, 30, "n = 0 AND active > 0", 30) + _DAILY_SQL)
def mon_stuck(spark, sf_dir):
    steps = _rollup(spark, sf_dir)
    return _daily(M.stuck(steps, *M.bounds(steps)))


@query("mon_hold", _alert_sql(_ERRORS, 60, "n >= 1", 30) + """,
 g AS (SELECT spider, t, firing, coalesce(lag(firing) OVER (PARTITION BY spider ORDER BY t), false) AS before,
   coalesce(lead(firing) OVER (PARTITION BY spider ORDER BY t), false) AS after FROM f)
SELECT spider, t, 'debut' AS bord FROM g WHERE firing AND NOT before
UNION ALL SELECT spider, t + INTERVAL 1 MINUTE, 'fin' FROM g WHERE firing AND NOT after""")
def mon_hold(spark, sf_dir):
    steps = _rollup(spark, sf_dir)
    alerts = M.error_rate(steps, *M.bounds(steps), per_second=0.9 / 3600, window=span(hours=1), hold=span(minutes=30))
    return M.episodes(alerts)


@query("agg_active_gauge", f"WITH {_series(_PAGES, 30)} SELECT spider, t, CAST(active AS BIGINT) AS active FROM w")
def agg_active_gauge(spark, sf_dir):
    steps = _rollup(spark, sf_dir)
    return M.active_gauge(steps, *M.bounds(steps))


@query("mon_down", B.with_tables("""
SELECT spider, max(ts) AS dernier, CAST(trunc((epoch_us((SELECT max(ts) FROM metrics)) - epoch_us(max(ts))) / 1000000) AS BIGINT) AS silence_s,
  trunc((epoch_us((SELECT max(ts) FROM metrics)) - epoch_us(max(ts))) / 1000000)
    > 60 * CASE spider WHEN 'spider_1' THEN 2 ELSE 5 END AS down FROM metrics WHERE metric = 'responses_total' GROUP BY 1""", B.METRICS))
def mon_down(spark, sf_dir):
    metrics = D.metrics(spark, sf_dir)
    beats = metrics.filter(M.is_metric("responses_total"))
    return M.down(beats, metrics.agg(F.max("ts")).scalar(), {"spider_1": 2.0})


@query("mon_dashboard", f"""WITH {B.METRICS},
 b AS (SELECT date_trunc('minute', min(ts)) AS lo, date_trunc('minute', max(ts)) AS hi FROM metrics),
 spine AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS t FROM b),
 c AS (SELECT date_trunc('minute', ts) AS t, count(*) FILTER (WHERE metric = 'items_scraped_total') AS i,
   count(*) FILTER (WHERE {_ERRORS}) AS e, count(*) FILTER (WHERE metric = 'spider_started_total')
   - count(*) FILTER (WHERE metric = 'spider_closed_total') AS d FROM metrics GROUP BY ALL)
SELECT t, CAST(coalesce(sum(i) OVER (ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MINUTE PRECEDING), 0) AS BIGINT) AS total_items,
  CAST(coalesce(sum(e) OVER (ORDER BY t RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND INTERVAL 1 MINUTE PRECEDING), 0) AS DOUBLE) / 300 AS errors_per_s,
  CAST(coalesce(sum(d) OVER (ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MINUTE PRECEDING), 0) AS BIGINT) AS active
FROM spine LEFT JOIN c USING (t)""")
def mon_dashboard(spark, sf_dir):
    steps = _rollup(spark, sf_dir)
    return M.dashboard(steps, *M.bounds(steps))
