"""Alerts as a stream: edges against a plain minute-by-minute evaluation, over batches, a restart, silence and late events."""

import datetime as dt

import numpy as np

from adjudika.session import work_dir
from adjudika.sources import new_arrivals
from adjudika.streaming import alerts as A
from adjudika.streaming import jobs

START = dt.datetime(2025, 1, 1)
RULES = [A.Rule("no_items", "items_scraped_total", 20, 5, "consultation"), A.Rule("error_rate", "spider_errors_total", 10, 3, above=2),
         A.Rule("stuck", "pages_scraped_total", 6, 4, while_active=True)]
SCHEMA = "ts timestamp_ntz, spider string, metric string, label string, value double"


def plain(events, until):
    """Every minute of every crawler, from all its events."""
    edges = set()
    for spider in {e[1] for e in events}:
        own = [((e[0] - START) // dt.timedelta(minutes=1), *e[2:]) for e in events if e[1] == spider]
        for rule in RULES:
            held, fires = 0, False
            for t in range(until + 1):
                n = sum(v for at, m, label, v in own if t - rule.window <= at < t and m == rule.metric and (rule.label is None or label == rule.label))
                active = sum((m == "spider_started_total") * v - (m == "spider_closed_total") * v for at, m, _, v in own if at < t)
                true = (n == 0 if rule.above is None else n > rule.above) and (not rule.while_active or active > 0)
                held = held + 1 if true else 0
                if (held > rule.hold) != fires:
                    fires = not fires
                    edges.add((spider, rule.name, START + dt.timedelta(minutes=t), "debut" if fires else "fin"))
    return edges


def events_of(seed, low, high, per_minute=0.6):
    rng = np.random.default_rng(seed)
    kinds = [("items_scraped_total", "consultation"), ("items_scraped_total", "lot"), ("spider_errors_total", None), ("pages_scraped_total", None),
             ("spider_started_total", None), ("spider_closed_total", "finished")]
    out = []
    for _ in range(int((high - low) * per_minute)):
        metric, label = kinds[rng.choice(6, p=[0.1, 0.1, 0.4, 0.3, 0.06, 0.04])]
        out.append((START + dt.timedelta(seconds=int(rng.integers(low * 60, high * 60))), f"s{rng.integers(3)}", metric, label, 1.0))
    return out


def test_edges_over_batches_a_restart_and_silence(spark):
    home = work_dir(spark, "test")
    # The third part is quiet for two crawlers but for one event at its end, which moves the watermark on.
    parts = [events_of(1, 0, 120), events_of(2, 120, 240), [*events_of(3, 240, 300), (START + dt.timedelta(minutes=420), "s0", "spider_errors_total", None, 1.0)]]
    for k, rows in enumerate(parts):
        frame = spark.createDataFrame(rows, SCHEMA)
        frame.repartition(2).write.mode("append").parquet(f"{home}/in")
        source = new_arrivals(spark, f"{home}/in", frame.schema, "parquet")
        jobs.append_parquet(A.alert_edges(source, RULES, START), f"{home}/out", f"{home}/checkpoint").awaitTermination()
        got = [tuple(r) for r in spark.read.schema(A.EDGES).parquet(f"{home}/out").collect()]
        every = [e for p in parts[:k + 1] for e in p]
        until = (max(e[0] for e in every) - START) // dt.timedelta(minutes=1) - 10
        assert len(got) == len(set(got)) and set(got) == plain(every, until)
    assert {e[1] for e in got} == {r.name for r in RULES}


def test_a_watch_in_slices_equals_one_in_one_go():
    rng = np.random.default_rng(5)
    minutes, counts = np.sort(rng.choice(5_000, 600, replace=False)), rng.integers(0, 3, (600, 4))
    whole = A._Watch(RULES, 10, None)
    whole.add(minutes, counts)
    want = whole.advance(5_200)
    state, got = None, []
    for low, high in ((0, 700), (700, 710), (710, 4_000), (4_000, 5_200)):
        watch = A._Watch(RULES, 10, state)
        here = (minutes >= low) & (minutes < high)
        watch.add(minutes[here], counts[here])
        got += watch.advance(high)
        state = watch.state()
        assert len(state[1]) <= 40  # only what the longest window needs
    assert sorted(got) == sorted(want) and want
