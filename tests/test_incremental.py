"""Two-level running totals, pages by cursor, report figures kept by the runs, rows and empty pages from one pass."""

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from adjudika.extraction import rows as X
from adjudika.operators.filters import page_after, pages_of
from adjudika.operators.running import running_total, span, timeline
from adjudika.plans import reports, summaries
from adjudika.plans.ingest import Ingest
from adjudika.session import work_dir
from adjudika.sinks.store import TenderStore
from adjudika.streaming.jobs import lot_of


def test_running_totals_on_two_levels_equal_one_window(spark):
    rng = np.random.default_rng(1)
    rows = [(["a", "b", None][i % 3], dt.datetime(2025, 1, 1) + dt.timedelta(minutes=int(m)), int(v), int(w))
            for i, (m, v, w) in enumerate(zip(rng.choice(20_000, 600, replace=False), rng.integers(-5, 9, 600), rng.integers(0, 2, 600)))]
    steps = spark.createDataFrame(rows, "g string, t timestamp_ntz, x bigint, y bigint")
    whole = Window.partitionBy("g").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = steps.withColumns({v: F.sum(v).over(whole) for v in ("x", "y")})
    got = running_total(steps, ["g"], "t", ["x", "y"])
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    specs = re.findall(r"windowspecdefinition\((.*?) (?:ASC|DESC)", got._jdf.queryExecution().optimizedPlan().toString())
    # A group's whole time is only ever ordered by its days.
    assert specs and all("_day#" in spec.rsplit(",", 1)[0] or "_on_day#" in spec for spec in specs)


@pytest.mark.parametrize("step", [span(minutes=1), span(minutes=7), span(hours=36)])
def test_the_time_line_has_every_step(spark, step):
    start, end = dt.datetime(2025, 1, 30, 23, 57), dt.datetime(2025, 2, 2, 0, 5)
    groups = spark.createDataFrame([("a",), ("b",), ("a",)], "g string")
    bound = [F.lit(str(x)).cast("timestamp_ntz") for x in (start, end)]
    got = sorted((r.g, r.t) for r in timeline(groups, ["g"], *bound, step).collect())
    steps = [start + step * k for k in range((end - start) // step + 1)]
    assert got == [(g, t) for g in "ab" for t in steps]


def test_pages_by_cursor_make_the_whole_order(spark):
    rng = np.random.default_rng(2)
    rows = [(None if rng.random() < 0.1 else dt.datetime(2025, 1, 1 + int(rng.integers(20))), None if i % 17 == 0 else int(rng.integers(8)), f"r{i:03}") for i in range(300)]
    df = spark.createDataFrame(rows, "d timestamp_ntz, k int, ref string").repartition(5)
    want = [tuple(r) for r in df.orderBy(F.desc("d"), "k", "ref").collect()]
    for limit in (1, 7, 100, 300, 1000):
        if limit == 1:
            pages = pages_of(df.limit(0), "d", ["k", "ref"], limit)
            assert list(pages) == []
            continue
        got = [[tuple(r) for r in p] for p in pages_of(df, "d", ["k", "ref"], limit)]
        assert [r for p in got for r in p] == want and all(len(p) == limit for p in got[:-1])
    plan = page_after(df, "d", ["k", "ref"], {"d": "2025-01-05 00:00:00", "k": 3, "ref": "r1"}, 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=10" in plan and "offset" not in plan.lower()
    with pytest.raises(ValueError):
        page_after(df, "d", ["ref"], None, 0)


def tenders(spark, *rows):
    out = [(ref, "t", organisme, "travaux", statut, dt.datetime(2025, month, 1), dt.datetime(2025, 6, day), amount) for ref, organisme, statut, month, day, amount in rows]
    return spark.createDataFrame(out, "ref_consultation string, titre string, organisme_acronyme string, type_marche string, statut string, "
                                      "date_publication timestamp_ntz, date_extraction timestamp_ntz, montant_estime string")


def awards(spark, *rows):
    out = [(ref, "O", dt.date(2025, 5, 1), who, amount, dt.datetime(2025, 6, 1)) for ref, who, amount in rows]
    return spark.createDataFrame(out, "ref_consultation string, organisme_acronyme string, date_attribution date, entreprise_nom string, montant_ttc string, date_extraction timestamp_ntz")


def test_figures_kept_by_the_runs_equal_a_count_of_all_rows(spark):
    store = TenderStore(spark, f"{work_dir(spark, 'test')}/store", summarise=True)
    job, won = Ingest(store, mode="upsert"), Ingest(store, kind="attribution", order=["date_attribution"])

    def agree():
        rows, prizes, kept = store.read(), store.read("attribution"), store.summary.read()
        pairs = [(summaries.monthly_stats(kept), reports.monthly_stats(rows)), (summaries.top_bodies(kept), reports.top_bodies(rows)),
                 (summaries.top_winners(kept), reports.top_winners(prizes)), (summaries.global_stats(kept), reports.global_stats(rows, prizes))]
        for got, want in pairs:
            assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))

    def broken(run, step):
        def stop(done):
            if done == step:
                raise InterruptedError
        run.on_step = stop

    first = tenders(spark, ("A", "O1", "en_cours", 1, 1, "10"), ("B", "O2", "en_cours", 2, 9, None), ("C", "O1", "cloture", 2, 2, "1,5"))
    job.run(first, 0)
    agree()
    second = tenders(spark, ("A", "O3", "annule", 1, 1, "7"), ("B", "O2", "annule", 2, 3, "4"), ("D", "O4", "en_cours", 3, 1, "2"))
    broken(job, "store")
    with pytest.raises(InterruptedError):
        job.run(second, 1)
    job.on_step = None
    job.run(second, 1)
    agree()
    broken(won, "store")
    with pytest.raises(InterruptedError):
        won.run(awards(spark, ("A", "E1", "5"), ("B", "E2", None), ("Z", "E9", "1")), 2)
    won.on_step = None
    won.run(awards(spark, ("A", "E1", "5"), ("B", "E2", None), ("Z", "E9", "1")), 2)
    won.run(awards(spark, ("D", "E1", "6")), 3)
    job.run(first, 0)  # an old run again
    agree()
    store.delete(spark.createDataFrame([("B",), ("C",)], "ref_consultation string"))
    agree()
    assert store.summary.read().filter("sorte = 'organisme' and k1 = 'O2'").count() == 0
    store.summary.fold()
    agree()


def test_rows_and_empty_pages_come_from_one_pass(spark):
    row = '<table class="data-table"><tr class="row"><td>{}</td><td>t</td></tr></table>'
    bodies = [row.format("R1"), "<p>none</p>", row.format("   "), None, "", row.format("R2") + "<!-- x -->"]
    pages = spark.createDataFrame([(i, f"http://h/{i}", b, "more") for i, b in enumerate(bodies)], "page_id bigint, url string, html string, extra string")
    stamp = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    rows, empty = X.tenders_and_empty_pages(pages, stamp, f"{work_dir(spark, 'test')}/out")
    assert sorted(r.ref_consultation for r in rows.collect()) == ["R1", "R2"]
    assert sorted(map(repr, rows.drop("_no").collect())) == sorted(map(repr, X.tender_rows(pages, stamp).drop("_no").collect()))
    assert {(r.page_id, r.html) for r in empty.collect()} == {(1, bodies[1]), (2, bodies[2]), (3, None), (4, "")}


def test_runs_of_a_stream_have_numbers_of_their_own():
    numbers = {lot_of(c, b) for c in ("/a", "/b/", "hdfs://x/c") for b in range(3)}
    assert len(numbers) == 9 and min(numbers) > 1 << 32 and max(numbers) < 1 << 63 and lot_of("/a/", 1) == lot_of("/a", 1)


def test_rows_of_all_pages_are_those_of_the_reader(spark):
    df = spark.range(500).selectExpr("cast('2025-01-01' as timestamp_ntz) + make_dt_interval(cast(id % 7 as int)) AS d", "id * 7 % 500 AS k").repartition(5)
    pages = pages_of(df, "d", ["k"], 60)
    want = [(*r, 60 * p + i, p) for p, page in enumerate(pages) for i, r in enumerate(page)]
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("rows", "rows")
    got = sorted((tuple(r) for r in pages.rows().collect()), key=lambda r: r[2])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == want
    count = len(jobs.getJobIdsForGroup("rows"))
    spark.sparkContext.setJobGroup("more", "more")
    more = pages_of(df, "d", ["k"], 5).rows().collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(more) == 500 and len(jobs.getJobIdsForGroup("more")) == count  # one hundred pages take no more jobs than nine
