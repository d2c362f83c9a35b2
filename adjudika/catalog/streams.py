"""Streaming jobs over the given tables, run until all input is read; retention and backfill."""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudika.catalog import bindings_sql as B
from adjudika.catalog.monitoring import _ERRORS, _ITEMS, _LIMITED, _PAGES, _alert_sql
from adjudika.catalog.quality import RAW, incoming_from
from adjudika.catalog.registry import query
from adjudika.plans import retention as T
from adjudika.plans.backfill import Backfill
from adjudika.plans.ingest import Ingest
from adjudika.session import work_dir
from adjudika.sinks.archive import pages_at
from adjudika.sinks.store import TenderStore
from adjudika.sources import driver_tables as D
from adjudika.sources import new_arrivals
from adjudika.streaming import alerts as A
from adjudika.streaming import jobs as J

_GOOD = """good AS (SELECT * FROM raw WHERE titre <> '' AND organisme_acronyme IS NOT NULL AND type_marche <> 'autre'
  AND coalesce(montant_estime, 0) < 1e13 AND coalesce(length(url_detail), 0) <= 500)"""
_STORED = ["ref_consultation", "titre", "organisme_acronyme", "type_marche", "statut", "date_publication", "montant_estime"]


def _arrivals(spark, sf_dir, name):
    # A pattern that matches this one name: the file stream takes no plain path to a single file.
    return new_arrivals(spark, f"{sf_dir}/{name}.parque[t]", D.schema_of(name), "parquet")


def _ingested(spark, sf_dir, mode):
    home = work_dir(spark, "stream")
    ingest = Ingest(TenderStore(spark, f"{home}/store"), mode=mode)
    job = J.ingest_arrivals(
        _arrivals(spark, sf_dir, "orders"), ingest, f"{home}/checkpoint",
        prepare=lambda orders: incoming_from(D.consultations(orders.sparkSession, sf_dir, orders)))
    job.awaitTermination()
    return ingest.store


_STORED_SQL = B.with_tables("""
SELECT ref_consultation, trim(titre) AS titre, organisme_acronyme, type_marche, statut, date_publication, montant_estime
FROM good""", B.CONSULTATIONS, RAW, _GOOD)


@query("str_ingest", _STORED_SQL)
def str_ingest(spark, sf_dir):
    stored = _ingested(spark, sf_dir, "insert_only").read()
    return stored.select(*_STORED).withColumn("montant_estime", F.col("montant_estime").cast("double"))


@query("str_ingest_upsert", _STORED_SQL)
def str_ingest_upsert(spark, sf_dir):
    stored = _ingested(spark, sf_dir, "upsert").read()
    return stored.select(*_STORED).withColumn("montant_estime", F.col("montant_estime").cast("double"))


@query("str_pages", """
SELECT 'P-' || page_id AS ref_consultation, 'lot ' || page_id % 3 AS titre, md5(html) AS contenu, 3 AS runs FROM pages""")
def str_pages(spark, sf_dir):
    """Three arrivals with their pages, each of which repeats those before under another title: the first one of a reference stays."""
    home = work_dir(spark, "stream-pages")
    ingest = Ingest(TenderStore(spark, f"{home}/store"))
    pages, lot = D.pages(spark, sf_dir), F.col("page_id") % 3
    for k in range(3):
        rows = pages.filter(lot <= k).select(F.concat(F.lit("P-"), F.col("page_id").cast("string")).alias("ref"), F.lit(f"lot {k}").alias("titre"), "html")
        rows.write.mode("append").parquet(f"{home}/in")
        arrived = new_arrivals(spark, f"{home}/in", rows.schema, "parquet")
        fixed = {"organisme_acronyme": "O", "type_marche": "travaux", "statut": "en_cours"}
        J.ingest_arrivals(arrived, ingest, f"{home}/checkpoint", lambda df: df.select(
            F.col("ref").alias("ref_consultation"), "titre", F.col("html").alias("page_html"), *(F.lit(v).alias(n) for n, v in fixed.items()),
            *(F.lit("2025-01-01").cast("timestamp_ntz").alias(n) for n in ("date_publication", "date_extraction")))).awaitTermination()
    read = pages_at(ingest.store.read().select("ref_consultation", "titre", "page_html_archivee"), ingest.store.archive())
    runs = ingest.store.ledger.runs().filter("state = 'applied'").agg(F.count(F.lit(1)).cast("int").alias("runs"))
    return read.select("ref_consultation", "titre", F.md5("html").alias("contenu")).join(runs)  # one row


@query("str_windows", """
WITH w AS (SELECT event_type, unnest(generate_series(date_trunc('minute', ts) - INTERVAL 9 MINUTE, date_trunc('minute', ts),
    INTERVAL 1 MINUTE)) AS debut FROM events)
SELECT event_type, debut, debut + INTERVAL 10 MINUTE AS fin, count(*) AS n FROM w
WHERE debut + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY 1, 2""")
def str_windows(spark, sf_dir):
    home = work_dir(spark, "windows")
    counts = J.window_counts(_arrivals(spark, sf_dir, "events"), ["event_type"])
    J.append_parquet(counts, f"{home}/out", f"{home}/checkpoint").awaitTermination()
    return spark.read.schema("event_type string, debut timestamp_ntz, fin timestamp_ntz, n bigint").parquet(f"{home}/out")


def _rule_sql(name, counted, window, condition, hold):
    """Edges of one alert at the minutes that the watermark has passed."""
    return f"""SELECT spider, '{name}' AS alerte, t, CASE WHEN firing THEN 'debut' ELSE 'fin' END AS bord FROM (
{_alert_sql(counted, window, condition, hold)}
SELECT *, coalesce(lag(firing) OVER (PARTITION BY spider ORDER BY t), false) AS before FROM f)
WHERE firing <> before AND t <= (SELECT date_trunc('minute', max(ts)) - INTERVAL 10 MINUTE FROM events)"""


@query("str_alerts", "\nUNION ALL ".join((
    _rule_sql("no_items", _ITEMS, 300, "n = 0", 60), _rule_sql("error_rate", _ERRORS, 60, "n > 1.8", 15),
    _rule_sql("rate_limited", _LIMITED, 240, "n > 1", 5), _rule_sql("stuck", _PAGES, 30, "n = 0 AND active > 0", 30))))
def str_alerts(spark, sf_dir):
    """A quarter of the events arrives at a time, and the job is started anew for it. All alert edges up to the watermark."""
    home, events = work_dir(spark, "alerts"), D.read(spark, sf_dir, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    rules = [A.Rule("no_items", "items_scraped_total", 300, 60, "consultation"), A.Rule("error_rate", "spider_errors_total", 60, 15, above=1.8),
             A.Rule("rate_limited", "responses_total", 240, 5, "429", above=1), A.Rule("stuck", "pages_scraped_total", 30, 30, while_active=True)]
    for k in range(4):
        since, until = low + (high - low) * k / 4, low + (high - low) * (k + 1) / 4
        part = events.filter((F.col("ts") >= F.lit(since)) & ((F.col("ts") < F.lit(until)) | F.lit(k == 3)))
        part.write.mode("append").parquet(f"{home}/in")
        arrived = new_arrivals(spark, f"{home}/in", D.schema_of("events"), "parquet")
        edges = A.alert_edges(D.metrics_of(arrived), rules, low.replace(second=0, microsecond=0))
        J.append_parquet(edges, f"{home}/out", f"{home}/checkpoint").awaitTermination()
    found = spark.read.schema(A.EDGES).parquet(f"{home}/out")
    return found.withColumn("t", F.col("t").cast("timestamp_ntz"))


@query("str_first_arrivals", "SELECT DISTINCT user_id FROM events")
def str_first_arrivals(spark, sf_dir):
    home = work_dir(spark, "first")
    first = J.first_arrivals(_arrivals(spark, sf_dir, "events").select("user_id", "ts"), "user_id", "ts", "60 days")
    J.append_parquet(first, f"{home}/out", f"{home}/checkpoint").awaitTermination()
    return spark.read.schema("user_id bigint, ts timestamp").parquet(f"{home}/out").select("user_id")


@query("ret_logs", B.with_tables("""
SELECT date_execution, spider_name, statut, items_extraits FROM runs
WHERE date_execution >= TIMESTAMP '2024-07-10 12:00:00' - INTERVAL 6 MONTH""", B.RUNS))
def ret_logs(spark, sf_dir):
    now = F.lit("2024-07-10 12:00:00").cast("timestamp_ntz")
    return T.recent(D.extraction_logs(spark, sf_dir), "date_execution", now, 6).select(
        "date_execution", "spider_name", "statut", "items_extraits")


@query("ret_archive_expired", B.with_tables("""
SELECT CAST(CAST(date_execution AS DATE) AS TIMESTAMP) AS jour, count(*) AS n FROM runs
WHERE date_execution < TIMESTAMP '2024-02-15 00:00:00' - INTERVAL 1 MONTH GROUP BY 1""", B.RUNS))
def ret_archive_expired(spark, sf_dir):
    now = F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    old = T.expired(D.extraction_logs(spark, sf_dir), "date_execution", now, 1)
    return old.groupBy(F.date_trunc("day", "date_execution").alias("jour")).agg(F.count(F.lit(1)).alias("n"))


@query("bck_calendar", """
SELECT CAST(jour AS TIMESTAMP) AS jour, coalesce(n, 0) AS n, n IS NULL AS manquant
FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)), date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
  INTERVAL 1 DAY)) AS jour FROM orders)
LEFT JOIN (SELECT date_trunc('day', o_orderdate) AS d, count(*) AS n FROM orders GROUP BY 1) ON CAST(d AS DATE) = CAST(jour AS DATE)""")
def bck_calendar(spark, sf_dir):
    """All years of the orders, which end within the last one."""
    orders = D.read(spark, sf_dir, "orders")
    years = orders.agg(F.year(F.min("o_orderdate")).alias("first"), F.year(F.max("o_orderdate")).alias("last")).first()
    return T.backfill_state(orders, "o_orderdate", years.first, years.last).withColumn("jour", F.col("jour").cast("timestamp_ntz"))


@query("bck_resume", B.with_tables("""
SELECT ref_consultation, date_publication, CAST(2001 * 10000 + month(debut) * 100 + day(debut) AS BIGINT) AS lot, jours_faits, lignes
FROM (SELECT *, DATE '2001-01-01' + CAST(((dayofyear(date_publication) - 1) // 92) * 92 AS INTEGER) AS debut
  FROM consultations WHERE year(date_publication) = 2001 AND type_marche <> 'autre'),
  (SELECT CAST(365 AS BIGINT) AS jours_faits, count(*) AS lignes FROM consultations WHERE year(date_publication) = 2001)""", B.CONSULTATIONS_CORE))
def bck_resume(spark, sf_dir):
    """A year in groups of 92 days that breaks off twice: after a group, and within one between its rows and its run log."""
    def interrupt(step):
        if step == "store" and ("consultation", 20010403) in [run[:2] for run in ingest.store.ledger.look("", 0).broken]:
            ingest.on_step = None
            raise InterruptedError(step)

    tenders = D.consultations_core(spark, sf_dir).withColumns({"titre": F.lit("t"), "organisme_acronyme": F.lit("O")})
    ingest = Ingest(TenderStore(spark, f"{work_dir(spark, 'backfill')}/store"), on_step=interrupt)
    job = Backfill(ingest, tenders, days_per_run=92)
    job.run(2001, groups=1)
    try:
        job.run(2001)
        raise RuntimeError("the run was to break off")
    except InterruptedError:
        job.run(2001)
    done = job.state(2001).filter("done").agg(F.count(F.lit(1)).alias("jours_faits"), F.sum("n").alias("lignes"))
    return ingest.store.read().select("ref_consultation", "date_publication", F.col("lot_id").alias("lot")).join(done)  # one row


@query("ret_archive_drop", """
SELECT p || page_id AS ref_consultation, NOT ancien AS lisible, CASE WHEN NOT ancien THEN md5(html) END AS contenu, jours, perdus
FROM (SELECT *, html IN (SELECT html FROM pages WHERE page_id % 2 = 0) AS ancien FROM pages) x
JOIN (VALUES ('P-', 0), ('Q-', 1)) v(p, lot) ON lot = 1 OR page_id % 2 = 0,
(SELECT 1 AS jours, count(*) FILTER (html IN (SELECT html FROM pages WHERE page_id % 2 = 0))
   + (SELECT count(*) FROM pages WHERE page_id % 2 = 0) AS perdus FROM pages)""")
def ret_archive_drop(spark, sf_dir):
    """Half of the pages archived in January, all in June; in July the folders of more than three months ago go."""
    job = Ingest(TenderStore(spark, f"{work_dir(spark, 'rotation')}/store"))
    pages = D.pages(spark, sf_dir)
    for lot, (prefix, chosen, day) in enumerate((("P-", "page_id % 2 = 0", "2025-01-10"), ("Q-", "true", "2025-06-10"))):
        rows = pages.filter(chosen).select(
            F.concat(F.lit(prefix), F.col("page_id").cast("string")).alias("ref_consultation"), F.lit("t").alias("titre"),
            F.lit("O").alias("organisme_acronyme"), F.lit("travaux").alias("type_marche"), F.lit("en_cours").alias("statut"),
            *(F.lit("2025-01-01").cast("timestamp_ntz").alias(c) for c in ("date_publication", "date_extraction")), F.col("html").alias("page_html"))
        job.run(rows, lot, F.lit(f"{day} 00:00:00").cast("timestamp_ntz"))
    gone = job.store.drop_archive(F.lit("2025-07-01 00:00:00").cast("timestamp_ntz"), 3)
    lost = job.store.dangling().agg(F.count(F.lit(1)).alias("perdus"))
    read = pages_at(job.store.read().select("ref_consultation", "page_html_archivee"), job.store.archive())
    return read.select("ref_consultation", F.col("html").isNotNull().alias("lisible"), F.md5("html").alias("contenu"),
                       F.lit(len(gone)).alias("jours")).join(lost)  # one row


@query("bck_full_history", B.with_tables("""
SELECT count(*) AS n, count(DISTINCT statut) AS statuts FROM consultations""", B.CONSULTATIONS_CORE))
def bck_full_history(spark, sf_dir):
    from adjudika.plans.listings import filter_tenders

    every = filter_tenders(D.consultations_core(spark, sf_dir), statut=None)
    return every.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("statut").alias("statuts"))
