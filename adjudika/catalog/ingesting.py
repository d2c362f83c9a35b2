"""Ingest runs over several batches: duplicates and ties, repeated runs, updates, children, archived pages, deletes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from adjudika.catalog import bindings_sql as B
from adjudika.catalog.registry import query
from adjudika.plans import summaries
from adjudika.plans.ingest import RUN_LOG, Ingest
from adjudika.session import work_dir
from adjudika.sinks.store import TenderStore
from adjudika.sources import driver_tables as D

_FIXED = {"organisme_acronyme": "ONEE", "type_marche": "travaux", "statut": "en_cours"}


def _tenders(rows, *, ref, titre, published, seen):
    fixed = [F.lit(v).alias(k) for k, v in _FIXED.items()]
    return rows.select(ref.alias("ref_consultation"), titre.alias("titre"), *fixed, published.cast("timestamp_ntz").alias("date_publication"),
                       seen.cast("timestamp_ntz").alias("date_extraction"), *[c for c in rows.columns if c in ("lot", "page_html")])


def _store(spark):
    return TenderStore(spark, f"{work_dir(spark, 'ingest')}/store")


def _arrivals(spark, sf_dir):
    """One record per line item: many per order, of which some tie, some have no time and some come twice."""
    items = D.read(spark, sf_dir, "lineitem").withColumn("lot", F.col("l_linenumber") % 2)
    titre = F.when(F.col("l_linenumber") == 7, "").otherwise(F.concat(F.lit("T "), F.col("l_quantity").cast("int").cast("string")))
    seen = F.when(F.col("l_linenumber") != 3, F.date_trunc("month", F.col("l_shipdate").cast("timestamp_ntz")))
    rows = _tenders(items, ref=D.ref_of(F.col("l_orderkey")), titre=titre, published=F.col("l_shipdate"), seen=seen)
    # Not NULL once stored: the arrival order is a column of its own.
    rows = rows.withColumn("arrivee", F.col("date_extraction")).withColumn("date_extraction", F.lit("2025-01-01").cast("timestamp_ntz"))
    return rows.unionAll(rows.filter("titre = 'T 10'"))


_ARRIVALS = """items AS (SELECT 'AO-' || l_orderkey AS ref, l_linenumber % 2 AS lot, l_linenumber = 7 AS vide FROM lineitem
  UNION ALL SELECT 'AO-' || l_orderkey, l_linenumber % 2, false FROM lineitem WHERE l_linenumber <> 7 AND CAST(l_quantity AS INT) = 10),
firsts AS (SELECT ref, min(lot) AS lot FROM items WHERE NOT vide GROUP BY ref),
counted AS (SELECT i.lot, CASE WHEN vide THEN 'missing_required_field' ELSE 'good' END AS issue, count(*) AS n FROM items i GROUP BY 1, 2),
saved AS (SELECT lot, count(*) AS n FROM firsts GROUP BY lot),
outcome AS (SELECT lot, issue, n FROM counted WHERE issue <> 'good'
  UNION ALL SELECT lot, 'saved', n FROM saved
  UNION ALL SELECT c.lot, 'duplicate', c.n - coalesce(s.n, 0) FROM counted c LEFT JOIN saved s USING (lot) WHERE issue = 'good')"""


@query("ing_batches", f"""
WITH {_ARRIVALS}
SELECT CAST(p AS INT) AS passe, CAST(lot AS INT) AS lot, issue, CAST(n AS BIGINT) AS n FROM outcome, range(1, 3) r(p) WHERE n > 0
UNION ALL SELECT CAST(p AS INT), -1, 'stored', (SELECT count(*) FROM firsts) FROM range(1, 3) r(p)
UNION ALL SELECT CAST(p AS INT), -1, 'quarantined', (SELECT CAST(sum(n) AS BIGINT) FROM outcome WHERE issue <> 'saved') FROM range(1, 3) r(p)""")
def ing_batches(spark, sf_dir):
    """Two batches, run one after the other and then both again: each pass has the same outcomes, which add up to the input."""
    job = Ingest(_store(spark), order=["arrivee"])
    rows, parts = _arrivals(spark, sf_dir), []
    for passe in (1, 2):
        for lot in (0, 1):
            counts = job.run(rows.filter(F.col("lot") == lot).drop("lot"), lot)
            parts.append(counts.select(F.lit(passe).alias("passe"), F.lit(lot).alias("lot"), "issue", "n"))
        for name, table in (("stored", job.store.read()), ("quarantined", spark.read.parquet(job.store.path("quarantine")))):
            held = table.agg(F.count(F.lit(1)).alias("n"))
            parts.append(spark.createDataFrame([(passe, -1, name, held.first().n)], "passe int, lot int, issue string, n bigint"))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("ing_first_arrival", f"""
WITH {_ARRIVALS.split(',' + chr(10) + 'counted')[0]}
SELECT ref AS ref_consultation, lot, min(strftime(date_trunc('month', l_shipdate), '%Y-%m')) FILTER (l_linenumber <> 3) AS mois
FROM firsts JOIN lineitem ON ref = 'AO-' || l_orderkey AND l_linenumber % 2 = lot AND l_linenumber <> 7 GROUP BY ref, lot""")
def ing_first_arrival(spark, sf_dir):
    """The stored record is the earliest one of the batch that brought the reference first; a record without a time comes last."""
    job = Ingest(_store(spark), order=["arrivee"], extra_stages=[(260, "note", lambda df: df.withColumn("objet", F.date_format("arrivee", "yyyy-MM")))])
    rows = _arrivals(spark, sf_dir)
    for lot in (0, 1):
        job.run(rows.filter(F.col("lot") == lot).drop("lot"), lot)
    return job.store.read().select("ref_consultation", F.col("lot_id").cast("int").alias("lot"), F.col("objet").alias("mois"))


@query("ing_upsert", """
SELECT 'AO-' || o_orderkey AS ref_consultation, CASE WHEN o_custkey % 3 = 0 THEN 'v2' ELSE o_orderpriority END AS titre,
  o_custkey % 3 = 0 AS modifie, CASE WHEN o_custkey % 3 = 0 THEN TIMESTAMP '2025-02-02 00:00:00' END AS date_derniere_maj FROM orders""")
def ing_upsert(spark, sf_dir):
    """All orders, then new values for a third of them, then that batch once more."""
    job = Ingest(_store(spark), order=["date_extraction"], mode="upsert")
    orders = D.read(spark, sf_dir, "orders")

    def batch(rows, titre):
        return _tenders(rows, ref=D.ref_of(F.col("o_orderkey")), titre=titre, published=F.col("o_orderdate"), seen=F.lit("2025-01-01"))

    day = lambda d: F.lit(f"2025-02-{d:02} 00:00:00").cast("timestamp_ntz")
    job.run(batch(orders, F.col("o_orderpriority")), 0, day(1))
    for again in (2, 3):
        job.run(batch(orders.filter("o_custkey % 3 = 0"), F.lit("v2")), 1, day(again))
    return job.store.read().select("ref_consultation", "titre", F.col("date_derniere_maj").isNotNull().alias("modifie"), "date_derniere_maj")


def _versions(spark, sf_dir):
    """All orders; new values for a third of them; a tenth of them."""
    orders = D.read(spark, sf_dir, "orders")
    return [_tenders(rows, ref=D.ref_of(F.col("o_orderkey")), titre=titre, published=F.col("o_orderdate"), seen=F.lit("2025-01-01"))
            for rows, titre in ((orders, F.col("o_orderpriority")), (orders.filter("o_custkey % 3 = 0"), F.lit("v2")),
                                (orders.filter("o_custkey % 10 = 0"), F.lit("v3")))]


def _day(d):
    return F.lit(f"2025-02-{d:02} 00:00:00").cast("timestamp_ntz")


def _upserted(store, counted=()):
    rows = store.read().select("ref_consultation", "titre", F.col("lot_id").cast("int").alias("lot"), "date_derniere_maj")
    for name, counters in counted:
        rows = rows.withColumn(name, F.lit(sum(r.n for r in counters.collect() if r.issue == "saved")).cast("bigint"))
    return rows


@query("ing_replay", """
SELECT 'AO-' || o_orderkey AS ref_consultation, CASE WHEN o_custkey % 3 = 0 THEN 'v2' ELSE o_orderpriority END AS titre,
  CAST(o_custkey % 3 = 0 AS INT) AS lot, CASE WHEN o_custkey % 3 = 0 THEN TIMESTAMP '2025-02-02 00:00:00' END AS date_derniere_maj,
  (SELECT count(*) FROM orders) AS saved_0, (SELECT count(*) FROM orders) AS saved_again FROM orders""")
def ing_replay(spark, sf_dir):
    """Run 0, run 1, and run 0 once more: the old batch changes nothing and reports what it did the first time."""
    job, versions = Ingest(_store(spark), order=["date_extraction"], mode="upsert"), _versions(spark, sf_dir)
    counts = [job.run(versions[lot], lot, _day(k)) for k, lot in enumerate((0, 1, 0), 1)]
    return _upserted(job.store, [("saved_0", counts[0]), ("saved_again", counts[2])])


@query("ing_broken", """
SELECT 'AO-' || o_orderkey AS ref_consultation, CASE WHEN o_custkey % 10 = 0 THEN 'v3' WHEN o_custkey % 3 = 0 THEN 'v2' ELSE o_orderpriority END AS titre,
  CASE WHEN o_custkey % 10 = 0 THEN 2 ELSE CAST(o_custkey % 3 = 0 AS INT) END AS lot,
  CASE WHEN o_custkey % 10 = 0 THEN TIMESTAMP '2025-02-04 00:00:00' END AS date_derniere_maj,
  (SELECT count(*) FROM orders WHERE o_custkey % 10 = 0) AS updated FROM orders""")
def ing_broken(spark, sf_dir):
    """Run 0 breaks off before the store, run 1 overtakes it, run 0 is repeated; run 2 breaks off after the store and is repeated."""
    def stop_after(step):
        def on_step(done):
            if done == step:
                job.on_step = None
                raise InterruptedError(done)
        return on_step

    job, versions = Ingest(_store(spark), order=["date_extraction"], mode="upsert"), _versions(spark, sf_dir)
    for lot, day, step in ((0, 1, "quarantine"), (1, 2, None), (0, 3, None), (2, 4, "store"), (2, 5, None)):
        job.on_step = stop_after(step) if step else None
        try:
            job.run(versions[lot], lot, _day(day))
        except InterruptedError:
            pass
    log = spark.read.schema(f"{RUN_LOG}, kind string, lot_id bigint").parquet(job.store.path("extraction_log"))
    return _upserted(job.store).join(log.filter("lot_id = 2").select(F.col("items_mis_a_jour").alias("updated")))  # one row


@query("ing_run_log", """
WITH o AS (SELECT count(*) AS a, count(*) FILTER (o_custkey % 3 = 0) AS b, count(*) FILTER (o_custkey % 10 = 0) AS c FROM orders)
SELECT 0 AS lot, 'success' AS statut, a AS extraits, a AS inseres, 0::BIGINT AS mis_a_jour, 0::BIGINT AS erreurs, TIMESTAMP '2025-02-01' AS debut FROM o
UNION ALL SELECT 1, 'success', b, 0, b, 0, TIMESTAMP '2025-02-02' FROM o
UNION ALL SELECT 2, 'partial', 2 * c, 0, c, c, TIMESTAMP '2025-02-03' FROM o""")
def ing_run_log(spark, sf_dir):
    """The run log that the ingest writes: one row a run, counted while the rows were written."""
    job, versions = Ingest(_store(spark), order=["date_extraction"], mode="upsert"), _versions(spark, sf_dir)
    versions[2] = versions[2].unionAll(versions[2].withColumn("titre", F.lit("")))  # every second record lacks its title
    for lot, batch in enumerate(versions):
        job.run(batch, lot, _day(lot + 1))
    log = spark.read.schema(f"{RUN_LOG}, kind string, lot_id int").parquet(job.store.path("extraction_log"))
    return log.select(F.col("lot_id").alias("lot"), "statut", F.col("items_extraits").alias("extraits"), F.col("items_inseres").alias("inseres"),
                      F.col("items_mis_a_jour").alias("mis_a_jour"), "erreurs", F.col("date_execution").alias("debut"))


def _with_children(spark, sf_dir):
    store = _store(spark)
    orders = D.read(spark, sf_dir, "orders").filter("o_custkey % 3 <> 0")
    Ingest(store).run(_tenders(orders, ref=D.ref_of(F.col("o_orderkey")), titre=F.col("o_orderpriority"), published=F.col("o_orderdate"),
                               seen=F.lit("2025-01-01")), 0)
    items = D.read(spark, sf_dir, "lineitem")
    lots = items.select(D.ref_of(F.col("l_orderkey")).alias("ref_consultation"), (F.col("l_linenumber") % 4).cast("string").alias("numero_lot"),
                        F.col("l_linenumber").cast("string").alias("designation"), F.lit("2025-01-01").cast("timestamp_ntz").alias("date_extraction"), "l_linenumber")
    job = Ingest(store, kind="lot", order=["l_linenumber"], child_key=["numero_lot"])
    counts = [job.run(lots.filter(F.col("l_linenumber") <= 4), 1), job.run(lots.filter(F.col("l_linenumber") > 3), 2)]
    return store, counts


_CHILDREN = """known AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 3 <> 0),
lots AS (SELECT l_orderkey, l_linenumber, l_linenumber % 4 AS numero, 1 AS lot FROM lineitem WHERE l_linenumber <= 4
  UNION ALL SELECT l_orderkey, l_linenumber, l_linenumber % 4, 2 FROM lineitem WHERE l_linenumber > 3),
kept AS (SELECT * FROM lots JOIN known ON l_orderkey = o_orderkey QUALIFY row_number() OVER (PARTITION BY l_orderkey, numero ORDER BY lot, l_linenumber) = 1)"""


@query("ing_children", f"""
WITH {_CHILDREN},
g AS (SELECT lot, l_orderkey, numero, o_orderkey IS NOT NULL AS connu, count(*) AS n,
  min(lot) OVER (PARTITION BY l_orderkey, numero) = lot AS premier
  FROM lots LEFT JOIN known ON l_orderkey = o_orderkey GROUP BY lot, l_orderkey, numero, o_orderkey),
outcome AS (
  SELECT lot, 'saved' AS issue, count(*) AS n FROM g WHERE connu AND premier GROUP BY lot
  UNION ALL SELECT lot, 'database_error', count(*) FROM g WHERE NOT connu GROUP BY lot
  UNION ALL SELECT lot, 'duplicate', sum(CASE WHEN connu AND NOT premier THEN n ELSE n - 1 END) FROM g GROUP BY lot)
SELECT CAST(lot AS INT) AS lot, issue, CAST(n AS BIGINT) AS n FROM outcome WHERE n > 0""")
def ing_children(spark, sf_dir):
    """Lots in two batches with a key of their own; those of tenders that are not stored are refused."""
    _, counts = _with_children(spark, sf_dir)
    return reduce(lambda a, b: a.unionByName(b), [c.select(F.lit(lot).alias("lot"), "issue", "n") for lot, c in enumerate(counts, 1)])


@query("ing_delete", f"""
WITH {_CHILDREN}
SELECT 'AO-' || o_orderkey AS ref_consultation, (SELECT count(*) FROM kept WHERE l_orderkey = k.o_orderkey) AS lots FROM known k WHERE o_custkey % 2 = 0""")
def ing_delete(spark, sf_dir):
    """Tenders are deleted with their lots; the others keep theirs."""
    store, _ = _with_children(spark, sf_dir)
    gone = D.read(spark, sf_dir, "orders").filter("o_custkey % 2 <> 0").select(D.ref_of(F.col("o_orderkey")).alias("ref_consultation"))
    store.delete(gone)
    lots = store.read("lot").groupBy("ref_consultation").agg(F.count(F.lit(1)).alias("lots"))
    return store.read().select("ref_consultation").join(lots, "ref_consultation", "full_outer").select("ref_consultation", F.coalesce("lots", F.lit(0)).alias("lots"))


@query("ing_archive", """
SELECT p || page_id AS ref_consultation, md5(html) AS content_md5, true AS archive FROM pages, (VALUES ('P-'), ('Q-')) v(p)""")
def ing_archive(spark, sf_dir):
    """Each page under two references and on two days: every record names a file that is in the archive and holds its content."""
    job = Ingest(_store(spark))
    pages = D.pages(spark, sf_dir)
    for lot, prefix in enumerate(("P-", "Q-")):
        rows = pages.withColumn("page_html", F.col("html"))
        batch = _tenders(rows, ref=F.concat(F.lit(prefix), F.col("page_id").cast("string")), titre=F.lit("t"), published=F.lit("2025-01-01"), seen=F.lit("2025-01-01"))
        job.run(batch, lot, F.lit(f"2025-01-0{lot + 1} 00:00:00").cast("timestamp_ntz"))
    files = job.store.archive().select(F.concat(F.lit(f"{job.store.path('archive')}/"), "file_name").alias("page_html_archivee"), "content_md5",
                                       F.lit(True).alias("archive"))
    return job.store.read().join(files, "page_html_archivee", "left").select("ref_consultation", "content_md5", F.coalesce("archive", F.lit(False)).alias("archive"))


def _summarised(spark, sf_dir):
    """All tenders inserted, a third updated in status and amount, awards added in two runs, every seventh tender deleted with its awards."""
    store = TenderStore(spark, f"{work_dir(spark, 'summary')}/store", summarise=True)
    tenders = D.consultations(spark, sf_dir).filter("type_marche <> 'autre'")
    key = F.substring("ref_consultation", 4, 20).cast("bigint")
    job = Ingest(store, mode="upsert")
    job.run(tenders, 0, _day(1))
    changed = tenders.filter(key % 3 == 0).withColumns({
        "statut": F.lit("infructueux"), "montant_estime": F.col("montant_estime") * 2, "date_extraction": F.col("date_extraction") + F.expr("INTERVAL 1 DAY")})
    job.run(changed, 1, _day(2))
    awards = Ingest(store, kind="attribution", order=["date_attribution"])
    rows = D.attributions(spark, sf_dir)
    for run, half in ((2, "numero_lot % 2 = 0"), (3, "numero_lot % 2 <> 0")):
        awards.run(rows.filter(half), run, _day(run + 1))
    store.delete(tenders.filter(key % 7 == 0))
    return store.summary.read()


_KEPT = B.with_tables("{}", B.CONSULTATIONS, B.ATTRIBUTIONS, """kept AS (
  SELECT organisme_acronyme, organisme_nom_complet, type_marche, date_publication, k % 3 = 0 AS m, CASE WHEN k % 3 = 0 THEN 'infructueux' ELSE statut END AS statut,
    CASE WHEN k % 3 = 0 THEN montant_estime * 2 ELSE montant_estime END AS montant_estime,
    CASE WHEN k % 3 = 0 THEN date_extraction + INTERVAL 1 DAY ELSE date_extraction END AS date_extraction, ref_consultation
  FROM (SELECT *, CAST(substr(ref_consultation, 4) AS BIGINT) AS k FROM consultations WHERE type_marche <> 'autre') WHERE k % 7 <> 0)""",
  "won AS (SELECT a.* FROM attributions a WHERE ref_consultation IN (SELECT ref_consultation FROM kept))")


@query("agg_kept_monthly", _KEPT.replace("{}", """
SELECT date_trunc('month', date_publication) AS mois, type_marche, statut, count(*) AS nombre_consultations,
  CAST(sum(montant_estime) AS DOUBLE) AS montant_total_estime, CAST(sum(montant_estime) AS DOUBLE) / nullif(count(montant_estime), 0) AS montant_moyen_estime
FROM kept GROUP BY ALL"""))
def agg_kept_monthly(spark, sf_dir):
    """The monthly report from what the runs added up, against a count of all rows."""
    return summaries.monthly_stats(_summarised(spark, sf_dir))


@query("agg_kept_global", _KEPT.replace("{}", """
SELECT c.*, a.* FROM
 (SELECT count(*) AS total_consultations, count(*) FILTER (WHERE statut = 'en_cours') AS consultations_en_cours,
    coalesce(CAST(sum(montant_estime) AS DOUBLE), 0) AS montant_total_estime,
    count(DISTINCT organisme_acronyme) AS nombre_organismes, max(date_extraction) AS derniere_extraction FROM kept) c,
 (SELECT count(*) AS total_attributions, coalesce(CAST(sum(montant_ttc) AS DOUBLE), 0) AS montant_total_attribue,
    count(DISTINCT entreprise_nom) AS nombre_entreprises FROM won) a"""))
def agg_kept_global(spark, sf_dir):
    """Distinct bodies and winners, totals and the latest extraction, after inserts, updates and deletes."""
    return summaries.global_stats(_summarised(spark, sf_dir))


@query("agg_kept_winners", _KEPT.replace("{}", """
SELECT entreprise_nom, entreprise_ville, count(*) AS nombre_marches, CAST(sum(montant_ttc) AS DOUBLE) AS montant_total_ttc,
  CAST(sum(montant_ttc) AS DOUBLE) / nullif(count(montant_ttc), 0) AS montant_moyen_ttc FROM won GROUP BY ALL"""))
def agg_kept_winners(spark, sf_dir):
    return summaries.top_winners(_summarised(spark, sf_dir))
