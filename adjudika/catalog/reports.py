"""Aggregate reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudika.catalog import bindings_sql as B
from adjudika.catalog.registry import query
from adjudika.plans import reports as R
from adjudika.sources import driver_tables as D
from adjudika.sources import recent_runs


@query("agg_monthly_stats", B.with_tables("""
SELECT date_trunc('month', date_publication) AS mois, type_marche, statut, count(*) AS nombre_consultations,
  CAST(sum(montant_estime) AS DOUBLE) AS montant_total_estime,
  CAST(sum(montant_estime) AS DOUBLE) / nullif(count(montant_estime), 0) AS montant_moyen_estime
FROM consultations GROUP BY ALL""", B.CONSULTATIONS_CORE))
def agg_monthly_stats(spark, sf_dir):
    return R.monthly_stats(D.consultations_core(spark, sf_dir))


@query("agg_top_bodies", B.with_tables("""
SELECT organisme_acronyme, organisme_nom_complet, count(*) AS nombre_consultations,
  CAST(sum(montant_estime) AS DOUBLE) AS montant_total_estime
FROM consultations GROUP BY ALL""", B.CONSULTATIONS))
def agg_top_bodies(spark, sf_dir):
    return R.top_bodies(D.consultations(spark, sf_dir))


@query("agg_top_winners", B.with_tables("""
SELECT entreprise_nom, entreprise_ville, count(*) AS nombre_marches,
  CAST(sum(montant_ttc) AS DOUBLE) AS montant_total_ttc,
  CAST(sum(montant_ttc) AS DOUBLE) / nullif(count(montant_ttc), 0) AS montant_moyen_ttc
FROM attributions GROUP BY ALL""", B.ATTRIBUTIONS))
def agg_top_winners(spark, sf_dir):
    return R.top_winners(D.attributions(spark, sf_dir))


@query("agg_monthly_first", B.with_tables("""
SELECT date_trunc('month', date_publication) AS mois, type_marche, statut, count(*) AS nombre_consultations,
  CAST(sum(montant_estime) AS DOUBLE) AS montant_total_estime,
  CAST(sum(montant_estime) AS DOUBLE) / nullif(count(montant_estime), 0) AS montant_moyen_estime
FROM consultations GROUP BY ALL ORDER BY mois DESC, type_marche, statut LIMIT 25""", B.CONSULTATIONS_CORE))
def agg_monthly_first(spark, sf_dir):
    """The head of the report in the order in which it is shown."""
    return R.monthly_stats(D.consultations_core(spark, sf_dir), ordered=True).limit(25)


@query("agg_bodies_first", B.with_tables("""
SELECT organisme_acronyme, organisme_nom_complet, count(*) AS nombre_consultations, CAST(sum(montant_estime) AS DOUBLE) AS montant_total_estime
FROM consultations GROUP BY ALL ORDER BY nombre_consultations DESC, organisme_acronyme, organisme_nom_complet LIMIT 25""", B.CONSULTATIONS))
def agg_bodies_first(spark, sf_dir):
    return R.top_bodies(D.consultations(spark, sf_dir), ordered=True).limit(25)


@query("agg_winners_first", B.with_tables("""
SELECT entreprise_nom, entreprise_ville, count(*) AS nombre_marches, CAST(sum(montant_ttc) AS DOUBLE) AS montant_total_ttc,
  CAST(sum(montant_ttc) AS DOUBLE) / nullif(count(montant_ttc), 0) AS montant_moyen_ttc
FROM attributions GROUP BY ALL ORDER BY nombre_marches DESC, entreprise_nom, entreprise_ville LIMIT 25""", B.ATTRIBUTIONS))
def agg_winners_first(spark, sf_dir):
    return R.top_winners(D.attributions(spark, sf_dir), ordered=True).limit(25)


@query("agg_global_stats", B.with_tables("""
SELECT c.*, a.* FROM
 (SELECT count(*) AS total_consultations, count(*) FILTER (WHERE statut = 'en_cours') AS consultations_en_cours,
    coalesce(CAST(sum(montant_estime) AS DOUBLE), 0) AS montant_total_estime,
    count(DISTINCT organisme_acronyme) AS nombre_organismes, max(date_extraction) AS derniere_extraction
  FROM consultations) c,
 (SELECT count(*) AS total_attributions, coalesce(CAST(sum(montant_ttc) AS DOUBLE), 0) AS montant_total_attribue,
    count(DISTINCT entreprise_nom) AS nombre_entreprises FROM attributions) a""", B.CONSULTATIONS, B.ATTRIBUTIONS))
def agg_global_stats(spark, sf_dir):
    return R.global_stats(D.consultations(spark, sf_dir), D.attributions(spark, sf_dir))


@query("agg_top_n_bodies", B.with_tables("""
SELECT organisme_acronyme AS acronyme, organisme_nom_complet AS nom, count(*) AS nombre_consultations,
  coalesce(CAST(sum(montant_estime) AS DOUBLE), 0) AS montant_total
FROM consultations GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""", B.CONSULTATIONS))
def agg_top_n_bodies(spark, sf_dir):
    return R.top_n_bodies(D.consultations(spark, sf_dir))


@query("agg_run_24h", B.with_tables("""
SELECT CAST(coalesce(sum(items_extraits), 0) AS BIGINT) AS total_items,
  CAST(coalesce(sum(erreurs), 0) AS BIGINT) AS total_erreurs, coalesce(sum(items_extraits), 0) = 0 AS alerte_aucun_item
FROM runs WHERE date_execution >= (SELECT max(date_execution) FROM runs) - INTERVAL 24 HOUR""", B.RUNS))
def agg_run_24h(spark, sf_dir):
    runs = D.extraction_logs(spark, sf_dir)
    return R.run_totals(recent_runs(runs, runs.agg(F.max("date_execution")).scalar()))


@query("agg_url_coverage", B.with_tables("""
SELECT total, avec_url, total - avec_url AS sans_url, round(avec_url / total * 100, 2) AS pourcentage, avec_url_sql,
  round(avec_url_sql / total * 100, 2) AS pourcentage_sql,
  CASE WHEN total = 0 THEN 'echec' WHEN avec_url = total THEN 'excellent' WHEN avec_url > total * 0.8 THEN 'bon'
       ELSE 'attention' END AS verdict
FROM (SELECT count(*) AS total, count(url_detail) AS avec_url_sql,
        count(*) FILTER (WHERE trim(url_detail) <> '') AS avec_url FROM consultations)""", B.CONSULTATIONS_CORE))
def agg_url_coverage(spark, sf_dir):
    return R.url_coverage(D.consultations_core(spark, sf_dir))


@query("flt_without_url", B.with_tables("""
SELECT ref_consultation, titre, organisme_acronyme FROM consultations WHERE url_detail IS NULL OR url_detail = ''
""", B.CONSULTATIONS))
def flt_without_url(spark, sf_dir):
    return R.without_url(D.consultations(spark, sf_dir))


@query("agg_samples", B.with_tables("""
SELECT ref_consultation, substr(titre, 1, 60) AS titre, url_detail FROM consultations WHERE url_detail IS NOT NULL
ORDER BY ref_consultation LIMIT 10""", B.CONSULTATIONS))
def agg_samples(spark, sf_dir):
    return R.url_samples(D.consultations(spark, sf_dir))


@query("agg_run_counters", B.with_tables("""
SELECT spider, date_trunc('day', ts) AS jour, count(*) FILTER (WHERE metric = 'pages_scraped_total') AS pages,
  count(*) FILTER (WHERE metric = 'items_scraped_total') AS items,
  count(*) FILTER (WHERE metric = 'spider_errors_total') AS erreurs, min(ts) AS debut, max(ts) AS fin
FROM metrics GROUP BY ALL""", B.METRICS))
def agg_run_counters(spark, sf_dir):
    return R.run_counters(D.metrics(spark, sf_dir))


@query("agg_run_log", B.with_tables("""
SELECT debut AS date_execution, spider AS spider_name,
  CASE WHEN erreurs > 0 AND items = 0 THEN 'failed' WHEN erreurs > 0 THEN 'partial' ELSE 'success' END AS statut,
  pages AS pages_parcourues, items AS items_extraits, erreurs,
  CAST(trunc(epoch_us(fin) / 1000000.0 - epoch_us(debut) / 1000000.0) AS BIGINT) AS duree_secondes
FROM (SELECT spider, date_trunc('day', ts) AS jour, count(*) FILTER (WHERE metric = 'pages_scraped_total') AS pages,
  count(*) FILTER (WHERE metric = 'items_scraped_total') AS items,
  count(*) FILTER (WHERE metric = 'spider_errors_total') AS erreurs, min(ts) AS debut, max(ts) AS fin
  FROM metrics GROUP BY ALL)""", B.METRICS))
def agg_run_log(spark, sf_dir):
    return R.run_log(R.run_counters(D.metrics(spark, sf_dir)))


@query("agg_labelled_counters", B.with_tables("""
SELECT metric, spider, coalesce(label, '') AS label, count(*) AS total FROM metrics GROUP BY ALL""", B.METRICS))
def agg_labelled_counters(spark, sf_dir):
    return R.labelled_counters(D.metrics(spark, sf_dir))


@query("agg_run_summary", B.with_tables("""
SELECT (SELECT count(*) FROM consultations) AS total_consultations, (SELECT count(*) FROM pv_extraits) AS total_pv,
  (SELECT count(*) FROM runs WHERE statut = 'failed') AS total_erreurs, TIMESTAMP '2024-01-01 00:00:00' AS debut,
  CAST(90 AS BIGINT) AS duree_secondes""", B.CONSULTATIONS_CORE, B.PV, B.RUNS))
def agg_run_summary(spark, sf_dir):
    runs = D.extraction_logs(spark, sf_dir)
    return R.run_summary(D.consultations_core(spark, sf_dir), D.pv_extraits(spark, sf_dir),
                         runs.filter(F.col("statut") == "failed"), "2024-01-01 00:00:00", "2024-01-01 00:01:30")
