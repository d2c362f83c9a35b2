"""Joins between tenders, children, details and stored keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudika.catalog import bindings_sql as B
from adjudika.catalog.registry import query
from adjudika.operators import relations as J
from adjudika.operators.dedup import first_per_key, new_keys
from adjudika.sources import driver_tables as D


@query("jn_orphans", B.with_tables("""
SELECT ref_consultation, numero_lot, count(*) AS n FROM lots
WHERE ref_consultation NOT IN (SELECT ref_consultation FROM consultations WHERE statut = 'en_cours') GROUP BY 1, 2
""", B.CONSULTATIONS_CORE, B.LOTS))
def jn_orphans(spark, sf_dir):
    parents = D.consultations_core(spark, sf_dir).filter(F.col("statut") == "en_cours")
    return J.orphans(D.lots(spark, sf_dir), parents, "ref_consultation").groupBy("ref_consultation", "numero_lot").agg(
        F.count(F.lit(1)).alias("n"))


@query("jn_with_parent", B.with_tables("""
SELECT count(*) AS n, CAST(sum(montant_estime) AS DOUBLE) AS total FROM lots
WHERE ref_consultation IN (SELECT ref_consultation FROM consultations WHERE statut = 'en_cours')
""", B.CONSULTATIONS_CORE, B.LOTS))
def jn_with_parent(spark, sf_dir):
    parents = D.consultations_core(spark, sf_dir).filter(F.col("statut") == "en_cours")
    return J.with_parent(D.lots(spark, sf_dir), parents, "ref_consultation").agg(
        F.count(F.lit(1)).alias("n"), F.sum("montant_estime").cast("double").alias("total"))


@query("jn_new_refs", B.with_tables("""
SELECT ref_consultation, min(date_extraction) AS date_extraction FROM lots
WHERE ref_consultation NOT IN (SELECT ref_consultation FROM consultations WHERE statut <> 'annule')
GROUP BY 1""", B.CONSULTATIONS_CORE, B.LOTS))
def jn_new_refs(spark, sf_dir):
    arriving = D.lots(spark, sf_dir).select("ref_consultation", "date_extraction")
    stored = D.consultations_core(spark, sf_dir).filter(F.col("statut") != "annule")
    return new_keys(first_per_key(arriving, ["ref_consultation"], ["date_extraction"]), stored, "ref_consultation")


@query("jn_list_detail", B.with_tables("""
SELECT c.ref_consultation, coalesce(d.objet, c.objet) AS objet, d.organisme_ville,
  CAST(coalesce(d.montant_estime, c.montant_estime) AS DOUBLE) AS montant_estime
FROM consultations c LEFT JOIN (
  SELECT url_detail, 'Objet ' || ref_consultation AS objet, organisme_ville,
    CASE WHEN statut = 'en_cours' THEN montant_estime * 2 END AS montant_estime
  FROM consultations WHERE url_detail <> '' AND statut <> 'annule') d ON c.url_detail = d.url_detail""", B.CONSULTATIONS))
def jn_list_detail(spark, sf_dir):
    tenders = D.consultations(spark, sf_dir)
    detail = tenders.filter((F.col("url_detail") != "") & (F.col("statut") != "annule")).select(
        "url_detail", F.concat(F.lit("Objet "), "ref_consultation").alias("objet"), "organisme_ville",
        F.when(F.col("statut") == "en_cours", F.col("montant_estime") * 2).alias("montant_estime"))
    base = tenders.select("ref_consultation", "url_detail", "objet", "montant_estime")
    return J.enrich(base, detail, "url_detail").select(
        "ref_consultation", "objet", "organisme_ville", F.col("montant_estime").cast("double").alias("montant_estime"))


@query("jn_cascade", B.with_tables("""
SELECT count(*) AS restants, count(DISTINCT ref_consultation) AS refs FROM lots
WHERE ref_consultation NOT IN (SELECT ref_consultation FROM consultations WHERE statut = 'annule')
""", B.CONSULTATIONS_CORE, B.LOTS))
def jn_cascade(spark, sf_dir):
    deleted = D.consultations_core(spark, sf_dir).filter(F.col("statut") == "annule")
    return J.cascade_delete(D.lots(spark, sf_dir), deleted, "ref_consultation").agg(
        F.count(F.lit(1)).alias("restants"), F.countDistinct("ref_consultation").alias("refs"))
