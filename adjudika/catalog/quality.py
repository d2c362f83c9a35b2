"""Record checks and the incoming-record fixtures derived from the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudika.catalog import bindings_sql as B
from adjudika.catalog.registry import query
from adjudika.operators import quality as Q
from adjudika.plans.reports import item_counters
from adjudika.sources import driver_tables as D

# Some incoming tenders lack a title, a body or both.
RAW = """raw AS (SELECT ref_consultation, CASE WHEN k % 13 = 0 THEN '' WHEN k % 17 = 0 THEN '  ' ELSE titre END AS titre,
  CASE WHEN k % 19 = 0 THEN NULL ELSE organisme_acronyme END AS organisme_acronyme, type_marche, statut,
  date_publication, date_extraction, CASE WHEN k % 23 = 0 THEN 1e15 ELSE CAST(montant_estime AS DOUBLE) END AS montant_estime,
  CASE WHEN k % 29 = 0 THEN repeat('x', 501) ELSE url_detail END AS url_detail
  FROM (SELECT *, CAST(substr(ref_consultation, 4) AS BIGINT) AS k FROM consultations))"""


def incoming(spark, sf_dir):
    return incoming_from(D.consultations(spark, sf_dir))


def incoming_from(consultations):
    key = F.substring("ref_consultation", 4, 20).cast("bigint")
    return consultations.select(
        "ref_consultation",
        F.when(key % 13 == 0, "").when(key % 17 == 0, "  ").otherwise(F.col("titre")).alias("titre"),
        F.when(key % 19 != 0, F.col("organisme_acronyme")).alias("organisme_acronyme"),
        "type_marche", "statut", "date_publication", "date_extraction",
        F.when(key % 23 == 0, F.lit(1e15)).otherwise(F.col("montant_estime").cast("double")).alias("montant_estime"),
        F.when(key % 29 == 0, F.repeat(F.lit("x"), F.lit(501))).otherwise(F.col("url_detail")).alias("url_detail"),
    )


_REQUIRED = """CASE WHEN titre = '' THEN 'titre' WHEN organisme_acronyme IS NULL THEN 'organisme_acronyme' END"""


@query("val_required", B.with_tables(f"""
SELECT ref_consultation, CASE WHEN f IS NOT NULL THEN 'missing_required_field' END AS raison, f AS champ
FROM (SELECT *, {_REQUIRED} AS f FROM raw)""", B.CONSULTATIONS, RAW))
def val_required(spark, sf_dir):
    return Q.check_required(incoming(spark, sf_dir), "consultation").select(
        "ref_consultation", F.col("_reason").alias("raison"), F.col("_field").alias("champ"))


_STORABLE = """CASE WHEN organisme_acronyme IS NULL THEN 'organisme_acronyme'
  WHEN titre IS NULL THEN 'titre' WHEN type_marche NOT IN ('travaux', 'fournitures', 'services', 'etudes') THEN 'type_marche'
  WHEN montant_estime >= 1e13 THEN 'montant_estime' WHEN length(url_detail) > 500 THEN 'url_detail' END"""


@query("val_domain", B.with_tables(f"""
SELECT ref_consultation, CASE WHEN f IS NOT NULL THEN 'database_error' END AS raison, f AS champ
FROM (SELECT *, {_STORABLE} AS f FROM raw)""", B.CONSULTATIONS, RAW))
def val_domain(spark, sf_dir):
    return Q.check_storable(incoming(spark, sf_dir), "consultation").select(
        "ref_consultation", F.col("_reason").alias("raison"), F.col("_field").alias("champ"))


@query("val_blank_stored", B.with_tables(r"""
SELECT count(*) FILTER (WHERE trim(titre) = '') AS titre FROM raw WHERE titre <> ''""", B.CONSULTATIONS, RAW))
def val_blank_stored(spark, sf_dir):
    checked = Q.good(Q.check_required(incoming(spark, sf_dir), "consultation").filter(
        (F.col("_field") != "titre") | F.col("_field").isNull()).withColumn("_reason", F.lit(None).cast("string")))
    return Q.blank_not_null(Q.clean_record(checked), "consultation").select("titre")


@query("agg_item_counters", B.with_tables(f"""
SELECT 'consultation' AS _type, CASE WHEN {_REQUIRED} IS NOT NULL THEN 'missing_required_field'
  WHEN {_STORABLE} IS NOT NULL THEN 'database_error' ELSE 'saved' END AS issue, count(*) AS n FROM raw GROUP BY ALL
""", B.CONSULTATIONS, RAW))
def agg_item_counters(spark, sf_dir):
    checked = Q.check_storable(
        Q.clean_record(Q.check_required(incoming(spark, sf_dir), "consultation")), "consultation")
    return item_counters(checked.withColumn("_type", F.lit("consultation")))
