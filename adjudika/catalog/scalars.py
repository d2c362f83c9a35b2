"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudika import functions as fn
from adjudika.catalog import bindings_sql as B
from adjudika.catalog.registry import query
from adjudika.sources import driver_tables as D

_WS = r"'[\s]+', ' ', 'g'"


@query("sca_clean_text", f"""
SELECT doc_id, trim(regexp_replace(text, {_WS})) AS texte,
  substr(trim(regexp_replace(text, {_WS})), 1, 1000) AS objet, substr(text, 1, 60) AS apercu FROM documents""")
def sca_clean_text(spark, sf_dir):
    docs = D.read(spark, sf_dir, "documents")
    return fn.normalize_strings(docs.select("doc_id", F.col("text").alias("texte"), F.col("text").alias("objet"),
                                            F.encode(fn.preview(F.col("text"), 60), "UTF-8").alias("apercu"))).withColumn(
        "apercu", F.decode("apercu", "UTF-8"))


@query("sca_dates", """
SELECT o_orderkey, o_orderdate AS de_barres, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS de_tirets,
  o_orderdate + INTERVAL 870 MINUTE AS avec_heure, CAST(NULL AS TIMESTAMP) AS impossible,
  date_trunc('month', o_orderdate) AS mois,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS jour
FROM orders""")
def sca_dates(spark, sf_dir):
    orders = D.read(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    return orders.select(
        "o_orderkey",
        fn.parse_datetime(F.date_format(day, "d/M/yyyy")).alias("de_barres"),
        fn.parse_datetime(F.when(F.col("o_orderkey") % 3 == 0, "zz").otherwise(F.date_format(day, " yyyy-MM-dd ")))
        .alias("de_tirets"),
        fn.parse_datetime(F.date_format(day, "dd-MM-yyyy '14:30'")).alias("avec_heure"),
        fn.parse_datetime(F.date_format(day, "'31/02/'yyyy")).alias("impossible"),
        fn.month_bucket(day).alias("mois"),
        fn.iso_or_blank(day).alias("iso"),
        fn.parse_date(F.date_format(day, "dd/MM/yyyy")).cast("timestamp_ntz").alias("jour"),
    )


@query("sca_amounts", """
SELECT o_orderkey, o_totalprice AS de_page, CAST(NULL AS DOUBLE) AS de_page_groupes,
  o_totalprice AS nettoye, CAST(NULL AS DOUBLE) AS nettoye_devise,
  CASE WHEN o_totalprice <> 0 THEN o_totalprice END AS non_nul
FROM orders""")
def sca_amounts(spark, sf_dir):
    price = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    comma = F.replace(price, F.lit("."), F.lit(","))
    return D.read(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.parse_amount(F.concat(comma, F.lit(" DH"))).alias("de_page"),
        fn.parse_amount(F.concat(F.lit("1.000,"), price)).alias("de_page_groupes"),
        fn.clean_amount(comma).alias("nettoye"),
        fn.clean_amount(F.concat(comma, F.lit(" DH"))).alias("nettoye_devise"),
        fn.zero_as_null(F.col("o_totalprice")).alias("non_nul"),
    )


@query("sca_labels", """
SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'travaux' WHEN '2' THEN 'fournitures'
    WHEN '3' THEN 'services' WHEN '4' THEN 'etudes' ELSE 'autre' END AS type_marche,
  CASE o_orderstatus WHEN 'O' THEN 'en_cours' WHEN 'F' THEN 'cloture' ELSE 'annule' END AS statut,
  'en_cours' AS statut_absent, o_orderpriority || ' ' || o_orderstatus AS procedure, o_orderpriority AS sans_mode
FROM orders""")
def sca_labels(spark, sf_dir):
    return D.read(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.normalize_type_marche(D.type_label(F.col("o_orderpriority"))).alias("type_marche"),
        fn.normalize_statut(D.status_label(F.col("o_orderstatus"))).alias("statut"),
        fn.normalize_statut(F.lit("")).alias("statut_absent"),
        fn.procedure_label(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("procedure"),
        fn.procedure_label(F.col("o_orderpriority"), F.lit("")).alias("sans_mode"),
    )


@query("sca_urls", r"""
SELECT page_id, split_part(url, '#', 1) AS sans_fragment,
  nullif(regexp_extract(split_part(url, '#', 1), '[?&]page=([^&]+)', 1), '') AS page,
  nullif(regexp_extract(split_part(url, '#', 1), '[?&]utm_source=([^&]+)', 1), '') AS source,
  regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/avis/1.pdf' AS absolu,
  regexp_extract(url, '^(https?://[^?#]*/)', 1) || 'dce.zip' AS relatif,
  'https://www.marchespublics.gov.ma/index.php?page=entreprise.EntrepriseDetailsConsultation&refConsultation='
    || page_id || '&orgAcronyme=o1' AS canonique,
  url AS non_canonique, replace(regexp_extract(url, '^([^?#]*)', 1), '/en/', '/') AS bureau
FROM pages""")
def sca_urls(spark, sf_dir):
    pages = spark.read.schema("page_id bigint, url string").parquet(f"{sf_dir}/pages.parquet")
    url = F.col("url")
    mobile = F.replace(F.substring_index(F.substring_index(url, "#", 1), "?", 1), F.lit("/en/"), F.lit("/mobile/"))
    detail = F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit("orgAcronyme=o1&refConsultation="),
                      F.col("page_id").cast("string"))
    bare = F.substring_index(url, "#", 1)
    return pages.select(
        "page_id", fn.drop_fragment(url).alias("sans_fragment"), fn.query_param(url, "page").alias("page"),
        fn.query_param(url, "utm_source").alias("source"), fn.url_join(url, F.lit("/avis/1.pdf")).alias("absolu"),
        fn.url_join(url, F.lit("dce.zip")).alias("relatif"),
        fn.canonical_detail_url(F.concat(bare, F.substring(detail, F.length(url) + 1, F.length(detail)))).alias("canonique"),
        fn.canonical_detail_url(url).alias("non_canonique"),
        fn.to_desktop(mobile).alias("bureau"),
    )


@query("sca_uid", B.with_tables("""
SELECT ref_consultation, sha256(organisme_nom_complet || '|' || ref_consultation || '|'
    || coalesce(strftime(date_limite, '%Y-%m-%d'), '')) AS id,
  substr(md5(titre), 1, 8) AS empreinte,
  ref_consultation || '_' || strftime(date_extraction, '%Y%m%d_%H%M%S') || '_' || substr(md5(titre), 1, 8) || '.html'
    AS archive
FROM consultations""", B.CONSULTATIONS))
def sca_uid(spark, sf_dir):
    return D.consultations(spark, sf_dir).select(
        "ref_consultation",
        fn.record_uid(F.col("organisme_nom_complet"), F.col("ref_consultation"),
                      F.date_format("date_limite", "yyyy-MM-dd")).alias("id"),
        fn.content_hash(F.col("titre")).alias("empreinte"),
        fn.archive_name(F.col("ref_consultation"), F.col("date_extraction"), F.col("titre")).alias("archive"),
    )


@query("sca_deadline", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate + INTERVAL 9131 DAY, '%Y-%m-%d')
  WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate + INTERVAL 9131 DAY, '%Y-%m-%d')
  WHEN o_orderkey % 4 = 2 THEN 'vers le 01/2025' ELSE '' END AS echeance
FROM orders""")
def sca_deadline(spark, sf_dir):
    key = F.col("o_orderkey")
    later = F.col("o_orderdate") + F.make_dt_interval(F.lit(9131))
    slash, dash = F.date_format(later, "dd/MM/yyyy"), F.date_format(later, "dd-MM-yyyy")
    cells = [
        F.when(key % 4 == 0, slash).otherwise("Casablanca"),
        F.when(key % 4 == 1, dash).otherwise("A - B"),
        F.when(key % 4 == 2, "vers le 01/2025").otherwise(F.lit(None).cast("string")),
        F.lit("10:00"),
    ]
    return D.read(spark, sf_dir, "orders").select("o_orderkey", fn.deadline_from_cells(cells).alias("echeance"))


@query("sca_stamps", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS horodatage, date_trunc('day', ts + INTERVAL 1 HOUR) AS jour FROM events""")
def sca_stamps(spark, sf_dir):
    """UTC stamps, and the day in Casablanca, which is an hour ahead of UTC all through the events' month."""
    ts = F.col("ts")
    return D.read(spark, sf_dir, "events").select(
        "event_id", fn.utc_iso_seconds(ts).alias("horodatage"), fn.casablanca_today(ts).cast("timestamp_ntz").alias("jour"))
