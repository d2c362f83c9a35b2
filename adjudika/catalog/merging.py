"""Deduplication and upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudika.catalog import bindings_sql as B
from adjudika.catalog.registry import query
from adjudika.functions import build_detail_url, record_uid
from adjudika.operators import dedup, merge
from adjudika.sources import driver_tables as D

# Line items arrive in ship-date order; a tender reference occurs once per line item.
ARRIVING = """arriving AS (SELECT 'AO-' || l_orderkey AS ref_consultation, l_shipdate, l_linenumber, l_partkey, l_suppkey,
  l_extendedprice, CASE WHEN l_linenumber % 3 <> 0 THEN 'remarque ' || l_linenumber END AS remarque FROM lineitem)"""
_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def arriving(spark, sf_dir):
    return D.read(spark, sf_dir, "lineitem").select(
        D.ref_of(F.col("l_orderkey")).alias("ref_consultation"), *_ORDER,
        F.when(F.col("l_linenumber") % 3 != 0,
               F.concat(F.lit("remarque "), F.col("l_linenumber").cast("string"))).alias("remarque"))


@query("ded_first_ref", B.with_tables(f"""
SELECT * FROM arriving
QUALIFY row_number() OVER (PARTITION BY ref_consultation ORDER BY {', '.join(_ORDER)}) = 1""", ARRIVING))
def ded_first_ref(spark, sf_dir):
    return dedup.first_per_key(arriving(spark, sf_dir), ["ref_consultation"], _ORDER)


@query("ded_labels", B.with_tables(f"""
SELECT ref_consultation, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  CASE WHEN row_number() OVER (PARTITION BY ref_consultation ORDER BY {', '.join(_ORDER)}) > 1 THEN 'duplicate' END AS raison
FROM arriving""", ARRIVING))
def ded_labels(spark, sf_dir):
    labelled = dedup.label_duplicates(arriving(spark, sf_dir).drop("remarque"), ["ref_consultation"], _ORDER)
    return labelled.withColumnRenamed("_reason", "raison")


# Result pages of 40 line items; a link repeats its detail page with different fragments.
LINKS = """links AS (SELECT CAST(floor(l_partkey / 40) AS BIGINT) AS page_id,
  'https://p.example/d?ref=' || (l_partkey % 50) || '#' || l_linenumber AS url,
  CAST(l_suppkey * 100 + l_linenumber AS BIGINT) AS pos FROM lineitem)"""


@query("ded_links", B.with_tables("""
SELECT page_id, min(pos) AS pos, arg_min(url, (pos, url)) AS url FROM links GROUP BY page_id, split_part(url, '#', 1)
""", LINKS))
def ded_links(spark, sf_dir):
    links = D.read(spark, sf_dir, "lineitem").select(
        F.floor(F.col("l_partkey") / 40).cast("bigint").alias("page_id"),
        F.concat(F.lit("https://p.example/d?ref="), (F.col("l_partkey") % 50).cast("string"), F.lit("#"),
                 F.col("l_linenumber").cast("string")).alias("url"),
        (F.col("l_suppkey") * 100 + F.col("l_linenumber")).cast("bigint").alias("pos"))
    return dedup.dedup_links(links)


@query("ded_canonical", """
WITH l AS (SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE 'r' || l_orderkey END AS r, 'o' || (l_orderkey % 9) AS o FROM lineitem)
SELECT r AS ref, o AS org, 'https://www.marchespublics.gov.ma/index.php?page=entreprise.EntrepriseDetailsConsultation&refConsultation='
  || r || '&orgAcronyme=' || o AS url, count(*) AS n, (SELECT count(*) FROM l WHERE r IS NULL) AS dropped
FROM l WHERE r IS NOT NULL GROUP BY 1, 2""")
def ded_canonical(spark, sf_dir):
    key = F.col("l_orderkey").cast("string")
    org = F.concat(F.lit("o"), (F.col("l_orderkey") % 9).cast("string"))
    full = F.concat(build_detail_url(F.concat(F.lit("r"), key), org), F.lit("&x="), F.col("l_linenumber").cast("string"))
    bare = F.concat(F.lit("/index.php?orgAcronyme="), org, F.lit("&refConsultation="))
    links = D.read(spark, sf_dir, "lineitem").select(F.when(F.col("l_linenumber") == 7, bare).otherwise(full).alias("url"))
    return dedup.canonical_links(links)


@query("ded_uid", B.with_tables(f"""
SELECT sha256(id_text) AS id, ref_consultation, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, l_suppkey || '|' || ref_consultation || '|' AS id_text FROM arriving)
WHERE l_suppkey % 4 <> 0
QUALIFY row_number() OVER (PARTITION BY id_text ORDER BY {', '.join(_ORDER)}) = 1""", ARRIVING))
def ded_uid(spark, sf_dir):
    records = arriving(spark, sf_dir).drop("remarque").withColumn("id", record_uid(
        F.col("l_suppkey").cast("string"), F.col("ref_consultation"), F.lit(None).cast("string")))
    stored = records.filter(F.col("l_suppkey") % 4 == 0).select("id").distinct()
    return dedup.new_records(records, stored, _ORDER)


def _merged(spark, sf_dir):
    """Stored: every tender that is not cancelled. Incoming: line items, in ship-date order."""
    stored = D.consultations_core(spark, sf_dir).filter(F.col("statut") != "annule").select(
        "ref_consultation", F.concat(F.lit("obs "), "ref_consultation").alias("remarque"),
        F.col("montant_estime").cast("double").alias("montant"), F.lit(None).cast("timestamp_ntz").alias("date_derniere_maj"))
    batch = arriving(spark, sf_dir)
    incoming = merge.last_values(
        batch.select("ref_consultation", "remarque", F.col("l_extendedprice").alias("montant"), *_ORDER),
        "ref_consultation", _ORDER)
    return merge.upsert(stored, incoming, "ref_consultation", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))


_MERGED = [B.CONSULTATIONS_CORE, ARRIVING, """old AS (SELECT ref_consultation, 'obs ' || ref_consultation AS remarque,
  CAST(montant_estime AS DOUBLE) AS montant FROM consultations WHERE statut <> 'annule')""",
  f"""batch AS (SELECT *, row_number() OVER (PARTITION BY ref_consultation ORDER BY {', '.join(_ORDER)}) AS rn
  FROM arriving)""",
  """new AS (SELECT ref_consultation, arg_max(remarque, rn) FILTER (WHERE remarque IS NOT NULL) AS remarque,
  arg_max(l_extendedprice, rn) AS montant, count(*) AS items FROM batch GROUP BY 1)""",
  """merged AS (SELECT coalesce(n.ref_consultation, o.ref_consultation) AS ref_consultation,
  coalesce(n.remarque, o.remarque) AS remarque, coalesce(n.montant, o.montant) AS montant,
  CASE WHEN n.ref_consultation IS NOT NULL AND o.ref_consultation IS NOT NULL THEN TIMESTAMP '2025-01-01' END
    AS date_derniere_maj,
  CASE WHEN n.ref_consultation IS NULL THEN 'keep' WHEN o.ref_consultation IS NULL THEN 'insert' ELSE 'update' END AS _action,
  coalesce(items, 0) AS _items
  FROM old o FULL JOIN new n ON o.ref_consultation = n.ref_consultation)"""]


@query("mrg_upsert", B.with_tables("SELECT * FROM merged", *_MERGED))
def mrg_upsert(spark, sf_dir):
    return _merged(spark, sf_dir)


@query("mrg_counts", B.with_tables("""
SELECT count(*) FILTER (WHERE _action = 'insert') AS inserted,
  CAST(sum(_items) - count(*) FILTER (WHERE _action = 'insert') AS BIGINT) AS updated,
  count(*) FILTER (WHERE _action = 'keep') AS kept FROM merged""", *_MERGED))
def mrg_counts(spark, sf_dir):
    return merge.merge_counts(_merged(spark, sf_dir))


@query("mrg_insert_only", B.with_tables(f"""
SELECT ref_consultation, l_shipdate, l_extendedprice FROM arriving
WHERE ref_consultation NOT IN (SELECT ref_consultation FROM consultations WHERE statut <> 'annule')
QUALIFY row_number() OVER (PARTITION BY ref_consultation ORDER BY {', '.join(_ORDER)}) = 1""", B.CONSULTATIONS_CORE, ARRIVING))
def mrg_insert_only(spark, sf_dir):
    first = dedup.first_per_key(arriving(spark, sf_dir), ["ref_consultation"], _ORDER)
    stored = D.consultations_core(spark, sf_dir).filter(F.col("statut") != "annule")
    return dedup.new_keys(first, stored, "ref_consultation").select("ref_consultation", "l_shipdate", "l_extendedprice")
