"""Extraction from archived pages: the given raw pages, and portal pages rendered from the order table."""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudika.catalog.registry import query
from adjudika.extraction import links as K
from adjudika.extraction import rows as X
from adjudika.extraction import elements as E
from adjudika.extraction.picking import dealt
from adjudika.operators import dedup
from adjudika.operators import relations as J
from adjudika.session import work_dir
from adjudika.sources import driver_tables as D
from adjudika.sources import rendered_pages as P


#: Pages in one task at most, on average: a task takes some seconds however many pages there are.
PAGES_A_TASK = 20_000


def _tasks(pages):
    """The pages here come from small files: they are dealt out to all cores, and to more tasks the more pages there are."""
    return max(pages.sparkSession.sparkContext.defaultParallelism, -(-pages.count() // PAGES_A_TASK))


def with_elements(pages):
    return E.with_elements(pages, partitions=_tasks(pages))


def raw(pages):
    """The same for pages whose fields the kernel picks itself."""
    return dealt(pages, _tasks(pages))


def _stamp():
    return F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")


_DETAIL = ("'https://www.marchespublics.gov.ma/index.php?page=entreprise.EntrepriseDetailsConsultation&refConsultation=' || "
           "o_orderkey || '&orgAcronyme='")
_TYPE = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'travaux' WHEN '2' THEN 'fournitures' WHEN '3' THEN 'services'
  WHEN '4' THEN 'etudes' ELSE 'autre' END"""
_STATUT = "CASE o_orderstatus WHEN 'O' THEN 'en_cours' WHEN 'F' THEN 'cloture' ELSE 'annule' END"
_RAW_LINKS = """l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)"""
_DETAIL_WORDS = "(lower(href) LIKE '%detail%' OR lower(href) LIKE '%consultation%' OR lower(href) LIKE '%pp%' OR lower(href) LIKE '%annonce%')"


def _numbered(modulus: int) -> str:
    return f"(SELECT *, unnest(range(1, o_orderkey % {modulus} + 2)) AS i FROM orders)"


@query("ext_links", f"WITH {_RAW_LINKS} SELECT page_id, href, count(*) AS n FROM l GROUP BY 1, 2")
def ext_links(spark, sf_dir):
    links = K.page_links(with_elements(D.pages(spark, sf_dir)))
    return links.groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("n"))


@query("ext_link_kinds", f"""WITH {_RAW_LINKS}
SELECT page_id, count(*) AS liens, count(*) FILTER (WHERE {_DETAIL_WORDS}) AS details,
  count(*) FILTER (WHERE lower(href) LIKE '%consultation%' OR lower(href) LIKE '%details%') AS consultations,
  count(*) FILTER (WHERE lower(href) LIKE '%pv%' OR lower(href) LIKE '%proces-verbal%') AS pv FROM l GROUP BY 1""")
def ext_link_kinds(spark, sf_dir):
    kinds = K.classify(K.page_links(with_elements(D.pages(spark, sf_dir))))
    return kinds.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("liens"), F.count_if("detail_like").alias("details"),
        F.count_if("tender_like").alias("consultations"), F.count_if("minutes_like").alias("pv"))


@query("ext_patterns", f"""WITH {_RAW_LINKS}
SELECT split_part(href, '?', 1) AS pattern, count(*) AS n FROM l WHERE {_DETAIL_WORDS} GROUP BY 1""")
def ext_patterns(spark, sf_dir):
    return K.link_patterns(with_elements(D.pages(spark, sf_dir)))


_KINDS = """SELECT o_orderkey AS k, o_orderkey % 2 = 0 AS d, o_orderkey % 3 = 0 AS p, o_orderkey % 5 = 0 AS a, o_orderkey % 7 = 0 AS v,
  o_orderkey % 11 = 0 AS c, o_orderkey % 4 <= 1 AS s FROM orders"""


@query("ext_link_kinds_all", f"""
SELECT k AS page_id, CAST(1 + d::INT + p::INT + a::INT + v::INT + c::INT + s::INT AS BIGINT) AS liens,
  CAST(d::INT + p::INT + a::INT + c::INT AS BIGINT) AS details, CAST(c::INT AS BIGINT) AS consultations, CAST(v::INT AS BIGINT) AS pv FROM ({_KINDS})""")
def ext_link_kinds_all(spark, sf_dir):
    kinds = K.classify(K.page_links(with_elements(P.link_pages(spark, sf_dir))))
    return kinds.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("liens"), F.count_if("detail_like").alias("details"),
        F.count_if("tender_like").alias("consultations"), F.count_if("minutes_like").alias("pv"))


_PATTERNS = f"""patterns AS (SELECT '/avis/detail' AS pattern FROM ({_KINDS}) WHERE d UNION ALL SELECT '/marche/pp' FROM ({_KINDS}) WHERE p
  UNION ALL SELECT '/Annonce/' || k FROM ({_KINDS}) WHERE a UNION ALL SELECT '/consultation/' || k FROM ({_KINDS}) WHERE c)"""


@query("ext_patterns_all", f"WITH {_PATTERNS} SELECT pattern, count(*) AS n FROM patterns GROUP BY 1")
def ext_patterns_all(spark, sf_dir):
    return K.link_patterns(raw(P.link_pages(spark, sf_dir)))


@query("ext_patterns_first", f"WITH {_PATTERNS} SELECT pattern, count(*) AS n FROM patterns GROUP BY 1 ORDER BY 1 LIMIT 20")
def ext_patterns_first(spark, sf_dir):
    """The first twenty of the sorted list."""
    return K.link_patterns(raw(P.link_pages(spark, sf_dir)), ordered=True).limit(20)


@query("ext_profile_markers", f"""
SELECT k AS page_id, CAST((k % 3 = 1)::INT AS BIGINT) AS tables, CAST(2 * (k % 3 = 1)::INT AS BIGINT) AS rows, CAST((k % 3 = 1)::INT AS BIGINT) AS headers,
  CAST(2 * (k % 3 = 1)::INT AS BIGINT) AS columns, CAST(1 + d::INT + p::INT + a::INT + v::INT + c::INT + s::INT AS BIGINT) AS links,
  k % 6 IN (1, 4) AS error_banner, k % 6 = 3 AS empty_result, k % 6 = 2 AS captcha FROM ({_KINDS})""")
def ext_profile_markers(spark, sf_dir):
    return K.profile(with_elements(P.link_pages(spark, sf_dir))).withColumn("columns", F.greatest("columns", F.lit(0)))


@query("ext_next_forms", """
SELECT o_orderkey AS page_id, 'https://www.marchespublics.gov.ma/l?p=' || o_orderkey AS url,
  CASE o_orderkey % 4 WHEN 0 THEN 'https://www.marchespublics.gov.ma/l?p=' || (o_orderkey + 1)
    WHEN 1 THEN 'https://www.marchespublics.gov.ma/l?currentPage=' || (o_orderkey + 1) END AS next_url FROM orders""")
def ext_next_forms(spark, sf_dir):
    return K.next_pages(raw(P.link_pages(spark, sf_dir)))


@query("ext_profile", """
SELECT page_id, len(regexp_extract_all(html, '<table')) AS tables, len(regexp_extract_all(html, '<tr[ >]')) AS rows,
  len(regexp_extract_all(html, '<th[ >]')) AS headers, CAST(0 AS BIGINT) AS columns,
  len(regexp_extract_all(html, '<a href=')) AS links, false AS error_banner, false AS empty_result, false AS captcha
FROM pages""")
def ext_profile(spark, sf_dir):
    return K.profile(with_elements(D.pages(spark, sf_dir)))


@query("ext_profile_lists", """
SELECT count(*) AS pages, count(*) FILTER (WHERE o_orderkey % 10 <> 5) AS tables,
  CAST(sum(o_orderkey % 3 + 2) FILTER (WHERE o_orderkey % 10 <> 5) AS BIGINT) AS rows,
  2 * count(*) FILTER (WHERE o_orderkey % 10 <> 5) AS headers,
  CAST(count(*) + count(*) FILTER (WHERE o_orderkey % 10 <> 9)
    + sum(o_orderkey % 3 + 1) FILTER (WHERE o_orderkey % 10 <> 5) AS BIGINT) AS links,
  CAST(8 AS BIGINT) AS max_columns, CAST(0 AS BIGINT) AS error_banner,
  count(*) FILTER (WHERE o_orderkey % 10 = 5) AS empty_result, CAST(0 AS BIGINT) AS captcha FROM orders""")
def ext_profile_lists(spark, sf_dir):
    return K.profile_totals(K.profile(with_elements(P.list_pages(spark, sf_dir))))


@query("ext_selectors", """
SELECT 'table' AS cible, 'table#t' AS selecteur, count(*) AS pages FROM orders WHERE o_orderkey % 10 <> 5
UNION ALL SELECT 'lien', 'a[href*="detail"]', count(*) FROM orders WHERE o_orderkey % 10 <> 5""")
def ext_selectors(spark, sf_dir):
    return K.suggest_selectors(with_elements(P.list_pages(spark, sf_dir)))


@query("ext_next", """
SELECT o_orderkey AS page_id, 'https://www.marchespublics.gov.ma/cherche/liste?p=' || o_orderkey AS url,
  CASE WHEN o_orderkey % 10 <> 9 THEN 'https://www.marchespublics.gov.ma/cherche/liste?p=' || (o_orderkey + 1) END AS next_url
FROM orders""")
def ext_next(spark, sf_dir):
    return K.next_pages(raw(P.list_pages(spark, sf_dir)))


@query("ext_pagination_gaps", """
SELECT o_orderkey AS page_id, 'https://www.marchespublics.gov.ma/cherche/liste?p=' || (o_orderkey + 1) AS next_url
FROM orders WHERE o_orderkey % 10 <> 9 AND o_orderkey + 1 NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 4 <> 0)""")
def ext_pagination_gaps(spark, sf_dir):
    pages = P.list_pages(spark, sf_dir)
    return J.missing_next_pages(K.next_pages(raw(pages)), pages.filter(F.col("page_id") % 4 != 0))


@query("ext_rows_roundtrip", f"""
SELECT o_orderkey AS page_id, 'AO-' || o_orderkey || '-' || i AS ref_consultation, 'Marche' AS titre, 'ORG' || i AS organisme_acronyme,
  {_TYPE} AS type_marche, o_orderdate AS date_publication, CASE WHEN i <> 2 THEN o_orderdate + INTERVAL 30 DAY END AS date_limite, {_STATUT} AS statut,
  CASE WHEN i < 3 THEN {_DETAIL} || 'O' || i ELSE
    'https://www.marchespublics.gov.ma/index.php?page=entreprise.EntrepriseDetailsConsultation&refConsultation=AO-'
    || o_orderkey || '-' || i || '&orgAcronyme=ORG' || i END AS url_detail,
  TIMESTAMP '2025-01-01' AS date_extraction, i < 3 AS suivre_detail FROM {_numbered(3)} WHERE o_orderkey % 10 <> 5""")
def ext_rows_roundtrip(spark, sf_dir):
    return X.tender_rows(raw(P.list_pages(spark, sf_dir)), _stamp()).drop("_no")


@query("ext_detail", """
SELECT 'https://www.marchespublics.gov.ma/index.php?page=entreprise.EntrepriseDetailsConsultation&refConsultation='
    || o_orderkey || '&orgAcronyme=org' AS url_detail,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'Objet de' END AS objet, 'Nom ' || o_custkey AS organisme_nom_complet,
  o_orderpriority AS organisme_ville, CASE WHEN o_orderkey % 3 <> 1 THEN '05 22 ' || o_custkey END AS organisme_telephone,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'Secteur ' || o_orderkey % 4 END AS secteur,
  CASE WHEN o_orderkey % 7 <> 0 THEN '4500' || o_orderkey % 7 END AS code_cpv,
  'c' || o_custkey || '@example.org' AS organisme_email, o_totalprice AS montant_estime,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey * 1000 + 0.5::DOUBLE END AS cautionnement_provisoire,
  'https://www.marchespublics.gov.ma/' || CASE WHEN o_orderkey % 2 = 0 THEN 'doc/avis-1.pdf' ELSE 'doc.php?n=1' END AS url_avis,
  'https://www.marchespublics.gov.ma/index.php?page=entreprise.EntrepriseDetailsConsultation&refConsultation='
    || o_orderkey || '&orgAcronyme=org' AS url_dce FROM orders""")
def ext_detail(spark, sf_dir):
    return X.detail_fields(raw(P.detail_pages(spark, sf_dir)))


@query("ext_lots_roundtrip", f"""
SELECT 'AO-' || o_orderkey AS ref_consultation, CAST(i AS VARCHAR) AS numero_lot, 'Lot ' || i || ' de ' || o_orderkey AS designation,
  o_totalprice AS montant_estime, TIMESTAMP '2025-01-01' AS date_extraction FROM {_numbered(4)}""")
def ext_lots_roundtrip(spark, sf_dir):
    pages = with_elements(P.detail_pages(spark, sf_dir))
    return X.lot_rows(pages, D.ref_of(F.col("page_id")), _stamp()).drop("_no")


@query("ext_pv", f"""
SELECT o_orderkey AS page_id, 'AO-' || o_orderkey AS ref_consultation, 'ORG' AS organisme_acronyme, 'PV ' || i AS type_pv,
  o_orderdate AS date_seance, o_orderdate AS date_publication_pv,
  CASE WHEN i = 2 THEN '' ELSE 'https://www.marchespublics.gov.ma/pv/' || o_orderkey || '.pdf' END AS url_pv,
  TIMESTAMP '2025-01-01' AS date_extraction FROM {_numbered(2)}""")
def ext_pv(spark, sf_dir):
    return X.minutes_rows(raw(P.minutes_pages(spark, sf_dir)), _stamp()).drop("_no")


@query("ext_awards", f"""
SELECT o_orderkey AS page_id, 'AO-' || o_orderkey AS ref_consultation, 'ORG' AS organisme_acronyme,
  'Entreprise ' || i AS entreprise_nom, o_totalprice AS montant_ttc, o_orderdate AS date_attribution,
  'https://www.marchespublics.gov.ma/r/liste.php?attribution=' || i AS url_resultat, TIMESTAMP '2025-01-01' AS date_extraction
FROM {_numbered(2)} WHERE o_orderkey % 7 <> 0""")
def ext_awards(spark, sf_dir):
    rows = X.award_rows(with_elements(P.award_pages(spark, sf_dir)), _stamp()).drop("_no")
    return rows.withColumn("date_attribution", F.col("date_attribution").cast("timestamp_ntz"))


@query("ext_form_rows", f"""
SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 3 = 2 THEN 'C-' || o_orderkey ELSE 'R-' || o_orderkey || ' b ' || i END AS ref,
  CASE WHEN o_orderkey % 3 = 2 THEN 'Carte ' || i ELSE 'Objet suite' END AS objet,
  CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE 'Acheteur' END AS acheteur,
  strftime(o_orderdate + INTERVAL 9131 DAY, '%Y-%m-%d') AS date_limite,
  CASE WHEN o_orderkey % 3 <> 2 THEN 'https://www.marchespublics.gov.ma/f/d?r=' || i END AS url_detail,
  'https://www.marchespublics.gov.ma/f/liste?p=' || o_orderkey AS source_list_url FROM {_numbered(2)}""")
def ext_form_rows(spark, sf_dir):
    return X.form_rows(with_elements(P.form_pages(spark, sf_dir))).drop("_no")


@query("ext_recap", f"""
SELECT CASE WHEN b THEN strftime(o_orderdate, '%d/%m/%Y') || ' 10:00' END AS date_limite, CASE WHEN b THEN o_orderkey || '/2025' END AS ref,
  CASE WHEN b THEN 'Objet AB' END AS objet, CASE WHEN b THEN 'Entite ' || o_orderpriority END AS entite_publique,
  CASE WHEN b THEN 'Appel' || CASE WHEN o_orderkey % 2 = 0 THEN ' ouvert' ELSE '' END END AS type_procedure,
  CASE WHEN c THEN 'Cat ' || o_orderkey % 4 END AS categorie, CASE WHEN c THEN 'Lieu ' || o_orderkey || ', R' END AS lieu_execution,
  CASE WHEN c THEN o_orderkey || ',00' END AS estimation_ttc, CASE WHEN c THEN 'C ' || o_orderkey END AS caution_provisoire,
  CASE WHEN c THEN 'Salle ' || o_orderkey END AS lieu_ouverture_plis, CASE WHEN a THEN 'Retrait ' || o_orderkey END AS adresse_retrait_dossiers,
  CASE WHEN a THEN 'Depot' || o_orderkey END AS adresse_depot_offres, CASE WHEN a THEN 'Oui' END AS variante_autorisee,
  CASE WHEN b THEN 'Site 1 Site 2' END AS visites_lieux, NOT b AS sans_recap,
  CAST(o_orderkey AS VARCHAR) AS "refConsultation", 'org' AS "orgAcronyme",
  sha256(CASE WHEN b THEN 'Entite ' || o_orderpriority || '|' || o_orderkey || '/2025|' || strftime(o_orderdate, '%d/%m/%Y') || ' 10:00'
    ELSE '||' END) AS id, '2025-01-01T00:00:00+00:00' AS scraped_at, {_DETAIL} || 'org' AS url_detail
FROM (SELECT *, o_orderkey % 6 <> 0 AS b, o_orderkey % 6 <> 0 AND o_orderkey % 4 <> 1 AS c, o_orderkey % 6 <> 0 AND o_orderkey % 5 <> 1 AS a FROM orders)""")
def ext_recap(spark, sf_dir):
    """All fourteen fields of the recap block."""
    return X.recap_records(raw(P.recap_pages(spark, sf_dir)), F.lit("2025-01-01T00:00:00+00:00"))


@query("ext_detail_links", f"""
SELECT o_orderkey AS page_id, {_DETAIL} || 'O' || i AS url, count(*) AS n FROM {_numbered(3)}
WHERE o_orderkey % 10 <> 5 AND i < 3 GROUP BY 1, 2""")
def ext_detail_links(spark, sf_dir):
    links = K.detail_links(K.page_links(with_elements(P.list_pages(spark, sf_dir))))
    return dedup.dedup_links(links).groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("n"))


@query("ext_samples", f"""
SELECT o_orderkey AS page_id, 'AO-' || o_orderkey || '-' || i AS ref_consultation, 'Marchegrasno ' || o_orderkey || ' & co' AS titre,
  'ORG' || i AS organisme, CASE WHEN i < 3 THEN {_DETAIL} || 'O' || i ELSE 'https://www.marchespublics.gov.ma/' END AS url_detail
FROM {_numbered(3)} WHERE o_orderkey % 10 <> 5""")
def ext_samples(spark, sf_dir):
    return K.sample_tenders(with_elements(P.list_pages(spark, sf_dir))).select(
        "page_id", "ref_consultation", "titre", "organisme", "url_detail")


@query("ext_dead_letter", """
SELECT o_orderkey AS page_id, 'https://www.marchespublics.gov.ma/cherche/liste?p=' || o_orderkey AS url,
  true AS vide, (SELECT CAST(sum(o_orderkey % 3 + 1) AS BIGINT) FROM orders WHERE o_orderkey % 10 <> 5) AS lignes
FROM orders WHERE o_orderkey % 10 = 5""")
def ext_dead_letter(spark, sf_dir):
    """Pages without a row, read back whole from where the extraction put them; beside them, how many rows it wrote in the same pass."""
    path = f"{work_dir(spark, 'dead-letters')}/out"
    rows, empty = X.tenders_and_empty_pages(raw(P.list_pages(spark, sf_dir)), _stamp(), path)
    return empty.select("page_id", "url", F.contains("html", F.lit("Aucun résultat")).alias("vide")).join(rows.agg(F.count(F.lit(1)).alias("lignes")))  # one row
