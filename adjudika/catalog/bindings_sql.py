"""Comparison SQL of the table bindings, as common table expressions."""

from __future__ import annotations

_CORE = """
    'AO-' || o_orderkey AS ref_consultation,
    o_orderpriority || ' / lot unique' AS objet,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'travaux' WHEN '2' THEN 'fournitures' WHEN '3' THEN 'services'
         WHEN '4' THEN 'etudes' ELSE 'autre' END AS type_marche,
    o_orderdate AS date_publication,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate + INTERVAL 30 DAY END AS date_limite,
    CASE o_orderstatus WHEN 'O' THEN 'en_cours' WHEN 'F' THEN 'cloture' ELSE 'annule' END AS statut,
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_totalprice AS DECIMAL(15,2)) END AS montant_estime,
    CASE WHEN o_orderkey % 10 = 7 THEN '' WHEN o_orderkey % 10 <> 3 THEN
      'https://www.marchespublics.gov.ma/index.php?page=entreprise.EntrepriseDetailsConsultation&refConsultation='
      || o_orderkey || '&orgAcronyme=org' END AS url_detail,
    o_orderdate + INTERVAL 1 DAY AS date_extraction
"""

CONSULTATIONS_CORE = f"consultations AS (SELECT {_CORE} FROM orders)"

CONSULTATIONS = f"""consultations AS (
  SELECT {_CORE},
    n_name AS organisme_acronyme, c_name AS organisme_nom_complet, lower(c_mktsegment) AS organisme_ville,
    c_mktsegment AS secteur, 'Marche ' || c_mktsegment || ' no ' || o_orderkey AS titre,
    CAST(NULL AS VARCHAR) AS organisme_telephone, lower(replace(c_name, '#', '.')) || '@example.org' AS organisme_email,
    CAST(NULL AS DECIMAL(15,2)) AS cautionnement_provisoire, substr(o_orderpriority, 1, 1) AS code_cpv,
    CAST(NULL AS VARCHAR) AS url_avis, CAST(NULL AS VARCHAR) AS url_dce
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

LOTS = """lots AS (
  SELECT 'AO-' || l_orderkey AS ref_consultation, CAST(l_linenumber AS VARCHAR) AS numero_lot, p_name AS designation,
    CAST(l_extendedprice AS DECIMAL(15,2)) AS montant_estime, l_shipdate + INTERVAL 1 DAY AS date_extraction
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

ATTRIBUTIONS = """attributions AS (
  SELECT 'AO-' || l_orderkey AS ref_consultation, 'ORG-' || (l_partkey % 25) AS organisme_acronyme,
    CAST(l_shipdate AS DATE) AS date_attribution, s_name AS entreprise_nom, CAST(NULL AS VARCHAR) AS entreprise_ice,
    n_name AS entreprise_ville, CAST(l_extendedprice AS DECIMAL(15,2)) AS montant_ttc,
    CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))) AS DECIMAL(15,2)) AS montant_ht,
    CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS taux_rabais,
    CAST(l_linenumber AS VARCHAR) AS numero_lot, '' AS url_resultat, l_shipdate + INTERVAL 1 DAY AS date_extraction
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

PV = """pv_extraits AS (
  SELECT 'AO-' || l_orderkey AS ref_consultation, 'ORG-' || (l_partkey % 25) AS organisme_acronyme,
    l_returnflag || l_linestatus AS type_pv, l_shipdate - INTERVAL 7 DAY AS date_seance,
    l_shipdate AS date_publication_pv, CAST(NULL AS VARCHAR) AS contenu,
    CAST(l_quantity AS INTEGER) AS nombre_soumissionnaires, 'pv/' || l_orderkey || '/' || l_linenumber AS url_pv
  FROM lineitem)"""

ACHEVEMENTS = """achevements AS (
  SELECT 'AO-' || l_orderkey AS ref_consultation, CAST(l_shipdate AS DATE) + 90 AS date_achevement,
    'Supplier ' || l_suppkey AS entreprise_nom, CAST(l_extendedprice AS DECIMAL(15,2)) AS montant_definitif
  FROM lineitem WHERE l_linestatus = 'F')"""

TEXT_TENDERS = """text_tenders AS (
  SELECT 'DOC-' || doc_id AS ref_consultation, upper(lang) AS organisme_acronyme, 'Document ' || source AS titre,
    text AS objet, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(doc_id % 365 AS INTEGER)) AS date_publication
  FROM documents)"""

METRICS = """metrics AS (
  SELECT ts, 'spider_' || (user_id % 5) AS spider, metric,
    CASE metric
      WHEN 'responses_total'
        THEN CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 = 0 THEN '429' ELSE '200' END
      WHEN 'items_scraped_total' THEN CASE WHEN event_id % 3 = 0 THEN 'lot' ELSE 'consultation' END
      WHEN 'spider_closed_total' THEN 'finished' END AS label
  FROM events JOIN (VALUES ('error', 'spider_errors_total'), ('view', 'pages_scraped_total'),
    ('view', 'responses_total'), ('purchase', 'items_scraped_total'), ('signup', 'spider_started_total'),
    ('click', 'spider_closed_total'), ('click', 'requests_total')) m(kind, metric) ON event_type = kind)"""

RUNS = """runs AS (
  SELECT ts AS date_execution, 'spider_' || (user_id % 5) AS spider_name,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS statut,
    CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS pages_parcourues, CAST(floor(value) AS BIGINT) AS items_extraits,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS erreurs
  FROM events)"""


def with_tables(body: str, *tables: str) -> str:
    return f"WITH {', '.join(tables)} {body}"
