"""Listings, search and tender detail."""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudika.catalog import bindings_sql as B
from adjudika.catalog.registry import query
from adjudika.operators.filters import page_after, pages_of, search_window
from adjudika.operators.nesting import dossier
from adjudika.operators.projections import AWARD, MINUTES, TENDER_DETAIL, TENDER_LIST
from adjudika.plans import listings as L
from adjudika.sources import driver_tables as D

_MONEY = {"montant_estime", "montant_ht", "montant_ttc", "taux_rabais", "cautionnement_provisoire"}


def _cols(names) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" if n in _MONEY else n for n in names)


@query("flt_list_consultations", B.with_tables(f"""
SELECT {_cols(TENDER_LIST)} FROM consultations
WHERE statut = 'en_cours' AND type_marche = 'travaux' AND organisme_acronyme ILIKE '%nation_1%'
  AND date_publication >= TIMESTAMP '1996-01-01' AND date_publication <= TIMESTAMP '2000-12-31'
ORDER BY date_publication DESC, ref_consultation LIMIT 50 OFFSET 5""", B.CONSULTATIONS))
def flt_list_consultations(spark, sf_dir):
    return L.list_tenders(
        D.consultations(spark, sf_dir), statut="en_cours", type_marche="travaux", organisme="nation_1",
        date_debut="1996-01-01", date_fin="2000-12-31", limit=50, offset=5)


@query("flt_pages", B.with_tables("""
SELECT ref_consultation, date_publication, titre, CAST(row_number() OVER (ORDER BY date_publication DESC, ref_consultation) - 1 AS INT) AS rang,
  CAST((row_number() OVER (ORDER BY date_publication DESC, ref_consultation) - 1) // 1000 AS INT) AS page
FROM consultations WHERE type_marche = 'travaux' AND organisme_acronyme ILIKE '%nation_1%'""", B.CONSULTATIONS))
def flt_pages(spark, sf_dir):
    """A whole list with the pages that a reader finds one by one, each by the last row of the page before."""
    chosen = L.shape(L.filter_tenders(D.consultations(spark, sf_dir), type_marche="travaux", organisme="nation_1"), TENDER_LIST)
    rows = pages_of(chosen, "date_publication", ["ref_consultation"], 1000).rows()
    return rows.select("ref_consultation", "date_publication", "titre", F.col("rang").cast("int").alias("rang"), F.col("page").cast("int").alias("page"))


@query("flt_page_after", B.with_tables("""
SELECT ref_consultation, date_publication FROM consultations
WHERE (date_publication < TIMESTAMP '1997-06-15' OR date_publication = TIMESTAMP '1997-06-15' AND ref_consultation > 'AO-5')
ORDER BY date_publication DESC, ref_consultation LIMIT 500""", B.CONSULTATIONS_CORE))
def flt_page_after(spark, sf_dir):
    tenders = D.consultations_core(spark, sf_dir).select("ref_consultation", "date_publication")
    cursor = {"date_publication": "1997-06-15 00:00:00", "ref_consultation": "AO-5"}
    return page_after(tenders, "date_publication", ["ref_consultation"], cursor, 500)


@query("flt_all_consultations", B.with_tables(f"""
SELECT {_cols(TENDER_LIST)} FROM consultations
WHERE organisme_acronyme ILIKE '%nation_1%' AND date_publication >= TIMESTAMP '1996-01-01'""", B.CONSULTATIONS))
def flt_all_consultations(spark, sf_dir):
    chosen = L.filter_tenders(D.consultations(spark, sf_dir), organisme="nation_1", date_debut="1996-01-01")
    return L.shape(chosen, TENDER_LIST)


@query("flt_list_pv", B.with_tables(f"""
SELECT {_cols(MINUTES)} FROM pv_extraits
WHERE organisme_acronyme ILIKE '%org-1%' AND date_publication_pv >= TIMESTAMP '1997-01-01'
  AND date_publication_pv <= TIMESTAMP '2000-06-30'
ORDER BY date_publication_pv DESC, ref_consultation, url_pv, organisme_acronyme, type_pv, date_seance, contenu,
  nombre_soumissionnaires LIMIT 100""", B.PV))
def flt_list_pv(spark, sf_dir):
    return L.list_minutes(D.pv_extraits(spark, sf_dir), organisme="org-1", date_debut="1997-01-01",
                          date_fin="2000-06-30")


@query("flt_list_attributions", B.with_tables(f"""
SELECT {_cols(AWARD)} FROM attributions
WHERE entreprise_nom ILIKE '%supplier%' AND organisme_acronyme ILIKE '%org-2%'
  AND date_attribution >= DATE '1996-01-01' AND date_attribution <= DATE '2001-01-01'
  AND montant_ttc >= 1000 AND montant_ttc <= 50000
ORDER BY date_attribution DESC, ref_consultation, organisme_acronyme, entreprise_nom, entreprise_ice, entreprise_ville,
  montant_ht, montant_ttc, taux_rabais, numero_lot, url_resultat LIMIT 200 OFFSET 20""", B.ATTRIBUTIONS))
def flt_list_attributions(spark, sf_dir):
    return L.list_awards(
        D.attributions(spark, sf_dir), entreprise="supplier", organisme="org-2", date_debut="1996-01-01",
        date_fin="2001-01-01", montant_min=1000, montant_max=50000, limit=200, offset=20)


@query("flt_by_ref", B.with_tables(f"""
SELECT {_cols(TENDER_LIST)} FROM consultations
WHERE ref_consultation = 'AO-5' LIMIT 1""", B.CONSULTATIONS))
def flt_by_ref(spark, sf_dir):
    return L.tender_by_ref(D.consultations(spark, sf_dir), "AO-5")


@query("flt_search", B.with_tables("""
SELECT * FROM text_tenders WHERE titre ILIKE '%the_an%' OR objet ILIKE '%the_an%' OR ref_consultation ILIKE '%the_an%'
ORDER BY date_publication DESC, ref_consultation LIMIT 100""", B.TEXT_TENDERS))
def flt_search(spark, sf_dir):
    return L.search_tenders(D.text_tenders(spark, sf_dir), "the_an")


@query("flt_window", B.with_tables("""
SELECT ref_consultation, date_publication, date_limite FROM consultations
WHERE CAST(date_publication AS DATE) BETWEEN DATE '1998-07-01' - 180 AND DATE '1998-07-01'
  AND CAST(date_limite AS DATE) BETWEEN DATE '1998-07-01' AND DATE '1998-07-01' + 183""", B.CONSULTATIONS_CORE))
def flt_window(spark, sf_dir):
    chosen = search_window(D.consultations_core(spark, sf_dir), F.lit("1998-07-01").cast("date"))
    return chosen.select("ref_consultation", "date_publication", "date_limite")


def _flat(items: str, fields) -> F.Column:
    """Nested items as one text, so that both engines can be compared."""
    return F.array_join(F.transform(items, lambda x: F.concat_ws("~", *(g(x) for g in fields))), "|")


def _cents(c):
    return F.round(c * 100).cast("bigint").cast("string")


@query("jn_detail_lots", B.with_tables(f"""
SELECT {_cols(TENDER_DETAIL)}, part, n_lots, lots FROM consultations JOIN (
  SELECT o.ref_consultation AS r, 0 AS part, count(numero_lot) AS n_lots,
    coalesce(string_agg(concat_ws('~', numero_lot, designation, CAST(CAST(l.montant_estime * 100 AS BIGINT) AS VARCHAR)),
      '|' ORDER BY numero_lot, designation, l.montant_estime), '') AS lots
  FROM consultations o LEFT JOIN lots l ON o.ref_consultation = l.ref_consultation GROUP BY 1) ON r = ref_consultation
""", B.CONSULTATIONS, B.LOTS))
def jn_detail_lots(spark, sf_dir):
    detail = L.tender_detail(D.consultations(spark, sf_dir), D.lots(spark, sf_dir))
    lots = _flat("lots", [lambda x: x.numero_lot, lambda x: x.designation, lambda x: _cents(x.montant_estime)])
    return detail.withColumns({"n_lots": F.size("lots").cast("bigint"), "lots": lots})


@query("jn_detail_one", B.with_tables("""
SELECT c.ref_consultation, c.titre, count(numero_lot) AS n_lots, min(numero_lot) AS premier_lot
FROM consultations c LEFT JOIN lots l ON c.ref_consultation = l.ref_consultation
WHERE c.ref_consultation = 'AO-5' GROUP BY 1, 2""", B.CONSULTATIONS, B.LOTS))
def jn_detail_one(spark, sf_dir):
    detail = L.tender_detail(D.consultations(spark, sf_dir), D.lots(spark, sf_dir), ref="AO-5")
    return detail.select("ref_consultation", "titre", F.size("lots").cast("bigint").alias("n_lots"),
                         F.get("lots", F.lit(0)).numero_lot.alias("premier_lot"))


def _agg(items: str, order: str) -> str:
    return f"coalesce(string_agg(concat_ws('~', {items}), '|' ORDER BY {order}), '')"


def _sql_cents(c):
    return f"CAST(CAST({c} * 100 AS BIGINT) AS VARCHAR)"


def _sql_day(c):
    return f"strftime({c}, '%Y-%m-%d')"


@query("jn_detail_all", B.with_tables(f"""
SELECT c.ref_consultation, titre, 0 AS part, coalesce(l.x, '') AS lots, coalesce(p.x, '') AS pv, coalesce(a.x, '') AS attributions, coalesce(h.x, '') AS achevements
FROM consultations c
LEFT JOIN (SELECT ref_consultation, {_agg(f"numero_lot, designation, {_sql_cents('montant_estime')}", "numero_lot, designation, montant_estime")} AS x
  FROM lots GROUP BY 1) l USING (ref_consultation)
LEFT JOIN (SELECT ref_consultation, {_agg(f"{_sql_day('date_publication_pv')}, type_pv, CAST(nombre_soumissionnaires AS VARCHAR)",
                                          "date_publication_pv, type_pv, nombre_soumissionnaires")} AS x FROM pv_extraits GROUP BY 1) p USING (ref_consultation)
LEFT JOIN (SELECT ref_consultation, {_agg(f"{_sql_day('date_attribution')}, entreprise_nom, {_sql_cents('montant_ttc')}",
                                          "date_attribution, entreprise_nom, montant_ttc")} AS x
  FROM attributions GROUP BY 1) a USING (ref_consultation)
LEFT JOIN (SELECT ref_consultation, {_agg(f"{_sql_day('date_achevement')}, entreprise_nom, {_sql_cents('montant_definitif')}",
                                          "date_achevement, entreprise_nom, montant_definitif")} AS x FROM achevements GROUP BY 1) h USING (ref_consultation)
""", B.CONSULTATIONS, B.LOTS, B.PV, B.ATTRIBUTIONS, B.ACHEVEMENTS))
def jn_detail_all(spark, sf_dir):
    """Tenders with the contents of all four relations."""
    return _flat_dossier(_dossier(spark, sf_dir)).select("ref_consultation", "titre", "part", *_CONTENTS)


def _dossier(spark, sf_dir, part_size=10_000):
    return L.tender_dossier(D.consultations(spark, sf_dir), D.lots(spark, sf_dir), D.pv_extraits(spark, sf_dir), D.attributions(spark, sf_dir),
                            D.achevements(spark, sf_dir), part_size)


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


_CONTENTS = {
    "lots": [lambda x: x.numero_lot, lambda x: x.designation, lambda x: _cents(x.montant_estime)],
    "pv": [lambda x: _day(x.date_publication_pv), lambda x: x.type_pv, lambda x: x.nombre_soumissionnaires.cast("string")],
    "attributions": [lambda x: _day(x.date_attribution), lambda x: x.entreprise_nom, lambda x: _cents(x.montant_ttc)],
    "achevements": [lambda x: _day(x.date_achevement), lambda x: x.entreprise_nom, lambda x: _cents(x.montant_definitif)],
}


def _flat_dossier(df):
    return df.withColumns({name: _flat(name, fields) for name, fields in _CONTENTS.items()})


@query("jn_detail_parts", B.with_tables("""
SELECT c.ref_consultation, CAST(p AS INT) AS part, CAST(greatest(0, least(3, l.n - 3 * p)) AS BIGINT) AS n_lots,
  CAST(greatest(0, least(3, coalesce(h.n, 0) - 3 * p)) AS BIGINT) AS n_achevements, l.x AS lots
FROM consultations c
JOIN (SELECT ref_consultation, count(numero_lot) AS n, coalesce(string_agg(numero_lot || '~' || designation, '|' ORDER BY numero_lot, designation), '') AS x
  FROM consultations LEFT JOIN lots USING (ref_consultation) GROUP BY 1) l USING (ref_consultation)
LEFT JOIN (SELECT ref_consultation, count(*) AS n FROM achevements GROUP BY 1) h USING (ref_consultation),
range(0, 100) r(p) WHERE p = 0 OR 3 * p < greatest(l.n, coalesce(h.n, 0))""", B.CONSULTATIONS_CORE, B.LOTS, B.ACHEVEMENTS))
def jn_detail_parts(spark, sf_dir):
    """Parts of three children: how many each part has, and, over all parts of a tender, which lots."""
    relations = {"lots": (D.lots(spark, sf_dir), ("numero_lot", "designation", "montant_estime")),
                 "achevements": (D.achevements(spark, sf_dir), ("date_achevement", "entreprise_nom", "montant_definitif"))}
    nested = dossier(D.consultations_core(spark, sf_dir).select("ref_consultation", "statut"), "ref_consultation", relations, 3)
    texts = F.transform("lots", lambda x: F.concat_ws("~", x.numero_lot, x.designation))
    rows = nested.select("ref_consultation", "part", *(F.size(n).cast("bigint").alias(f"n_{n}") for n in relations), texts.alias("lots"))
    every = rows.groupBy("ref_consultation").agg(F.array_join(F.sort_array(F.flatten(F.collect_list("lots"))), "|").alias("lots"))
    return rows.drop("lots").join(every, "ref_consultation")
