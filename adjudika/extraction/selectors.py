"""Selector settings. To follow a change of the portal, edit ``SELECTORS`` or pass a changed copy; no code changes.

A selector is a dict: ``tag``, ``cls`` (one class), ``cls_has`` (fragment of the class attribute), ``id``, ``id_has``,
``href_has``, ``href_starts``, ``rel``, ``alt_has``, ``nth`` (position among siblings), ``under`` (list of enclosing tags,
outermost first). A list of selectors matches an element that any of them matches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RECAP = "ctl0_CONTENU_PAGE_idEntrepriseConsultationSummary_"


def s(tag=None, **conditions) -> dict:
    return {"tag": tag, **conditions}


# Where each field stands on the portal's pages.
SELECTORS = {
    "list": {
        "table": [s("table", cls="data-table"), s("table", cls="consultation-table"), s("table", id_has="result")],
        "row": [s("tr", cls_has="row"), s("tr", under=["tbody"])],
        "ref_consultation": [s("td", nth=1), s("td", cls="ref")],
        "titre": [s("td", nth=2), s("td", cls="titre"), s("td", cls="objet")],
        "organisme_acronyme": [s("td", nth=3), s("td", cls="organisme")],
        "type_marche": [s("td", nth=4), s("td", cls="type")],
        "date_publication": [s("td", nth=5), s("td", cls="date-pub")],
        "date_limite": [s("td", nth=6), s("td", cls="date-limite")],
        "statut": [s("td", nth=7), s("td", cls="statut")],
        "detail_link": [s("a", href_has="DetailsConsultation"), s("a", cls="detail-link")],
        "next": [s("a", cls="next"), s("a", rel="next")],
    },
    "detail": {
        "objet": [s("div", cls="objet"), s("p", cls="description")],
        "organisme_nom_complet": [s("div", cls="organisme-nom")],
        "organisme_ville": [s("span", cls="organisme-ville")],
        "organisme_telephone": [s("span", cls="organisme-tel")],
        "organisme_email": [s("a", href_starts="mailto:")],
        "montant_estime": [s("span", cls="montant-estime")],
        "cautionnement_provisoire": [s("span", cls="cautionnement")],
        "secteur": [s("span", cls="secteur")],
        "code_cpv": [s("span", cls="code-cpv")],
        "url_avis": [s("a", href_has="avis")],
        "url_dce": [s("a", href_has="dce")],
        "lot_row": [s("tr", cls="lot"), s("tr", under=["tbody"])],
    },
    "pv": {
        "container": [s("table", cls="pv-table"), s("table", cls="data-table")],
        "row": [s("tr", under=["table", "tbody"])],
        "ref_consultation": [s("td", nth=1)],
        "organisme_acronyme": [s("td", nth=2)],
        "type_pv": [s("td", nth=3)],
        "date_seance": [s("td", nth=4)],
        "date_publication_pv": [s("td", nth=5)],
        "link": [s("a", href_has="pv"), s("a", cls="pv-link"), s("a", href_has="telecharger"), s("a", href_has="download")],
    },
    "award": {
        "table": [s("table", cls="attribution-table")],
        "row": [s("tr", under=["tbody"])],
        "ref_consultation": [s("td", nth=1)],
        "organisme_acronyme": [s("td", nth=2)],
        "entreprise_nom": [s("td", nth=3)],
        "montant_ttc": [s("td", nth=4)],
        "date_attribution": [s("td", nth=5)],
        "link": [s("a", href_has="attribution")],
    },
    "form": {
        "table": [s("table", cls="data-table"), s("table", cls="consultation-table"), s("table", id_has="result")],
        "row": [s("tr", under=["table", "tbody"])],
        "card": [s("div", cls="consultation"), s("li", cls="consultation-item"), s("div", cls="card-consultation")],
        "card_objet": [s(cls="objet"), s(cls="title"), s("h3")],
        "card_ref": [s(cls="ref"), s(cls="reference")],
        "card_acheteur": [s(cls="acheteur"), s(cls="ministry")],
        "card_date": [s(cls="date"), s(cls="deadline")],
    },
    "recap": {
        "block": [s(id="recap-consultation")],
        "date_limite": [s(id=_RECAP + "dateHeureLimiteRemisePlis")],
        "ref": [s(id=_RECAP + "reference")],
        "objet": [s(id=_RECAP + "objet")],
        "entite_publique": [s(id=_RECAP + "entiteAchat")],
        "type_procedure": [s(id=_RECAP + "typeProcedure")],
        "mode_passation": [s(id=_RECAP + "modePassation")],
        "categorie": [s(id=_RECAP + "categoriePrincipale")],
        "lieu_execution": [s(id=_RECAP + "lieuxExecutions")],
        "estimation_ttc": [s(id=_RECAP + "idReferentielZoneText_RepeaterReferentielZoneText_ctl0_labelReferentielZoneText")],
        "caution_provisoire": [s(id=_RECAP + "cautionProvisoire")],
        "lieu_ouverture_plis": [s(id=_RECAP + "lieuOuverturePlis")],
        "adresse_retrait_dossiers": [s(id=_RECAP + "adresseRetraitDossiers")],
        "adresse_depot_offres": [s(id=_RECAP + "adresseDepotOffres")],
        "variante_autorisee": [s(id=_RECAP + "varianteValeur")],
        "visites_lieux": [s(id=_RECAP + "panelRepeaterVisitesLieux")],
    },
    "markers": {
        "error": [s("div", cls="error"), s("div", cls="alert-danger"), s("span", cls="error-message")],
        "empty": [s("div", cls="no-results")],
        "captcha": [s("div", cls="captcha"), s("img", alt_has="captcha")],
    },
}
# Wording on the portal's pages.
EMPTY_TEXT = "Aucun résultat"
DETAIL_PAGE_NAMES = ("EntrepriseDetailsConsultation", "EntrepriseDetailConsultation")
DETAIL_LINK_WORDS = ("detail", "consultation", "pp", "annonce")
TENDER_LINK_WORDS = ("consultation", "details")
MINUTES_LINK_WORDS = ("pv", "proces-verbal")


def _one(e: Column, sel: dict) -> Column:
    tests = []
    if sel.get("tag"):
        tests.append(e.tag == sel["tag"])
    if sel.get("cls"):
        tests.append(F.array_contains(e.cls, sel["cls"]))
    if sel.get("cls_has"):
        tests.append(F.contains(F.array_join(e.cls, " "), F.lit(sel["cls_has"])))
    if sel.get("nth"):
        tests.append(e.nth == sel["nth"])
    if sel.get("under"):
        tests.append(e.above.like("%/" + "/%".join(sel["under"]) + "/%"))
    for part in ("id", "rel"):
        if sel.get(part):
            tests.append(e[part] == sel[part])
    for key, part in (("id_has", "id"), ("href_has", "href"), ("alt_has", "alt")):
        if sel.get(key):
            tests.append(F.contains(e[part], F.lit(sel[key])))
    if sel.get("href_starts"):
        tests.append(F.startswith(e["href"], F.lit(sel["href_starts"])))
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return F.coalesce(out, F.lit(False))


def matches(e: Column, selectors: list[dict]) -> Column:
    """Whether an element matches any of the selectors."""
    out = _one(e, selectors[0])
    for sel in selectors[1:]:
        out = out | _one(e, sel)
    return out
