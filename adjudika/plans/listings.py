"""Filtered, paged listings and the tender detail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudika.operators import filters as f
from adjudika.operators.nesting import dossier
from adjudika.operators.projections import AWARD, LOT, MINUTES, TENDER_DETAIL, TENDER_LIST, shape


def filter_tenders(consultations: DataFrame, statut=None, type_marche=None, organisme=None, date_debut=None,
                   date_fin=None, whole_end_day: bool = False, literal: bool = False) -> DataFrame:
    out = f.equals(consultations, "statut", statut)
    out = f.equals(out, "type_marche", type_marche)
    out = f.contains(out, "organisme_acronyme", organisme, literal)
    return f.between(out, "date_publication", date_debut, date_fin, whole_end_day)


def list_tenders(consultations: DataFrame, limit: int = 100, offset: int = 0, **criteria) -> DataFrame:
    chosen = shape(filter_tenders(consultations, **criteria), TENDER_LIST)
    return f.page(chosen, "date_publication", ["ref_consultation"], limit, offset)


def tenders_after(consultations: DataFrame, cursor: dict | None = None, limit: int = 100, **criteria) -> DataFrame:
    """The page of ``list_tenders`` after the row with the cursor's ``date_publication`` and ``ref_consultation``; the first without one."""
    chosen = shape(filter_tenders(consultations, **criteria), TENDER_LIST)
    return f.page_after(chosen, "date_publication", ["ref_consultation"], cursor, limit)


def tender_by_ref(consultations: DataFrame, ref: str) -> DataFrame:
    """The tender with this reference, or no row."""
    return shape(consultations.filter(F.col("ref_consultation") == ref).limit(1), TENDER_LIST)


def search_tenders(consultations: DataFrame, term: str, limit: int = 100, literal: bool = False) -> DataFrame:
    """Title, subject or reference contains the term; newest first."""
    if len(term) < 3:
        raise ValueError("the search term needs at least 3 characters")
    hit = (f.contains_ci("titre", term, literal) | f.contains_ci("objet", term, literal)
           | f.contains_ci("ref_consultation", term, literal))
    return f.page(consultations.filter(hit), "date_publication", ["ref_consultation"], limit)


def list_minutes(minutes: DataFrame, ref_consultation=None, organisme=None, date_debut=None, date_fin=None,
                 limit: int = 100, offset: int = 0, tiebreak=("ref_consultation", "url_pv")) -> DataFrame:
    out = f.equals(minutes, "ref_consultation", ref_consultation)
    out = f.contains(out, "organisme_acronyme", organisme)
    out = f.between(out, "date_publication_pv", date_debut, date_fin)
    rest = [c for c in MINUTES if c not in ("date_publication_pv", *tiebreak)]
    return f.page(shape(out, MINUTES), "date_publication_pv", [*tiebreak, *rest], limit, offset)


def list_awards(awards: DataFrame, ref_consultation=None, entreprise=None, organisme=None, date_debut=None,
                date_fin=None, montant_min=None, montant_max=None, limit: int = 100, offset: int = 0) -> DataFrame:
    out = f.equals(awards, "ref_consultation", ref_consultation)
    out = f.contains(out, "entreprise_nom", entreprise)
    out = f.contains(out, "organisme_acronyme", organisme)
    out = f.between(out, "date_attribution", date_debut, date_fin)
    out = f.between(out, "montant_ttc", montant_min, montant_max)
    rest = [c for c in AWARD if c != "date_attribution"]
    return f.page(shape(out, AWARD), "date_attribution", rest, limit, offset)


def tender_detail(consultations: DataFrame, lots: DataFrame, ref: str | None = None, part_size: int = 10_000) -> DataFrame:
    """Tender with its lots as an array; with ``ref``, of that tender only (the filter reaches both scans)."""
    if ref:
        consultations, lots = (d.filter(F.col("ref_consultation") == ref) for d in (consultations, lots))
    return dossier(shape(consultations, TENDER_DETAIL), "ref_consultation", {"lots": (shape(lots, ("ref_consultation", *LOT)), LOT)}, part_size)


def tender_dossier(consultations: DataFrame, lots: DataFrame, minutes: DataFrame, awards: DataFrame,
                   completions: DataFrame, part_size: int = 10_000) -> DataFrame:
    """Tender with all four child relations as arrays."""
    key = "ref_consultation"
    kinds = {"lots": (lots, LOT), "pv": (minutes, ("date_publication_pv", "type_pv", "nombre_soumissionnaires")),
             "attributions": (awards, ("date_attribution", "entreprise_nom", "montant_ttc")),
             "achevements": (completions, ("date_achevement", "entreprise_nom", "montant_definitif"))}
    return dossier(shape(consultations, TENDER_DETAIL), key, {n: (shape(df, (key, *columns)), columns) for n, (df, columns) in kinds.items()}, part_size)
